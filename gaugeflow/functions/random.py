"""Random numbers as a function of their coordinates.

A number depends only on the seed and the ids it belongs to, so a lost executor, another number
of partitions or a restart reproduces it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 13  # hexadecimal digits taken from the digest: 52 bits, exact in a double


def uniform(seed: int, stream: str, *ids: Column) -> Column:
    """Uniform in [0, 1) for a named stream and ids."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(stream), *[i.cast("string") for i in ids])
    number = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double")
    return number / F.lit(float(16 ** DIGITS))


def normal(seed: int, stream: str, *ids: Column) -> Column:
    """Standard normal from two uniforms (Box-Muller)."""
    radius = F.sqrt(-2 * F.ln(1 - uniform(seed, f"{stream}:r", *ids)))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(seed, f"{stream}:t", *ids))
