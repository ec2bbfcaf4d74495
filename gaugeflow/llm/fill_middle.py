"""Fill-in-the-middle transformation by repeated-capture matching.

One ``regex`` fullmatch of ``(unit)*`` covers a text from left to right and keeps every repetition
of its group, so ``match.ends(1)`` holds the end of each unit: its length is the number of units n,
and both cuts are entries of it. Four numbers come from a digest of seed and id: two choose the cuts
between 0 and n, one whether the text is transformed, one the order of the parts. The output is
rebuilt from sentinels alone, which a transformed text never contains.

Defined cases: a null text is empty; an empty text, a text that holds a sentinel and a text that the
units don't cover stay plain (the last with n = 0); a null id digests the seed alone; rows that
repeat an id use the same numbers on their own text; both cuts may fall together; an empty table
gives an empty result; other columns of the input, whatever their names, are left out. The library
keeps at most some millions of repetitions in one match, so a very long text (over ``STRETCH`` code
points) is matched in stretches of that many units, each one match with all its repetitions; for
units that tile a text from left to right without going back, as all named here do, the ends are
those of one match. It is held by one task, with 8 bytes a unit besides the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import id_and_text, id_of, slices

POINT = "."  # with DOTALL: one code point
SEED = "1:"
STRETCH = 1_000_000
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT = "_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def numbers(id_col: str, seed: str = SEED) -> list[Column]:
    """The first four 8-digit groups of the digest of seed and id, as unsigned integers."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def patterns(unit: str = POINT) -> tuple[regex.Pattern, regex.Pattern]:
    """The repeated unit for a whole text, and for one stretch of a very long one.

    The whole unit is group 1, so groups of its own don't shift that number.
    """
    return regex.compile(f"({unit})*", regex.DOTALL), regex.compile(f"({unit}){{0,{STRETCH}}}", regex.DOTALL)


def unit_ends(text: str, whole: regex.Pattern, stretch: regex.Pattern) -> np.ndarray:
    """End of every unit; none if the units don't cover the text."""
    if len(text) <= STRETCH:
        match = whole.fullmatch(text)
        return np.array(match.ends(1) if match else [], np.int64)
    parts, at = [], 0
    while at < len(text):
        match = stretch.match(text, at)
        if match is None or match.end() == at:
            return np.zeros(0, np.int64)
        parts.append(np.array(match.ends(1), np.int64))
        at = match.end()
    return np.concatenate(parts)


def cut(text: str, h: tuple[int, int, int, int], unit: tuple[regex.Pattern, regex.Pattern]) -> tuple[int, str, int | None, int | None, str]:
    """n, form, code points of prefix and middle, output."""
    ends = unit_ends(text, *unit)
    n = len(ends)
    if not n or h[2] % 100 >= PLAIN_FROM or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    low, high = (int(ends[k - 1]) if k else 0 for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < SPM_BELOW:
        return n, "spm", low, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", low, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = POINT, seed: str = SEED) -> DataFrame:
    """Per row: its id, n, form (plain, psm, spm), prefix_chars, middle_chars, output.

    ``unit`` is a pattern of the ``regex`` library, such as a code point, a grapheme or a line.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = patterns(unit)
        for batch in batches:
            for part, _, _ in slices([batch]):
                h = zip(*(part.column(2 + i).to_pylist() for i in range(4)))
                cuts = [cut(t, k, compiled) for t, k in zip(part.column(1).to_pylist(), h)]
                columns = [list(c) for c in zip(*cuts)]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                    names=["_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = id_and_text(docs, id_col, text_col).withColumn("_known", id_of("_id"))
    keyed = rows.select("_id", "_text", *[h.alias(f"_h{i}") for i, h in enumerate(numbers("_known", seed))])
    return keyed.mapInArrow(run, CUT).select(id_of("_id").alias(id_col), "n", "form", "prefix_chars", "middle_chars", "output")


def _parts(output: Column, first: str, second: str) -> tuple[Column, Column, Column]:
    """What follows the sentinels ``first``, ``second`` and the one of the middle."""
    a, b = F.instr(output, second), F.instr(output, MIDDLE)
    size = len(first)
    return (F.substring(output, F.lit(size + 1), a - size - 1), F.substring(output, a + len(second), b - a - len(second)),
            F.substring(output, b + len(MIDDLE), F.length(output)))


def restore(output: Column, form: Column) -> Column:
    """The text before the transformation."""
    prefix, suffix, middle = _parts(output, PREFIX, SUFFIX)
    late, early, last = _parts(output, SUFFIX, PREFIX)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(early, last, late))
            .otherwise(output))


def op13_fill_middle(spark, sf_dir: str) -> DataFrame:
    cuts = transform(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return cuts.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


ORACLE = """
with d as (select doc_id, coalesce(text, '') t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) h from documents),
k as (select doc_id, t, length(t) n, [cast('0x' || h[8 * i + 1:8 * i + 8] as bigint) for i in range(4)] hs from d),
c as (select *, least(hs[1] % (n + 1), hs[2] % (n + 1)) a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) b,
  case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or hs[3] % 100 >= 90 then 'plain'
       when hs[4] % 100 < 20 then 'spm' else 'psm' end form from k),
p as (select *, substring(t, 1, a) pre, substring(t, a + 1, b - a) mid, substring(t, b + 1) suf from c)
select doc_id, n, form, case when form <> 'plain' then a end prefix_chars, case when form <> 'plain' then b - a end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                   else '<S>' || suf || '<P>' || pre || '<M>' || mid end) output_sha256,
  sha256(t) restored_sha256
from p
"""
