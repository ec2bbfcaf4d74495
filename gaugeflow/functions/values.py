"""Missing values, time steps and other scalar expressions.

Missing is NULL everywhere; an undefined ratio is NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the text formats.
MISSING = 1e31
STAMP_FORMAT = "dd/MM/yyyy HH:mm"
STEP_MINUTES = (360, 1440)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def present(value: Column) -> Column:
    """NULL for NaN and for the missing-value sentinel."""
    return F.when(~F.isnan(value) & (value != F.lit(MISSING)), value)


def non_negative(value: Column) -> Column:
    return F.when(value >= 0, value)


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top, bottom)


def log_or_null(value: Column) -> Column:
    return F.when(value > 0, F.ln(value))


def check_step(minutes: int) -> int:
    if minutes not in STEP_MINUTES:
        raise ValueError(f"time step of {minutes} minutes is not supported, use one of {STEP_MINUTES}")
    return minutes


def checked_minutes(minutes: Column) -> Column:
    """``check_step`` for a column: any other step fails the job."""
    text = F.concat(F.lit("time step not supported: "), F.coalesce(minutes.cast("string"), F.lit("NULL")))
    return F.when(F.coalesce(minutes.isin(*STEP_MINUTES), F.lit(False)), minutes).otherwise(F.raise_error(text).cast("int"))


def step_hours(cal_type: Column) -> Column:
    """Hours per step from a calibration type: 6, 24, or text with ``_6h`` / ``_24h``."""
    text = cal_type.cast("string")
    number = text.try_cast("double")
    return (
        F.when(F.contains(text, F.lit("_6h")) | (number == 6), F.lit(6))
        .when(F.contains(text, F.lit("_24h")) | (number == 24), F.lit(24))
        .otherwise(F.raise_error(F.concat(F.lit("calibration type not supported: "),
                                          F.coalesce(text, F.lit("NULL")))).cast("int"))
    )


def add_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days=days.cast("int"))


def add_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + minutes.cast("long") * F.lit(60_000_000))


def step_stamp(start: Column, step: Column, minutes: int) -> Column:
    """Timestamp of a 1-based step number."""
    return add_minutes(start, (step - 1) * F.lit(minutes))


def stamp_text(ts: Column) -> Column:
    return F.date_format(ts, STAMP_FORMAT)


def parse_stamp(text: Column) -> Column:
    """Strict: text in another format fails the job."""
    return F.to_timestamp(text, STAMP_FORMAT)


def right_edge_day(ts: Column) -> Column:
    """Label of the bin (00:00, 24:00] holding ``ts``: the midnight that closes it."""
    return F.date_trunc("day", ts - F.expr("INTERVAL 1 MICROSECOND")) + F.expr("INTERVAL 1 DAY")


def coordinates_text(x: Column, y: Column) -> Column:
    return F.concat_ws(" ", x.cast("double").cast("string"), y.cast("double").cast("string"))


def padded_id(obsid: Column, width: int = 5) -> Column:
    """Station number, zero-padded to ``width``; longer numbers stay whole."""
    text = obsid.cast("long").cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
