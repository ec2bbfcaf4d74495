"""Readers and writers of time-series text.

Parsing works on DataFrames of lines ``(file, value)``, so it is the same for files and for text
that comes from a table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.values import (MISSING, add_minutes, check_step, parse_stamp, present,
                                        stamp_text)
from gaugeflow.operators.alignment import end_violations

# Pieces of the station folder layout.
STATION_FOLDER = r"/([0-9]+)/out/"
RUN_FOLDER = r"/out/([^/]+)/[^/]+$"
INTEGER = r"^[0-9]+$"


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of the files with their name; large files are read in pieces."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value")


def file_obsid(file: Column) -> Column:
    return F.regexp_extract(file, STATION_FOLDER, 1).try_cast("long")


def file_run_id(file: Column) -> Column:
    return F.nullif(F.regexp_extract(file, RUN_FOLDER, 1), F.lit(""))


def _tokens(value: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(value, r"\s+", " ")), " ")


def parse_series(lines: DataFrame) -> DataFrame:
    """(file, step, gauge, q) from whitespace text: an integer step, then one value per gauge.

    Header lines hold one token or do not start with an integer. ``gauge`` is the 1-based column.
    """
    rows = lines.select("file", _tokens(F.col("value")).alias("t")).filter(
        (F.size("t") >= 2) & F.col("t")[0].rlike(INTEGER))
    values = F.slice("t", 2, F.size("t") - 1)
    return (rows.select("file", F.col("t")[0].cast("int").alias("step"), F.posexplode(values).alias("i", "v"))
            .select("file", "step", (F.col("i") + 1).alias("gauge"),
                    present(F.col("v").cast("double")).alias("q")))


def parse_last_gauge(lines: DataFrame) -> DataFrame:
    """(file, step, q) with the value of the last gauge of every step."""
    rows = lines.select("file", _tokens(F.col("value")).alias("t")).filter(
        (F.size("t") >= 2) & F.col("t")[0].rlike(INTEGER))
    return rows.select("file", F.col("t")[0].cast("int").alias("step"),
                       present(F.element_at("t", -1).cast("double")).alias("q"))


def read_series(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(obsid, run_id, step, q) from one-gauge files in the station folders."""
    return parse_series(text_lines(spark, path)).filter("gauge = 1").select(
        file_obsid(F.col("file")).alias("obsid"), file_run_id(F.col("file")).alias("run_id"),
        "step", "q")


def read_gauges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_series(text_lines(spark, path))


def stamped(series: DataFrame, start: datetime | Column, minutes: int) -> DataFrame:
    """Timestamps for the steps; step 1 is the start."""
    check_step(minutes)
    begin = F.lit(start) if isinstance(start, datetime) else start
    return series.withColumn("ts", add_minutes(begin, (F.col("step") - 1) * F.lit(minutes)))


def complete(series: DataFrame, expected: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The series that stop at their ``expected`` (keys, end), and the violations by the others.

    An expected series without any row is a violation with a NULL ``last_ts``; a series that is not
    expected is left out. Nothing runs here: both results are plans, the violations empty when all is well.
    """
    wrong = end_violations(series, expected, tuple(keys))
    whole = expected.select(*keys).join(wrong, keys, "left_anti")
    return series.join(whole, keys, "left_semi"), wrong


def checked_end(series: DataFrame, end: datetime, keys: list[str], expected: DataFrame | None = None) -> DataFrame:
    """The series, after failing when one is absent from ``expected`` (keys) or does not stop at ``end``.

    Without ``expected``, the series that exist are checked, and none at all is a failure.
    """
    known = series.select(*keys).distinct() if expected is None else expected.select(*keys).distinct()
    _, found = complete(series, known.withColumn("end", F.lit(end)), keys)
    wrong = [r.asDict() for r in found.orderBy(*keys).limit(5).collect()]
    absent = [r for r in wrong if r["last_ts"] is None]
    if absent:
        raise FileNotFoundError(f"no simulated series: {absent}")
    if wrong:
        raise ValueError(f"simulated series do not end at {end}: {wrong}")
    if known.isEmpty():
        raise FileNotFoundError("no simulated series found")
    return series


def read_wide(spark: SparkSession, path: str | list[str], name: str = "q") -> DataFrame:
    """(obsid, ts, value) from CSV with a timestamp column and a column per station."""
    table = spark.read.option("header", True).csv(path)
    stamp, *stations = table.columns
    return parse_wide(table, stamp, stations, name)


def parse_wide(table: DataFrame, stamp: str, stations: list[str], name: str = "q") -> DataFrame:
    values = table.select(F.col(f"`{stamp}`").alias("_ts"),
                          *[F.col(f"`{c}`").cast("double").alias(c) for c in stations])
    return (values.unpivot(["_ts"], stations, "obsid", name)
            .select(F.col("obsid").cast("long").alias("obsid"), parse_stamp(F.col("_ts")).alias("ts"),
                    present(F.col(name)).alias(name)))


def with_missing(q: Column) -> Column:
    return F.coalesce(q, F.lit(MISSING))


def stamped_csv(series: DataFrame, value: str = "q") -> DataFrame:
    """(obsid, Timestamp, value): the CSV layout of a simulated or observed series."""
    return series.select("obsid", stamp_text(F.col("ts")).alias("Timestamp"), F.col(value))


def write_stamped_csv(series: DataFrame, path: str, value: str = "q") -> None:
    """One folder per station; a missing value is an empty field."""
    (stamped_csv(series, value).repartitionByRange("obsid", "Timestamp")
     .write.mode("overwrite").partitionBy("obsid").option("header", True).csv(path))


def inflow_text(inflows: DataFrame) -> DataFrame:
    """(obsid, line_no, value): text of the combined inflow file of every station.

    Header lines come first (a title, the column count, a caption and one id per inlet), then one
    line per step with the inlets in link order.
    """
    ids = inflows.select("obsid", "inlet_no", "upstream_id").distinct()
    inlet_lines = ids.select("obsid", (F.col("inlet_no") + 3).cast("long").alias("line_no"),
                             F.col("upstream_id").cast("string").alias("value"))
    counts = ids.groupBy("obsid").agg((F.count(F.lit(1)) + 1).cast("string").alias("columns"))
    title = counts.select("obsid", F.inline(F.array(
        F.struct(F.lit(1).cast("long").alias("line_no"), F.lit("timeseries scalar").alias("value")),
        F.struct(F.lit(2).cast("long").alias("line_no"), F.col("columns").alias("value")),
        F.struct(F.lit(3).cast("long").alias("line_no"), F.lit("timestep").alias("value")))))
    entry = F.struct("inlet_no", with_missing(F.col("q")).cast("string").alias("q"))
    steps = inflows.groupBy("obsid", "step").agg(F.array_sort(F.collect_list(entry)).alias("row"))
    lines = steps.join(counts, "obsid").select(
        "obsid", (F.col("step") + 2 + F.col("columns").cast("long")).alias("line_no"),
        F.concat_ws(" ", F.col("step").cast("string"),
                    F.concat_ws(" ", F.transform("row", lambda e: e["q"]))).alias("value"))
    return title.unionByName(inlet_lines).unionByName(lines)


def write_inflow_text(inflows: DataFrame, path: str) -> None:
    """A folder of ordered text per station."""
    (inflow_text(inflows).repartitionByRange("obsid", "line_no")
     .sortWithinPartitions("obsid", "line_no").select("obsid", "value")
     .write.mode("overwrite").partitionBy("obsid").text(path))
