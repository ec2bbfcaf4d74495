"""Tables from job logs and folder listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The lines of a job log.
REAL_TIME = r"(?m)^real\t(\d+)m(\d+)\."
FIRST_GENERATION = r"(?ms)^Starting calibration$.*?^Generation (\d{1,3})"
DRAINING_AREA = r"(?m)^DrainingArea\.km2\.LDD {10}\s*([^\n]+)"
INFLOWS = r"(?m)^Found ([^\n]*?) ?inflows$"
TIME_ELAPSED = "\n>> Time elapsed: "
DONE = r"Done generation (\d+)$"
LAST_GEN = r">> gen: (\d+), effmax_KGE: ([^\n]*)\n(?:>> Termination criterion [^\n]*\n)+Done generation "
LAST_GENERATION = ">> Termination criterion maxGen fulfilled."
NO_IMPROVEMENT = ">> Termination criterion no-improvement KGE fulfilled."


def _blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _seconds(times: Column, position: int) -> Column:
    """The position-th wall time of an error log, in whole seconds."""
    line = F.get(times, F.lit(position))
    return (F.regexp_extract(line, REAL_TIME, 1).cast("long") * 60
            + F.regexp_extract(line, REAL_TIME, 2).cast("long"))


def job_table(logs: DataFrame) -> DataFrame:
    """One row per job from ``(catchment, job, err, out)`` texts; what a log lacks is NULL.

    The end of a log is cut out once by plain text search; patterns only see those few lines.
    """
    head = F.substring_index("out", TIME_ELAPSED, 1)
    rest = F.substring(F.col("out"), F.length(head) + F.lit(len(TIME_ELAPSED) + 1), F.length("out"))
    rest = F.substring_index(rest, "\n", 1)
    parts = logs.select(
        "catchment", "job", "out", F.regexp_extract_all("err", F.lit(REAL_TIME), F.lit(0)).alias("times"),
        (F.length(head) < F.length("out")).alias("finished"),
        F.substring_index(head, "\n", -4).alias("tail"),
        F.substring_index(rest, " ", 1).alias("elapsed"))
    finished, tail = F.col("finished"), F.col("tail")
    done = F.regexp_extract(tail, DONE, 1)
    max_gen = F.contains(tail, F.lit(LAST_GENERATION))
    stalled = F.contains(tail, F.lit(NO_IMPROVEMENT))
    shown = F.regexp_extract(tail, LAST_GEN, 1)
    kge = F.when((shown != "") & (shown == done), F.regexp_extract(tail, LAST_GEN, 2))
    out = F.col("out")
    return parts.select(
        "catchment", "job",
        _seconds(F.col("times"), 0).alias("calib_sec"), _seconds(F.col("times"), 1).alias("longrun_sec"),
        _blank_to_null(F.regexp_extract(out, DRAINING_AREA, 1)).alias("draining_area"),
        _blank_to_null(F.regexp_extract(out, INFLOWS, 1)).cast("long").alias("inflows"),
        F.when(finished, F.coalesce(_blank_to_null(F.regexp_extract(out, FIRST_GENERATION, 1))
                                    .cast("long"), F.lit(-1))).alias("first_gen"),
        F.when(finished, F.col("elapsed").cast("double")).alias("elapsed_sec"),
        F.when(finished, _blank_to_null(done).cast("long")).alias("last_gen"),
        F.when(finished & max_gen & stalled, F.lit("maxGen AND no-improvement"))
        .when(finished & stalled, F.lit("no-improvement"))
        .when(finished & max_gen, F.lit("maxGen")).alias("termination"),
        F.when(finished, F.coalesce(kge, F.lit("error"))).alias("kge"))


def folder_sizes(files: DataFrame, folders: list[str]) -> DataFrame:
    """Summed file size in KB per catchment and folder from ``(catchment, folder, length)``."""
    sizes = files.groupBy("catchment").pivot("folder", folders).agg(
        F.ceil(F.sum("length") / 1024).cast("long"))
    return sizes.select("catchment", *[F.col(f"`{f}`").alias(f"{f}_kb") for f in folders])
