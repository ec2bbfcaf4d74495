"""Readers of job logs and folder listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: error and output logs of a job share catchment and job number (six digits or more).
LOG_NAME = r"_([0-9]+)\.([eo])([0-9]{6,})$"


def read_job_logs(spark: SparkSession, path: str) -> DataFrame:
    """(catchment, job, err, out): the two logs of each job as whole texts."""
    files = spark.read.option("pathGlobFilter", "*_*.[eo][0-9]*").text(path, wholetext=True)
    return pair_logs(files.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")))


def pair_logs(files: DataFrame) -> DataFrame:
    """(catchment, job, err, out) from ``(file, text)``; a job is listed by its error log."""
    part = {name: F.regexp_extract("file", LOG_NAME, i)
            for i, name in enumerate(["catchment", "kind", "job"], start=1)}
    named = files.select(F.nullif(part["catchment"], F.lit("")).cast("long").alias("catchment"), part["kind"].alias("kind"),
                         part["job"].alias("job"), "text").filter("kind <> ''")  # other files are skipped
    return (named.groupBy("catchment", "job")
            .agg(F.max(F.when(F.col("kind") == "e", F.col("text"))).alias("err"),
                 F.max(F.when(F.col("kind") == "o", F.col("text"))).alias("out"))
            .filter("err IS NOT NULL"))


def list_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(catchment, folder, length) of every file; ``pattern`` captures catchment and folder.

    Only names and sizes are selected, so no content is read.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select("path", "length"))
    return (files.withColumn("catchment", F.regexp_extract("path", pattern, 1))
            .withColumn("folder", F.regexp_extract("path", pattern, 2))
            .filter("catchment <> ''").select("catchment", "folder", "length"))
