"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and benches; a cluster passes its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gaugeflow")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a scratch folder only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="gaugeflow-")
    context.setCheckpointDir(named)
    return named


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table on shared storage and read it back.

    Later plans start from the table: it is computed once, survives lost executors, is read by
    column, and its size is known. A plain table is used instead of ``checkpoint()`` because a
    checkpointed plan keeps the inferred constraints of its origin, and in a loop they multiply
    until planning takes longer than the work. The tables are scratch, like checkpoints.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
