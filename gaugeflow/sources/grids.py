"""Grid variables as files: tiles of cells, cut by year, of which only the covered ones are read.

``path/var=../tile_x=../tile_y=../year=../`` holds rows ``(x, y, ts, value)``. A variable without a time
axis has ts NULL and no year. A part is bounded by its cells and the steps of a year, so it does not
grow with the record or the grid. The tile size is stored beside the parts.

Rows without coordinates lie in no tile and are dropped by ``write_grid``; NULL values and repeated rows
are kept; a grid without rows is read back empty.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach
from gaugeflow.operators.grid import TILE, clip_to_boxes, covered_tiles
from gaugeflow.session import settle
from gaugeflow.sources.tables import write_table

PARTS = ["var", "tile_x", "tile_y", "year"]
SCHEMA = "x long, y long, ts timestamp, value double, var string, tile_x long, tile_y long, year int"
LAYOUT = "_layout"
BACKUP = "bak"  # fixed value: files with it in their name are not grids


def write_grid(grid: DataFrame, path: str, tile: int = TILE) -> None:
    """Write ``(var, y, x[, ts], value)`` as tiles; only the parts present in ``grid`` are replaced."""
    spark = grid.sparkSession
    if "ts" not in grid.columns:
        grid = grid.withColumn("ts", F.lit(None).cast("timestamp"))
    placed = grid.filter("x IS NOT NULL AND y IS NOT NULL").select(
        F.col("x").cast("long"), F.col("y").cast("long"), "ts", F.col("value").cast("double"), "var",
        F.floor(F.col("x") / tile).alias("tile_x"), F.floor(F.col("y") / tile).alias("tile_y"), F.year("ts").alias("year"))
    write_table(placed.repartition(*PARTS).sortWithinPartitions(*PARTS, "ts", "y", "x"), path, PARTS)
    write_table(spark.range(1).select(F.lit(tile).alias("tile")), f"{path}/{LAYOUT}")


def tile_size(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(f"{path}/{LAYOUT}").first()["tile"]


def read_grid(spark: SparkSession, path: str, names: list[str] | None = None, first: datetime | None = None,
              last: datetime | None = None, tiles: DataFrame | None = None) -> DataFrame:
    """``(var, y, x, ts, value)`` of the variables, times (both ends included) and tiles asked for.

    All of them choose files: names and years by partition, ``tiles (tile_x, tile_y)`` by dynamic
    pruning, and files with ``bak`` in their name below ``path`` by the listing. Variables without a
    time axis belong to every time.
    """
    below = F.element_at(F.split(F.col("_metadata.file_path"), re.escape(path.rstrip("/")) + "/", 2), -1)
    rows = spark.read.schema(SCHEMA).parquet(path).filter(~F.contains(below, F.lit(BACKUP)))
    if names is not None:
        rows = rows.filter(F.col("var").isin(names))
    if first is not None:
        rows = rows.filter(F.col("year").isNull() | ((F.col("year") >= first.year) & (F.col("ts") >= F.lit(first))))
    if last is not None:
        rows = rows.filter(F.col("year").isNull() | ((F.col("year") <= last.year) & (F.col("ts") <= F.lit(last))))
    if tiles is not None:
        rows = attach(rows, tiles, ["tile_x", "tile_y"], "left_semi")
    return rows.select("var", "y", "x", "ts", "value")


def clip_grids(spark: SparkSession, path: str, boxes: DataFrame, names: list[str] | None = None,
               first: datetime | None = None, last: datetime | None = None) -> DataFrame:
    """``(obsid, var, y, x, ts, value)``: every variable in the box of every station, from covered tiles alone."""
    tile = tile_size(spark, path)
    boxes = boxes.filter("x0 <= x1 AND y0 <= y1")
    tiles = settle(covered_tiles(boxes, tile).select("tile_x", "tile_y").distinct())
    # the comparison is always true here: only a table behind one prunes the other side's files
    stored = read_grid(spark, path, names, first, last, tiles.filter("tile_x >= -9223372036854775807"))
    return clip_to_boxes(stored, boxes, tile).select("obsid", "var", "y", "x", "ts", "value")
