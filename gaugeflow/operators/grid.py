"""Grids as cell tables: clipping to stations, painting station values, masks and outlets.

``cells(cell, y, x, region)``; a grid variable is ``(var, y, x[, ts], value)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import HOT_ROWS, attach, attach_stats
from gaugeflow.operators.network import NO_STATION
from gaugeflow.session import settle

TILE = 64  # cells along one side of a join tile


def bounding_boxes(cells: DataFrame, station: str = "region") -> DataFrame:
    """Smallest box of cells around each station's mask; both ends belong to it."""
    return (cells.filter(F.col(station) != NO_STATION)
            .groupBy(F.col(station).alias("obsid"))
            .agg(F.min("x").alias("x0"), F.max("x").alias("x1"),
                 F.min("y").alias("y0"), F.max("y").alias("y1")))


def _tiles(low: str, high: str, tile: int) -> Column:
    return F.sequence(F.floor(F.col(low) / tile), F.floor(F.col(high) / tile))


def covered_tiles(boxes: DataFrame, tile: int = TILE) -> DataFrame:
    """A row for each tile that a box touches."""
    return (boxes.withColumn("tile_x", F.explode(_tiles("x0", "x1", tile)))
            .withColumn("tile_y", F.explode(_tiles("y0", "y1", tile))))


def clip_to_boxes(grid: DataFrame, boxes: DataFrame, tile: int = TILE,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Grid rows inside each station's box.

    Boxes are cut into tiles so the range condition becomes an equality on the tile; the exact
    box test follows inside a tile.
    """
    placed = (grid.withColumn("tile_x", F.floor(F.col("x") / tile))
              .withColumn("tile_y", F.floor(F.col("y") / tile)))
    return (attach(placed, settle(covered_tiles(boxes, tile)), ["tile_x", "tile_y"], hot_rows=hot_rows)
            .filter(F.col("x").between(F.col("x0"), F.col("x1"))
                    & F.col("y").between(F.col("y0"), F.col("y1")))
            .drop("tile_x", "tile_y", "x0", "x1", "y0", "y1"))


def mask_values(clipped: DataFrame, masks: DataFrame) -> DataFrame:
    """Clipped rows with the value kept inside the station's mask and NULL elsewhere."""
    inside = masks.select("obsid", "x", "y", F.lit(True).alias("_inside"))
    return (clipped.join(inside, ["obsid", "x", "y"], "left")
            .withColumn("value", F.when(F.col("_inside"), F.col("value"))).drop("_inside"))


def cells_in_masks(grid: DataFrame, masks: DataFrame) -> DataFrame:
    """Grid rows of the cells that belong to a mask."""
    return grid.join(masks, ["x", "y"], "left_semi")


def station_masks(cells: DataFrame) -> DataFrame:
    """(obsid, cell, x, y): the interstation region of every station."""
    return cells.filter(F.col("region") != NO_STATION).select(
        F.col("region").alias("obsid"), "cell", "x", "y")


def outlets(gauges: DataFrame, cells: DataFrame) -> DataFrame:
    """Station cells that lie in their own mask."""
    masks = station_masks(cells)
    return gauges.join(masks, ["obsid", "cell"], "inner")


def inlets_in_masks(inlets: DataFrame, cells: DataFrame) -> DataFrame:
    """Inlets that lie in the mask of the station they feed, with their coordinates."""
    return inlets.join(station_masks(cells), ["obsid", "cell"], "inner")


def override_values(values: DataFrame, overrides: DataFrame) -> DataFrame:
    """Station parameter values replaced where an override names station and parameter."""
    fixed = overrides.select("obsid", "param", F.col("value").alias("_fixed"))
    return (attach(values, fixed, ["obsid", "param"], "left")
            .withColumn("value", F.coalesce("_fixed", "value")).drop("_fixed"))


def mosaic(cells: DataFrame, stations: DataFrame, values: DataFrame, defaults: DataFrame,
           uncalibrated: float | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(cell, region, param, value) for all parameters in one pass.

    A cell takes the value of its station, the default where no station is downstream, and
    ``uncalibrated`` (or the default, when None) where the station has no value. Regions without
    a row in ``stations`` (unknown area) take the default. Station values are packed per station
    first, so a large region is read once, not once per parameter.
    """
    names = defaults.agg(F.sort_array(F.collect_list(F.struct("param", F.col("value").alias("fallback"))))
                         .alias("_params"))
    packed = values.groupBy("obsid").agg(
        F.map_from_entries(F.collect_list(F.struct("param", "value"))).alias("_values"))
    known = attach_stats(stations.select("obsid"), packed, ["obsid"], "left").select(
        F.col("obsid").alias("region"), "_values", F.lit(True).alias("_known"))
    painted = attach_stats(cells.select("cell", "region"), known, ["region"], "left")
    listed = names.first()["_params"]  # one row per parameter of the model
    params = F.array(*[F.struct(F.lit(p.param).alias("param"), F.lit(float(p.fallback)).alias("fallback"))
                       for p in listed])
    missing = F.col("fallback") if uncalibrated is None else F.lit(float(uncalibrated))
    own = F.try_element_at("_values", F.col("param"))
    return (painted.select("cell", "region", "_values", "_known", F.inline(params))
            .select("cell", "region", "param",
                    F.when(F.col("_known"), F.coalesce(own, missing)).otherwise(F.col("fallback"))
                    .alias("value")))


def calibration_counts(stations: DataFrame, values: DataFrame) -> DataFrame:
    """How many stations have calibrated values and how many have not."""
    marks = values.select("obsid").distinct().withColumn("_has", F.lit(True))
    return stations.join(marks, "obsid", "left").agg(
        F.count_if(F.col("_has").isNotNull()).alias("calibrated"),
        F.count_if(F.col("_has").isNull()).alias("uncalibrated"))
