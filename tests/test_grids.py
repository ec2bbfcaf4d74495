"""Grid files: round trips, and files that a reader must not open."""

from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gaugeflow.sources import grids

SCHEMA = "var string, y long, x long, ts timestamp, value double"


def frame(spark):
    cells = [("elev", y, x, None, float(x * 100 + y)) for x in range(-3, 9) for y in range(9)]
    steps = [(name, y, x, datetime(year, 12, 31), float(year + x + y)) for name in ("rain", "heat")
             for x in range(9) for y in range(9) for year in (2000, 2001)]
    return spark.createDataFrame([*cells, *steps, ("elev", 1, 1, None, None), ("elev", None, 1, None, 3.0)], SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("grids") / "maps")
    grids.write_grid(frame(spark), path, tile=4)
    grids.write_grid(frame(spark).filter("var = 'rain'").withColumn("var", F.lit("rain_bak")), path, tile=4)
    return path


def unreadable(path, *patterns):
    """Files without their content: whoever opens one fails."""
    found = [f for p in patterns for f in Path(path).glob(p)]
    assert found
    for f in found:
        f.write_bytes(b"no grid")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)


def test_round_trip_without_backups(spark, folder):
    order = ("var", "x", "y", "ts", "value")
    assert rows(grids.read_grid(spark, folder), *order) == rows(frame(spark).filter("y is not null"), *order)
    only = grids.read_grid(spark, folder, ["rain", "elev"], datetime(2001, 1, 1))
    assert only.count() == 12 * 9 + 1 + 81 and only.filter("ts < '2001-01-01'").isEmpty()
    assert grids.read_grid(spark, folder, ["heat"], last=datetime(2000, 12, 30)).isEmpty()


def test_parts_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "maps")
    grids.write_grid(frame(spark), path, tile=4)
    grids.write_grid(frame(spark).filter("var = 'rain' and ts > '2001-01-01' and x < 4 and y < 4")
                     .withColumn("value", F.lit(-1.0)), path, tile=4)
    got = grids.read_grid(spark, path)
    assert got.filter("value = -1").count() == 16 and got.count() == frame(spark).count() - 1


def test_clip_matches_plain_filter(spark, folder):
    boxes = [(1, 0, 5, 2, 2), (2, -3, -3, 0, 8), (3, 8, 8, 8, 8), (4, 50, 60, 0, 1), (5, 3, 2, 0, 8)]
    got = grids.clip_grids(spark, folder, spark.createDataFrame(boxes, "obsid long, x0 long, x1 long, y0 long, y1 long"))
    plain = [(i, *r) for i, x0, x1, y0, y1 in boxes for r in rows(frame(spark))
             if r[1] is not None and x0 <= r[2] <= x1 and y0 <= r[1] <= y1]

    def key(r):
        return tuple((c is not None, c or 0) if not isinstance(c, datetime) else (True, c.year) for c in r)

    assert sorted(rows(got), key=key) == sorted(plain, key=key)


def test_other_files_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "maps")
    grids.write_grid(frame(spark), path, tile=4)
    grids.write_grid(frame(spark).filter("var = 'rain'").withColumn("var", F.lit("rain_bak")), path, tile=4)
    unreadable(path, "var=rain_bak/*/*/*/*.parquet", "var=heat/*/*/*/*.parquet", "var=rain/*/*/year=2000/*.parquet",
               "var=*/tile_x=2/*/*/*.parquet", "var=*/*/tile_y=0/*/*.parquet")
    boxes = spark.createDataFrame([(1, 5, 6, 4, 7), (2, 2, 4, 5, 5)], "obsid long, x0 long, x1 long, y0 long, y1 long")
    got = grids.clip_grids(spark, path, boxes, ["rain", "elev", "rain_bak"], first=datetime(2001, 1, 1))
    assert got.groupBy("obsid", "var").count().orderBy("obsid", "var").collect() == [
        (1, "elev", 8), (1, "rain", 8), (2, "elev", 3), (2, "rain", 3)]


def test_empty_grid(spark, tmp_path):
    path = str(tmp_path / "maps")
    grids.write_grid(frame(spark).limit(0), path)
    boxes = spark.createDataFrame([(1, 0, 5, 2, 2)], "obsid long, x0 long, x1 long, y0 long, y1 long")
    assert grids.clip_grids(spark, path, boxes).isEmpty()
