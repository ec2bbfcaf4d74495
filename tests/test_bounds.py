"""Inputs beyond former bounds: NULL keys, long ids, many inlets, longer job numbers, shared cells."""

import pytest
from pyspark.sql import functions as F

from gaugeflow.functions.skew import running_total
from gaugeflow.functions.values import padded_id
from gaugeflow.operators import metrics, network
from gaugeflow.sources import jobs, tables


def test_null_keys_on_both_paths(spark):
    df = spark.createDataFrame([(None if i % 2 else 7, i) for i in range(40)], "k int, i int")
    plain, sliced = (sorted(map(tuple, running_total(df, ["k"], [F.asc("i")], "n", group_rows=g).collect()), key=str) for g in (100, 5))
    assert len(sliced) == 40 and plain == sliced


def test_long_ids_stay_whole(spark):
    df = spark.createDataFrame([(7,), (12345,), (123456,)], "i long")
    assert [r[0] for r in df.select(padded_id(F.col("i"))).collect()] == ["00007", "12345", "123456"]


def test_more_inlets_than_twenty(spark, tmp_path):
    path = tmp_path / "links.csv"
    path.write_text("ID," + ",".join(map(str, range(1, 26))) + "\n9," + ",".join(map(str, range(101, 126))) + "\n")
    assert sorted(r.upstream_id for r in tables.read_links(spark, str(path)).collect()) == list(range(101, 126))


def test_longer_job_numbers_and_other_files(spark):
    files = [("/x/cal_1.e123456", "a"), ("/x/cal_1.e1234567", "b"), ("/x/cal_1.o1234567", "c"), ("/x/notes.txt", "d"), ("/x/cal_1.e12", "e")]
    got = jobs.pair_logs(spark.createDataFrame(files, "file string, text string")).collect()
    assert {(r.job, r.err, r.out) for r in got} == {("123456", "a", None), ("1234567", "b", "c")}


def test_stations_on_one_cell_are_refused(spark):
    ldd = spark.createDataFrame([(i, i - 1 if i else None) for i in range(6)], "cell long, down long")
    with pytest.raises(ValueError, match="share cell 2"):
        network.interstation_regions(ldd, spark.createDataFrame([(1, 2), (2, 2)], "obsid long, cell long"))


def test_skill_of_one_pair_is_undefined(spark):
    pairs = spark.createDataFrame([(1, 1.0, 3.0), (2, 1.0, 2.0), (2, 2.0, 2.0)], "obsid int, s double, o double")
    assert {r.obsid: r.mae_skill for r in metrics.mae_skill(pairs, ["obsid"]).collect()} == {1: None, 2: 0.5}
