"""The skew-safe paths give the same results as the plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from gaugeflow.functions import skew


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows belong to station 1; values repeat often."""
    rng = random.Random(3)
    data = [(1 if i % 3 == 0 else 2 + i % 40, i, float(rng.choice([0, 0, 0, 1, 2, rng.random() * 50])))
            for i in range(9000)]
    return spark.createDataFrame(data, "obsid long, id long, v double").repartition(5).cache()


def test_running_total_slices_equal_window(hot):
    order = [F.desc("v"), F.asc("id")]
    plain = skew.running_total(hot, ["obsid"], order, "n")
    sliced = skew.running_total(hot, ["obsid"], order, "n", group_rows=10)
    assert rows(plain, "obsid", "id") == rows(sliced.select(plain.columns), "obsid", "id")


def test_running_total_without_keys(hot):
    sliced = skew.running_total(hot, [], [F.asc("id")], "n", group_rows=10)
    assert [r.n for r in sliced.orderBy("id").collect()] == list(range(1, 9001))


def test_running_total_of_weights(hot):
    weighted = hot.withColumn("w", F.col("id") % 4)
    plain = skew.running_total(weighted, ["obsid"], [F.asc("id")], "t", "w")
    sliced = skew.running_total(weighted, ["obsid"], [F.asc("id")], "t", "w", group_rows=10)
    assert rows(plain, "id") == rows(sliced.select(plain.columns), "id")


@pytest.mark.parametrize("group_rows", [10, 2_000_000])
def test_values_at_ranks_against_numpy(hot, group_rows):
    n = F.col("n")
    ranks = {f"p{p}": (n - 1) * p / 100 for p in (0, 1, 25, 50, 90, 100)}
    got = {r.obsid: r for r in skew.values_at_ranks(hot, ["obsid"], "v", ranks, group_rows=group_rows).collect()}
    values = {}
    for r in hot.collect():
        values.setdefault(r.obsid, []).append(r.v)
    assert set(got) == set(values)
    for obsid, sample in values.items():
        for p in (0, 1, 25, 50, 90, 100):
            assert got[obsid][f"p{p}"] == pytest.approx(np.percentile(sample, p), abs=1e-9)


@pytest.mark.parametrize("group_rows", [10, 2_000_000])
def test_null_rank_gives_null(hot, group_rows):
    ranks = {"some": F.when(F.col("n") > 1000, F.lit(5)), "first": F.lit(0)}
    got = {r.obsid: r for r in skew.values_at_ranks(
        hot, ["obsid"], "id", ranks, interpolate=False, group_rows=group_rows).collect()}
    assert got[1].some is not None and got[2].some is None
    assert all(r["first"] is not None for r in got.values())


def test_open_brackets_repair_a_wrong_sketch(hot, monkeypatch):
    real = skew._brackets

    def wrong(base, keys, outs, wanted, sketched):
        table = real(base, keys, outs, wanted, sketched)
        if sketched:
            table = table.withColumns({f"_{end}_{o}": F.lit(1.0) for o in outs for end in ("from", "to")})
        return table

    monkeypatch.setattr(skew, "_brackets", wrong)
    ranks = {"median": (F.col("n") - 1) * 0.9}
    got = {r.obsid: r.median for r in skew.values_at_ranks(hot, ["obsid"], "v", ranks, group_rows=10).collect()}
    sample = [r.v for r in hot.filter("obsid = 1").collect()]
    assert got[1] == pytest.approx(np.percentile(sample, 90), abs=1e-9)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, hot, how):
    table = spark.range(0, 30).select(F.col("id").alias("obsid"), (F.col("id") * 7).alias("w"))
    with_nulls = hot.withColumn("obsid", F.when(F.col("id") % 11 != 0, F.col("obsid")))
    plain = with_nulls.join(table, ["obsid"], how)
    salted = skew.salted_join(with_nulls, table, ["obsid"], how, hot_rows=100)
    assert rows(plain, "id") == rows(salted.select(plain.columns), "id")


def test_attach_past_the_broadcast_bound(spark, hot):
    table = spark.range(0, 60).select(F.col("id").alias("obsid"), (F.col("id") * 7).alias("w"))
    small = skew.attach(hot, table, ["obsid"])
    large = skew.attach(hot, table, ["obsid"], max_rows=5, hot_rows=100)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert rows(small, "id") == rows(large.select(small.columns), "id")


def test_hot_keys_are_bounded(hot):
    assert [r.obsid for r in skew.hot_keys(hot, ["obsid"], 1000).collect()] == [1]
    assert skew.hot_keys(hot, ["obsid"], 10**9).isEmpty()
