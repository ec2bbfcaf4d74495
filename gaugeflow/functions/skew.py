"""Joins and orderings that hold when one key owns a large share of the rows.

Three rules are used throughout the package:

* a table is broadcast only after its rows were counted against a bound;
* a many-to-one join salts the keys that were counted as hot;
* an ordering inside a group is cut into range slices once a group is too large for one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.session import settle

BROADCAST_ROWS = 200_000  # widest table passed here is about 100 bytes a row
HOT_ROWS = 1_000_000
HOT_KEYS = 1_000
SALTS = 64
GROUP_ROWS = 2_000_000
GRID_STEPS = 200  # quantiles kept per group by the sketch
SKETCH_FINENESS = 20  # sketch ranks are this much finer than the grid


def attach(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner",
           max_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join a per-group table to rows: broadcast within the bound, salted beyond it.

    ``table`` is read twice (count, join), so derived tables are settled by the caller.
    """
    if table.limit(max_rows + 1).count() <= max_rows:
        return rows.join(F.broadcast(table), keys, how)
    return salted_join(rows, table, keys, how, hot_rows)


def attach_stats(rows: DataFrame, stats: DataFrame, keys: list[str], how: str = "inner",
                 max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``attach`` for a table aggregated from large rows: it is computed once, then counted."""
    return attach(rows, settle(stats), keys, how, max_rows)


def hot_keys(rows: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with at least ``hot_rows`` rows; at most ``HOT_KEYS`` of them, the largest first.

    Keys past the largest ``HOT_KEYS`` each hold under 1/HOT_KEYS of the rows, so they need no salt.
    """
    return (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") >= hot_rows)
        .orderBy(F.desc("_rows"), *keys).limit(HOT_KEYS)
        .select(*keys, F.lit(True).alias("_hot"))
    )


def salted_join(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner",
                hot_rows: int = HOT_ROWS, salts: int = SALTS, n_rows: int | None = None) -> DataFrame:
    """Join where ``rows`` may hold hot keys; only hot keys of ``table`` are replicated.

    ``n_rows`` is the number of rows where the caller has counted them: fewer than ``hot_rows``
    cannot hold a hot key.
    """
    if n_rows is not None and n_rows < hot_rows:
        return rows.join(table, keys, how)
    found = hot_keys(rows, keys, hot_rows)
    largest = found.collect()  # at most HOT_KEYS rows
    if not largest:
        return rows.join(table, keys, how)
    hot = rows.sparkSession.createDataFrame(largest, found.schema)
    content = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.when(F.col("_hot") | no_key, content).otherwise(F.lit(0)))
        .drop("_hot")
    )
    copies = (
        table.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
            .otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")


def largest_group(df: DataFrame, keys: list[str]) -> int:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.agg(F.max("_rows")).first()[0] or 0


def running_total(df: DataFrame, keys: list[str], order: list[Column], name: str,
                  weight: str | None = None, group_rows: int = GROUP_ROWS,
                  largest: int | None = None) -> DataFrame:
    """Running total of ``weight`` per group in ``order``; the row number when no weight is given.

    ``order`` must be a total order within a group. Groups within ``group_rows`` use a plain
    window. Otherwise the rows are range-partitioned by (keys, order), each slice is summed on
    its own, and the totals of the earlier slices (one row per group and slice) are added.
    ``largest`` is the size of the largest group where the caller has counted it already.
    """
    step = F.col(weight) if weight else F.lit(1).cast("long")
    if largest is None:
        largest = largest_group(df, keys)
    if largest <= group_rows:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(name, F.sum(step).over(window))

    slices = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sliced = settle(
        df.repartitionByRange(slices, *[F.col(k) for k in keys], *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    slice_key = [*keys, "_slice"]
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    before = (
        sliced.groupBy(*slice_key).agg(F.sum(step).alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_slice_{k}") for k in keys], F.col("_slice").alias("_slice_no"), "_before")
    )
    same_slice = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_slice_{k}")) for k in keys],
                        F.col("_slice") == F.col("_slice_no"))
    within = Window.partitionBy(*slice_key).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        sliced.withColumn("_within", F.sum(step).over(within))
        .join(before, same_slice)
        .withColumn(name, F.col("_before") + F.col("_within"))
        .drop("_slice", "_within", "_before", "_slice_no", *[f"_slice_{k}" for k in keys])
    )


def running_max(df: DataFrame, keys: list[str], order: list[Column], value: str, name: str,
                group_rows: int = GROUP_ROWS) -> DataFrame:
    """Largest ``value`` of the rows of a group before each row in ``order``; NULL for the first.

    ``df`` is read twice, so derived tables are settled by the caller. Large groups are cut into
    range slices as in ``running_total``: the largest values of the earlier slices are added.
    """
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    if largest_group(df, keys) <= group_rows:
        return df.withColumn(name, F.max(value).over(before))
    slices = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sliced = settle(df.repartitionByRange(slices, *[F.col(k) for k in keys], *order)
                    .withColumn("_slice", F.spark_partition_id()))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    tops = (sliced.groupBy(*keys, "_slice").agg(F.max(value).alias("_top"))
            .withColumn("_top", F.max("_top").over(earlier)))
    within = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (attach_stats(sliced.withColumn("_in_slice", F.max(value).over(within)), tops, [*keys, "_slice"])
            .withColumn(name, F.greatest("_in_slice", "_top")).drop("_slice", "_in_slice", "_top"))


def _pick(rank: Column, at, out: str, interpolate: bool) -> tuple[list[Column], Column, Column]:
    """Aggregates that fetch the values around a rank, the result, and whether one was not found."""
    low = F.floor(rank)
    picks = [at(low).alias(f"_low_{out}"), F.max(low).alias(f"_at_{out}")]
    low_v, missed = F.col(f"_low_{out}"), F.col(f"_low_{out}").isNull() & F.col(f"_at_{out}").isNotNull()
    if not interpolate:
        return picks, low_v.alias(out), missed
    picks += [at(low + 1).alias(f"_high_{out}"), F.max(rank - low).alias(f"_part_{out}")]
    part, high_v = F.col(f"_part_{out}"), F.col(f"_high_{out}")
    value = low_v + F.when(part > 0, part * (high_v - low_v)).otherwise(F.lit(0.0))
    return picks, value.alias(out), missed | ((part > 0) & high_v.isNull())


def values_at_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Column],
                    groups: DataFrame | None = None, interpolate: bool = True,
                    group_rows: int = GROUP_ROWS) -> DataFrame:
    """Exact order statistics per group.

    ``ranks`` maps an output column to a 0-based, possibly fractional rank, written over the
    columns of ``groups`` (one row per group with its size ``n``, and only ``n`` when not given).
    ``df`` is scanned more than once, so a derived table is settled by the caller. Groups within
    ``group_rows`` are ranked by a window; larger ones are narrowed by a sketch first.
    """
    base = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    sizes = settle(base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    groups = sizes if groups is None else groups
    wanted = settle(groups.select(
        *keys, "n", *[rank.cast("double").alias(f"_rank_{out}") for out, rank in ranks.items()]))
    if (sizes.agg(F.max("n")).first()[0] or 0) > group_rows:
        return _narrowed(base, keys, list(ranks), wanted, interpolate, group_rows, sketched=True)

    order = Window.partitionBy(*keys).orderBy("_v")
    placed = attach(base, wanted, keys).withColumn("_i", F.row_number().over(order) - 1)

    def at(position: Column) -> Column:
        return F.max(F.when(F.col("_i") == position, F.col("_v")))

    parts = [_pick(F.col(f"_rank_{out}"), at, out, interpolate) for out in ranks]
    return (placed.groupBy(*keys).agg(*[c for picks, _, _ in parts for c in picks])
            .select(*keys, *[result for _, result, _ in parts]))


def _brackets(base: DataFrame, keys: list[str], outs: list[str], wanted: DataFrame,
              sketched: bool) -> DataFrame:
    """A value range that should hold each wanted rank; a NULL end is open.

    The range comes from a quantile sketch, one grid step wider than the rank on both sides.
    """
    if not sketched:
        kind = base.schema["_v"].dataType
        return wanted.withColumns({f"_{end}_{out}": F.lit(None).cast(kind)
                                   for out in outs for end in ("from", "to")})
    grid = [i / GRID_STEPS for i in range(GRID_STEPS + 1)]
    sketch = base.groupBy(*keys).agg(
        F.percentile_approx("_v", grid, GRID_STEPS * SKETCH_FINENESS).alias("_grid"))
    per_step = F.col("n") / GRID_STEPS
    ends = {}
    for out in outs:
        low = F.floor(F.col(f"_rank_{out}"))
        first = F.floor(low / per_step).cast("int") - 1
        last = F.ceil((low + 2) / per_step).cast("int") + 1
        ends[f"_from_{out}"] = F.when(first > 0, F.get("_grid", first))
        ends[f"_to_{out}"] = F.when(last < GRID_STEPS, F.get("_grid", last))
    return wanted.join(sketch, keys).withColumns(ends).drop("_grid")


def _narrowed(base: DataFrame, keys: list[str], outs: list[str], wanted: DataFrame, interpolate: bool,
              group_rows: int, sketched: bool) -> DataFrame:
    """Order statistics in two scans, without sorting or shuffling whole groups.

    The first scan brackets each wanted rank. The second one counts the values inside the
    brackets by value, and the rest of a group as a single row. Only values inside the brackets
    are put in order. A group whose bracket missed its rank is done again with open brackets.
    """
    brackets = settle(_brackets(base, keys, outs, wanted, sketched))
    v = F.col("_v")

    def inside(out: str) -> Column:
        low, high = F.col(f"_from_{out}"), F.col(f"_to_{out}")
        return (F.col(f"_rank_{out}").isNotNull()
                & (low.isNull() | (v >= low)) & (high.isNull() | (v <= high)))

    candidate = reduce(lambda x, y: x | y, [inside(out) for out in outs])
    counted = settle(
        attach(base, brackets, keys)
        .groupBy(*keys, F.when(candidate, v).alias("_c")).agg(
            F.count(F.lit(1)).alias("_w"),
            *[F.count_if(v < F.col(f"_from_{out}")).alias(f"_below_{out}") for out in outs]))
    outside = counted.filter("_c IS NULL").select(*keys, *[f"_below_{out}" for out in outs])
    inner = counted.filter("_c IS NOT NULL").select(*keys, F.col("_c").alias("_v"), "_w")
    ordered = running_total(inner, keys, [F.asc("_v")], "_upto", "_w", group_rows)
    placed = attach(ordered, settle(brackets.join(outside, keys, "left")), keys)

    def at_in(out: str):
        last = F.col("_upto") + F.coalesce(f"_below_{out}", F.lit(0))
        return lambda i: F.max(F.when((i >= last - F.col("_w")) & (i < last) & inside(out), v))

    parts = [_pick(F.col(f"_rank_{out}"), at_in(out), out, interpolate) for out in outs]
    missed = reduce(lambda x, y: x | y, [miss for _, _, miss in parts])
    found = settle(placed.groupBy(*keys).agg(*[c for picks, _, _ in parts for c in picks])
                   .withColumn("_missed", missed))
    again = found.filter("_missed").select(*keys)
    results = [result for _, result, _ in parts]
    if not sketched or again.isEmpty():
        return found.select(*keys, *results)
    rest = _narrowed(base.join(again, keys, "left_semi"), keys, outs,
                     wanted.join(again, keys, "left_semi"), interpolate, group_rows, sketched=False)
    return found.filter("NOT _missed").select(*keys, *results).unionByName(rest)
