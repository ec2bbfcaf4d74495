"""First-come placement along rivers: every mark takes the first free cell at or below its own.

Marks are served in a given order. Doing that one after the other needs a step per mark; here the
rounds grow with logarithms only, on three facts:

* Which cells end up taken does not depend on the order. So marks can first be counted as equal
  tokens: the tokens of one cell claim the next cells that are still free, found with jump tables of
  powers of two, and where claims overlap one token stays and the rest goes on below the taken run.
  Every run that still has tokens to spare meets another such run in each round.
* Marks of one run of taken cells only meet each other, so runs are solved side by side.
* In a run, the earlier half of the marks takes the same cells whether the later half exists or not.
  So a run is divided: its first half keeps the cells it takes, its second half is left with the
  others, and both are runs of half the marks. A run of one mark is done.

Marks on one cell are counted before they are joined, so a hot cell is one row there; joins of the
marks themselves are salted. Tables are (keys, cell, next) with unique (keys, cell).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import HOT_ROWS, attach, running_total, salted_join
from gaugeflow.session import settle

MAX_ROUNDS = 62  # doubling passes any acyclic path of a 64-bit cell count by then


def follow(links: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, n_rows: int | None = None) -> DataFrame:
    """(keys, cell, end): where the chain of ``links`` from a cell leaves the linked cells.

    ``n_rows`` is a bound of their number where the caller knows one.

    Steps are doubled. A cell whose chain has ended is written once and leaves the loop; the others
    still read it, so tables shrink from round to round.
    """
    linked = links.select(*keys, F.col("cell").alias("end"), F.lit(True).alias("_moves"))
    state = settle(salted_join(links.select(*keys, "cell", F.col("next").alias("end")), linked, [*keys, "end"], "left", hot_rows, n_rows=n_rows)
                   .select(*keys, "cell", "end", F.coalesce("_moves", F.lit(False)).alias("_moves")))
    ended, moving = [state.filter("NOT _moves")], state.filter("_moves")
    for _ in range(MAX_ROUNDS):
        n_moving = moving.count()
        if not n_moving:
            return reduce(DataFrame.unionByName, ended).drop("_moves")
        ahead = reduce(DataFrame.unionByName, ended, moving).select(
            *keys, F.col("cell").alias("end"), F.col("end").alias("_end"), F.col("_moves").alias("_on"))
        state = settle(salted_join(moving.drop("_moves"), ahead, [*keys, "end"], "inner", hot_rows, n_rows=n_moving)
                       .select(*keys, "cell", F.col("_end").alias("end"), F.col("_on").alias("_moves")))
        ended, moving = [*ended, state.filter("NOT _moves")], state.filter("_moves")
    raise ValueError("the links have a cycle")


def _moved(rows: DataFrame, jump: DataFrame, keys: list[str]) -> DataFrame:
    """Rows at the cell their jump leads to; those without one have left the river."""
    return (rows.join(jump, [*keys, "cell"]).filter("next IS NOT NULL")
            .withColumn("cell", F.col("next")).drop("next"))


def _claims(tokens: DataFrame, jumps: list[DataFrame], keys: list[str]) -> DataFrame:
    """(keys, cell, n): the n tokens of a cell claim it and the n - 1 free cells after it, once each.

    A count is cut into stretches of powers of two, and these into halves down to single cells.
    """
    top = len(jumps) - 1
    stretches, at = [], tokens
    for k in range(top, -1, -1):
        has = F.col("n").bitwiseAND(1 << k) != 0
        stretches.append(at.filter(has).select(*keys, "cell", F.lit(1).cast("long").alias("n")))
        if k:
            at = settle(at.filter(~has).unionByName(_moved(at.filter(has), jumps[k], keys)))
    claims = stretches[0]
    for k, more in zip(range(top - 1, -1, -1), stretches[1:]):
        halves = claims.unionByName(_moved(claims, jumps[k], keys)).unionByName(more)
        claims = settle(halves.groupBy(*keys, "cell").agg(F.sum("n").alias("n")))
    return claims


def without(links: DataFrame, gone: DataFrame, keys: list[str], hot_rows: int, n_rows: int) -> tuple[DataFrame, DataFrame]:
    """The links past the cells of ``gone``, and (keys, cell, end): the first other cell below each of these."""
    passed = follow(links.join(gone, [*keys, "cell"], "left_semi"), keys, hot_rows, n_rows)
    over = passed.select(*keys, F.col("cell").alias("next"), F.col("end").alias("_end"), F.lit(True).alias("_over"))
    kept = links.join(gone, [*keys, "cell"], "left_anti")
    return settle(salted_join(kept, over, [*keys, "next"], "left", hot_rows, n_rows=n_rows).select(
        *keys, "cell", F.when(F.col("_over"), F.col("_end")).otherwise(F.col("next")).alias("next"))), passed


def within(links: DataFrame, held: DataFrame, keys: list[str], hot_rows: int, n_rows: int) -> DataFrame:
    """The links of the cells of ``held``; one that leads elsewhere is NULL."""
    inside = held.select(*keys, F.col("cell").alias("next"), F.lit(True).alias("_in"))
    own = links.join(held, [*keys, "cell"], "left_semi")
    return settle(salted_join(own, inside, [*keys, "next"], "left", hot_rows, n_rows=n_rows).select(
        *keys, "cell", F.when(F.col("_in"), F.col("next")).alias("next")))


def occupied(tokens: DataFrame, links: DataFrame, keys: list[str], hot_rows: int, n_rows: int) -> DataFrame:
    """(keys, cell): the cells that ``tokens`` (keys, cell, n) take, all of them on linked cells.

    ``n_rows`` is a bound of the number of links.
    """
    tokens, taken = settle(tokens), []
    for _ in range(MAX_ROUNDS):
        most = tokens.agg(F.max("n")).first()[0]
        if not most:
            break
        jumps = [links]
        for _ in range(most.bit_length() - 1):
            ahead = jumps[-1].select(*keys, F.col("cell").alias("next"), F.col("next").alias("_next"))
            jumps.append(settle(salted_join(jumps[-1], ahead, [*keys, "next"], "inner", hot_rows, n_rows=n_rows)
                                .select(*keys, "cell", F.col("_next").alias("next"))))
        claimed = _claims(tokens, jumps, keys)
        taken.append(claimed.select(*keys, "cell"))
        spare = claimed.filter("n > 1").select(*keys, "cell", (F.col("n") - 1).alias("n"))
        if spare.isEmpty():
            break
        links, passed = without(links, claimed, keys, hot_rows, n_rows)
        tokens = settle(spare.join(passed, [*keys, "cell"]).filter("end IS NOT NULL")
                        .groupBy(*keys, F.col("end").alias("cell")).agg(F.sum("n").alias("n")))
    if not taken:
        return tokens.select(*keys, "cell")
    return settle(reduce(DataFrame.unionByName, taken))


def first_come(marks: DataFrame, ldd: DataFrame, turn: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``marks`` at the cell each takes when they are served by ``turn``; NULL for those pushed past a pit.

    ``turn`` names columns that together are unique. Marks must start on cells of ``ldd``.
    """
    marks = settle(marks)
    n_marks, n_cells = marks.count(), ldd.count()
    counted = marks.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    river = ldd.select("cell", F.col("down").alias("next"))
    links = within(river, occupied(counted, river, [], hot_rows, n_cells), [], hot_rows, n_cells)
    ends = follow(links.filter("next IS NOT NULL"), [], hot_rows, n_marks).select("cell", F.col("end").alias("_root"))
    roots = settle(links.join(ends, "cell", "left").select("cell", F.coalesce("_root", "cell").alias("_root")))
    keys = ["_root", "_path"]
    links = links.join(roots, "cell").withColumn("_path", F.lit(0).cast("long"))

    placed = settle(salted_join(marks, roots, ["cell"], "inner", hot_rows, n_rows=n_marks))
    sizes = settle(placed.groupBy("_root").agg(F.count(F.lit(1)).alias("_size")))
    largest = sizes.agg(F.max("_size")).first()[0] or 0
    ranked = running_total(placed, ["_root"], [F.asc(t) for t in turn], "_rank", largest=largest)
    state = settle(attach(ranked, sizes, ["_root"]).withColumn("_rank", F.col("_rank") - 1)
                   .withColumn("_path", F.lit(0).cast("long")))
    done = []
    while True:
        done.append(state.filter("_size = 1 OR cell IS NULL").select(marks.columns))
        live = state.filter("_size > 1 AND cell IS NOT NULL")
        blocks = settle(live.select(*keys).distinct())
        if blocks.isEmpty():
            return reduce(DataFrame.unionByName, done)
        links = settle(links.join(blocks, keys, "left_semi"))
        half = F.ceil(F.col("_size") / 2).cast("long")
        first = live.filter(F.col("_rank") < half)
        held = occupied(first.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("n")), links, keys, hot_rows, n_marks)
        rest, passed = without(links, held, keys, hot_rows, n_marks)
        over = passed.select(*keys, "cell", F.col("end").alias("_end"), F.lit(True).alias("_over"))
        second = salted_join(live.filter(F.col("_rank") >= half), over, [*keys, "cell"], "left", hot_rows, n_rows=n_marks).select(
            *[F.when(F.col("_over"), F.col("_end")).otherwise(F.col("cell")).alias("cell") if c == "cell" else F.col(c) for c in marks.columns],
            "_root", (F.col("_path") * 2 + 1).alias("_path"), (F.col("_rank") - half).alias("_rank"), (F.col("_size") - half).alias("_size"))
        state = settle(second.unionByName(first.withColumn("_path", F.col("_path") * 2).withColumn("_size", half)))
        links = (within(links, held, keys, hot_rows, n_marks).withColumn("_path", F.col("_path") * 2)
                 .unionByName(rest.withColumn("_path", F.col("_path") * 2 + 1)))
