"""Station topology from a flow-direction table.

``ldd(cell, down)`` gives the next cell downstream (NULL at a pit); ``gauges(cell, obsid)`` the
station cells. Everything follows from the nearest station at or downstream of each cell, found
by pointer doubling: the number of rounds is the logarithm of the longest flow path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import HOT_ROWS, attach, attach_stats, running_total, salted_join
from gaugeflow.operators.placement import MAX_ROUNDS, first_come, follow
from gaugeflow.session import settle

NO_STATION = -1  # fixed value: region of cells without a station downstream
LINK_SLOTS = 20  # fixed value: columns of the wide link table


def station_conflicts(gauges: DataFrame, ldd: DataFrame) -> DataFrame:
    """Stations outside the grid, or on a cell that another station uses as well."""
    shared = gauges.groupBy("cell").agg(F.count(F.lit(1)).alias("_users")).filter("_users > 1")
    lost = gauges.join(ldd, "cell", "left_anti").select("obsid", "cell", F.lit("off grid").alias("conflict"))
    crowded = (gauges.join(shared, "cell", "left_semi")
               .select("obsid", "cell", F.lit("shared cell").alias("conflict")))
    return lost.unionByName(crowded)


def outlet_conflicts(gauges: DataFrame, outlets: DataFrame) -> DataFrame:
    """Stations whose id the outlet cells don't hold exactly once, or whose own cell holds another id.

    ``outlets`` are (cell, station); ``found`` is the number of cells with the id, ``instead`` what
    the station's cell holds.
    """
    counted = outlets.groupBy(F.col("station").alias("obsid")).agg(F.count(F.lit(1)).alias("found"))
    held = outlets.groupBy("cell").agg(F.min("station").alias("instead"))
    joined = attach_stats(attach_stats(gauges.select("obsid", "cell"), counted, ["obsid"], "left"), held, ["cell"], "left")
    found, other = F.coalesce(F.col("found"), F.lit(0)), F.coalesce(F.col("instead") != F.col("obsid"), F.lit(False))
    text = (F.when(found == 0, F.lit("lost")).when(found > 1, F.lit("found multiple times"))
            .when(other, F.lit("wrong id")))
    return joined.select("obsid", "cell", found.alias("found"), "instead", text.alias("conflict")).filter("conflict IS NOT NULL")


def interstation_regions(ldd: DataFrame, gauges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(cell, region): the nearest station at or downstream of the cell, or -1.

    That station has the smallest of the nested catchments that hold the cell.
    """
    shared = gauges.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy("cell").head(1)
    if shared:
        raise ValueError(f"{shared[0]['n']} stations share cell {shared[0]['cell']}")
    stops = gauges.select("cell", F.col("obsid").alias("region"))
    passing = ldd.join(stops, "cell", "left_anti").filter("down IS NOT NULL").select("cell", F.col("down").alias("next"))
    ends = follow(passing, [], hot_rows).select("cell", F.col("end").alias("at"))
    still = ldd.join(stops, "cell", "left").filter("region IS NOT NULL OR down IS NULL").select("cell", F.col("cell").alias("at"))
    return attach(ends.unionByName(still), stops.withColumnRenamed("cell", "at"), ["at"], "left", hot_rows=hot_rows).select(
        "cell", F.coalesce("region", F.lit(NO_STATION)).alias("region"))


def station_parents(ldd: DataFrame, gauges: DataFrame, regions: DataFrame) -> DataFrame:
    """(obsid, cell, down, parent): next station downstream, NULL for the last one of a river."""
    below = ldd.join(gauges, "cell", "inner")
    owner = regions.filter(F.col("region") != NO_STATION).select(
        F.col("cell").alias("down"), F.col("region").alias("parent"))
    return below.join(owner, "down", "left").select("obsid", "cell", "down", "parent")


def station_tree(parents: DataFrame, regions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per station: depth (catchments holding it), root, upstream cells and dependency wave.

    One doubling loop keeps, for every station, its 2^k-th station downstream. Depth and root are
    read from there; cell counts and waves are added there (wave = stations on the longest chain
    upstream, so wave 0 needs no inflow). A station that has reached its root is written once and
    leaves the loop; what later rounds still add to it is kept as rows of their own and summed at
    the end, so each round writes only the stations that are still on their way.
    """
    own = (regions.filter(F.col("region") != NO_STATION).groupBy(F.col("region").alias("obsid"))
           .agg(F.count(F.lit(1)).alias("own_cells")))
    own_cells = F.coalesce("own_cells", F.lit(0)).cast("long")
    facts = settle(parents.join(own, "obsid", "left").select("obsid", "parent", own_cells.alias("own_cells")))
    start = facts.select("obsid", F.col("parent").alias("jump"), F.lit(1).cast("long").alias("depth"), F.col("obsid").alias("root"),
                         F.col("own_cells").alias("upstream_cells"), F.lit(0).cast("long").alias("wave"))
    ended, moving, late = [start.filter("jump IS NULL")], start.filter("jump IS NOT NULL"), []
    growth = ["obsid", "upstream_cells", "wave"]
    reach = 1
    for _ in range(MAX_ROUNDS):
        n_moving = moving.count()
        if not n_moving:
            break
        behind = moving.groupBy(F.col("jump").alias("obsid")).agg(
            F.sum("upstream_cells").alias("_cells"), (F.max("wave") + F.lit(reach)).alias("_wave"))
        ahead = reduce(DataFrame.unionByName, ended, moving).select(
            F.col("obsid").alias("jump"), F.col("jump").alias("_jump"), F.col("depth").alias("_depth"), F.col("root").alias("_root"))
        state = settle(
            salted_join(moving, ahead, ["jump"], "left", hot_rows, n_rows=n_moving)
            .join(behind, "obsid", "full_outer").select(
                "obsid", F.col("_jump").alias("jump"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
                F.coalesce("_root", "root").alias("root"),
                (F.coalesce("upstream_cells", F.lit(0)) + F.coalesce("_cells", F.lit(0))).alias("upstream_cells"),
                F.greatest("wave", "_wave").alias("wave")))
        late.append(state.filter("depth IS NULL").select(growth))  # only growth: the station has left the loop
        ended, moving = [*ended, state.filter("jump IS NULL AND depth IS NOT NULL")], state.filter("jump IS NOT NULL")
        reach *= 2
    else:
        raise ValueError("the station links have a cycle")
    parts = [facts, *[e.drop("jump") for e in ended], *late]
    merged = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts).groupBy("obsid")
    return settle(merged.agg(
        *[F.max(c).alias(c) for c in ("parent", "depth", "root", "own_cells")],
        F.sum("upstream_cells").alias("upstream_cells"), F.max("wave").alias("wave")))


def cell_frequency(regions: DataFrame, tree: DataFrame) -> DataFrame:
    """Number of catchments that hold each cell."""
    depth = tree.select(F.col("obsid").alias("region"), "depth")
    return attach(regions, depth, ["region"], "left").select(
        "cell", F.coalesce("depth", F.lit(0)).alias("frequency"))


def direct_links(parents: DataFrame) -> DataFrame:
    """(obsid, inlet_no, upstream_id): directly connected upstream stations in cell order."""
    edges = parents.filter("parent IS NOT NULL").select(
        F.col("parent").alias("obsid"), F.col("obsid").alias("upstream_id"), "cell")
    return running_total(edges, ["obsid"], [F.asc("cell"), F.asc("upstream_id")], "inlet_no").select(
        "obsid", "inlet_no", "upstream_id")


def link_slots(links: DataFrame) -> int:
    """Columns of the wide form: the usual number, or more when a station has more inlets."""
    return max(LINK_SLOTS, links.agg(F.max("inlet_no")).first()[0] or 0)


def links_wide(links: DataFrame, slots: int | None = None) -> DataFrame:
    """A row per station with its upstream ids in numbered columns."""
    slots = slots or link_slots(links)
    return links.groupBy("obsid").pivot("inlet_no", list(range(1, slots + 1))).agg(F.first("upstream_id"))


def inlet_cells(parents: DataFrame, ldd: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(obsid, upstream_id, cell): one cell downstream of each connected station.

    Inlets are served by station, then by cell of the upstream station; one that finds its cell
    taken goes on to the next free cell downstream, and one pushed past a pit is lost (NULL cell).
    """
    inlets = parents.filter("parent IS NOT NULL").select(
        F.col("parent").alias("obsid"), F.col("obsid").alias("upstream_id"), F.col("cell").alias("_at"), F.col("down").alias("cell"))
    return first_come(inlets, ldd, ["obsid", "_at", "upstream_id"], hot_rows).select("obsid", "upstream_id", "cell")


def nested_groups(tree: DataFrame) -> DataFrame:
    """(obsid, group_id): stations of one largest catchment share an id, numbered by its area."""
    roots = tree.filter(F.col("obsid") == F.col("root")).select("root", "upstream_cells")
    numbered = running_total(roots, [], [F.desc("upstream_cells"), F.asc("root")], "group_id")
    return attach(tree.select("obsid", "root", "upstream_cells"), numbered.select("root", "group_id"),
                  ["root"]).select("obsid", "group_id", "upstream_cells")


def group_areas(groups: DataFrame) -> DataFrame:
    """Summed catchment size of the stations of each group."""
    return groups.groupBy("group_id").agg(F.sum("upstream_cells").alias("area"))


def allocate_workers(groups: DataFrame, workers: int) -> DataFrame:
    """(obsid, worker): in id order, a worker takes groups until it holds an equal share.

    For every group at once, the successor cut is found: the group that fills a worker who begins
    there is the first whose running total reaches the total before plus a share. It comes from one
    ordering of totals and goals together. The cuts that are really used are the chain of
    successors from the first group; it is marked by doubling, so the jobs grow with the logarithm
    of ``workers``. Groups past the last worker get NULL.
    """
    areas = settle(running_total(running_total(group_areas(groups), [], [F.asc("group_id")], "upto", "area"),
                                 [], [F.asc("group_id")], "place"))
    total = areas.agg(F.sum("area")).first()[0] or 0
    if not total:  # nothing fills a worker
        return groups.select("obsid", "group_id", F.lit(1).cast("long").alias("worker"))
    goal = (F.col("upto") - F.col("area")) + F.lit(total / workers)
    points = areas.select(F.col("upto").cast("double").alias("at"), F.lit(1).cast("long").alias("is_total"), F.lit(None).cast("long").alias("place")).unionByName(
        areas.select(goal.cast("double").alias("at"), F.lit(0).cast("long").alias("is_total"), "place"))
    # totals below a goal; a worker who begins at `place` is full with the next group, and another begins after it
    below = running_total(points, [], [F.asc("at"), F.asc("is_total"), F.asc("place")], "below", "is_total")
    jump = settle(below.filter("is_total = 0").select("place", (F.col("below") + 2).alias("next")).filter(F.col("next") <= areas.count()))
    begins = areas.filter("place = 1").select("place")
    for _ in range(workers.bit_length()):  # beginnings among the first 2^k, and the jump over 2^k of them
        begins = settle(begins.unionByName(begins.join(jump, "place").select(F.col("next").alias("place"))))
        ahead = jump.select(F.col("place").alias("next"), F.col("next").alias("_next"))
        jump = settle(jump.join(ahead, "next").select("place", F.col("_next").alias("next")))
    marked = areas.join(begins.withColumn("begins", F.lit(1).cast("long")), "place", "left").select(
        "group_id", F.coalesce("begins", F.lit(0)).alias("begins"))
    numbered = settle(running_total(marked, [], [F.asc("group_id")], "worker", "begins").select("group_id", "worker"))
    return attach(groups.select("obsid", "group_id"), numbered, ["group_id"]).select(
        "obsid", "group_id", F.when(F.col("worker") <= workers, F.col("worker")).alias("worker"))


def _main_stems(tree: DataFrame, area: str) -> DataFrame:
    """(id, up, up_area): link to the next station for the largest station upstream of each one."""
    facts = tree.select("obsid", "parent", F.col(area).cast("double").alias("_area"))
    largest = (facts.filter("parent IS NOT NULL").groupBy("parent")
               .agg(F.max(F.struct(F.col("_area"), (-F.col("obsid")).alias("_id"))).alias("_top")))
    links = largest.select((-F.col("_top._id")).alias("id"), F.col("parent").alias("up"))
    return links.join(facts.select(F.col("obsid").alias("up"), F.col("_area").alias("up_area")), "up")


def thin_stations(tree: DataFrame, area: str, max_share: float, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(obsid, keep): walking downstream, a station within ``max_share`` of the last kept area is
    dropped.

    ``area`` is the drainage area, which adds up at confluences, so only the largest river above
    a station can come that close. Each main stem starts with a kept station; the next kept one is
    the first beyond the tolerance. Both the first-beyond search and the walk over kept stations
    double their steps, so the rounds are logarithmic in the length of a stem.
    """
    facts = settle(tree.select(F.col("obsid").alias("id"), F.col(area).cast("double").alias("area")))
    n = facts.count()
    levels = [settle(_main_stems(tree, area))]
    while not levels[-1].isEmpty():
        half = levels[-1]
        ahead = half.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("up_area").alias("_area"))
        levels.append(settle(half.select("id", "up").join(ahead, "up").select(
            "id", F.col("_up").alias("up"), F.col("_area").alias("up_area"))))

    limit = F.col("area") * F.lit(1 + max_share)
    place = facts.select("id", limit.alias("limit"), F.col("id").alias("at"))
    for level in reversed(levels):
        ahead = level.select(F.col("id").alias("at"), F.col("up").alias("_up"), F.col("up_area").alias("_area"))
        within = F.col("_area") <= F.col("limit")
        place = settle(salted_join(place, ahead, ["at"], "left", hot_rows, n_rows=n).select(
            "id", "limit", F.when(within, F.col("_up")).otherwise(F.col("at")).alias("at")))
    beyond = levels[0].select(F.col("id").alias("at"), F.col("up").alias("next"))
    step = settle(salted_join(place, beyond, ["at"], "inner", hot_rows, n_rows=n).select("id", "next"))

    kept = settle(facts.join(levels[0].select(F.col("up").alias("id")), "id", "left_anti").select("id"))
    while not step.isEmpty():
        reached = step.join(kept, "id", "left_semi").select(F.col("next").alias("id"))
        kept = settle(kept.unionByName(reached).distinct())
        ahead = step.select(F.col("id").alias("next"), F.col("next").alias("_next"))
        step = settle(salted_join(step, ahead, ["next"], "inner", hot_rows, n_rows=n).select(
            "id", F.col("_next").alias("next")))
    marks = kept.withColumn("_kept", F.lit(True))
    return facts.select("id").join(marks, "id", "left").select(
        F.col("id").alias("obsid"), F.coalesce("_kept", F.lit(False)).alias("keep"))
