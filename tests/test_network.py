"""Topology against brute force on random networks."""

import random

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import grid, network, placement


@pytest.fixture(autouse=True)
def small_shuffles(spark):
    """The networks are tiny and the loops many."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def random_network(seed, cells=120, share=0.2, wide=False):
    rng = random.Random(seed)
    down = {c: None if c == 0 or rng.random() < 0.03 else rng.randrange(0 if wide else max(0, c - 4), c)
            for c in range(cells)}
    stations = sorted(rng.sample(range(cells), int(cells * share)))
    return down, stations


def frames(spark, down, stations):
    ldd = spark.createDataFrame(list(down.items()), "cell long, down long")
    gauges = spark.createDataFrame([(c, 1000 + c) for c in stations], "cell long, obsid long")
    return ldd, gauges


def path(down, cell):
    while cell is not None:
        yield cell
        cell = down[cell]


class Brute:
    def __init__(self, down, stations):
        marks = set(stations)
        self.met = {c: [x for x in path(down, c) if x in marks] for c in down}
        self.region = {c: 1000 + m[0] if m else -1 for c, m in self.met.items()}
        self.area = {s: sum(s in m for m in self.met.values()) for s in stations}
        self.parent = {s: self.met[s][1] if len(self.met[s]) > 1 else None for s in stations}
        self.wave = {s: max(m.index(s) for c, m in self.met.items() if c in marks and s in m)
                     for s in stations}


@pytest.mark.parametrize("seed, wide, hot_rows", [(1, False, 10**6), (2, True, 10**6), (3, True, 5)])
def test_tree_against_brute_force(spark, seed, wide, hot_rows):
    down, stations = random_network(seed, wide=wide)
    want = Brute(down, stations)
    ldd, gauges = frames(spark, down, stations)
    regions = network.interstation_regions(ldd, gauges, hot_rows)
    assert {r.cell: r.region for r in regions.collect()} == want.region
    parents = network.station_parents(ldd, gauges, regions)
    tree = network.station_tree(parents, regions, hot_rows)
    got = {r.obsid - 1000: r for r in tree.collect()}
    assert set(got) == set(stations)
    for s, r in got.items():
        assert r.depth == len(want.met[s])
        assert r.root == 1000 + want.met[s][-1]
        assert r.upstream_cells == want.area[s]
        assert r.wave == want.wave[s]
        assert r.parent == (None if want.parent[s] is None else 1000 + want.parent[s])
    frequency = {r.cell: r.frequency for r in network.cell_frequency(regions, tree).collect()}
    assert frequency == {c: len(m) for c, m in want.met.items()}


def place_one_by_one(down, want, stations):
    taken, cells = set(), {}
    turns = sorted((want.parent[s] + 1000, s) for s in stations if want.parent[s] is not None)
    for _, s in turns:
        cell = down[s]
        while cell is not None and cell in taken:
            cell = down[cell]
        cells[1000 + s] = cell
        taken.add(cell)
    return cells


@pytest.mark.parametrize("seed, wide", [(11, False), (12, True), (13, True)])
def test_inlets_equal_sequential_placement(spark, seed, wide):
    down, stations = random_network(seed, cells=60, share=0.6, wide=wide)
    want = Brute(down, stations)
    ldd, gauges = frames(spark, down, stations)
    parents = network.station_parents(ldd, gauges, network.interstation_regions(ldd, gauges))
    got = {r.upstream_id: r.cell for r in network.inlet_cells(parents, ldd).collect()}
    assert got == place_one_by_one(down, want, stations)


def thin_one_by_one(want, stations, share):
    """Stations in downstream order; the largest kept catchment upstream decides."""
    kept = {}
    for s in sorted(stations, key=lambda x: want.wave[x]):
        above = [want.area[u] for u, k in kept.items() if k and s in want.met[u]]
        kept[s] = not above or want.area[s] > (1 + share) * max(above)
    return {1000 + s: k for s, k in kept.items()}


@pytest.mark.parametrize("seed, share", [(21, 0.1), (22, 0.3), (23, 0.5), (24, 0.1)])
def test_thinning_walks_downstream(spark, seed, share):
    down, stations = random_network(seed, cells=200, share=0.35)
    want = Brute(down, stations)
    ldd, gauges = frames(spark, down, stations)
    regions = network.interstation_regions(ldd, gauges)
    tree = network.station_tree(network.station_parents(ldd, gauges, regions), regions)
    got = {r.obsid: r.keep for r in network.thin_stations(tree, "upstream_cells", share).collect()}
    assert got == thin_one_by_one(want, stations, share)


def test_thinning_documented_example(spark):
    areas = [100.0, 104.0, 107.0, 111.0, 118.0]
    tree = spark.createDataFrame([(i, i + 1 if i < 5 else None, a) for i, a in enumerate(areas, 1)],
                                 "obsid long, parent long, area double")
    kept = network.thin_stations(tree, "area", 0.1).filter("keep")
    assert sorted(r.obsid for r in kept.collect()) == [1, 4]


@pytest.mark.parametrize("seed, workers", [(31, 3), (32, 5), (33, 40)])
def test_allocation_fills_workers_in_order(spark, seed, workers):
    rng = random.Random(seed)
    groups = [(100 + i, 1 + i // 2, rng.randrange(1, 90)) for i in range(40)]
    got = network.allocate_workers(
        spark.createDataFrame(groups, "obsid long, group_id long, upstream_cells long"), workers)
    areas = {}
    for _, g, a in groups:
        areas[g] = areas.get(g, 0) + a
    quota, todo, want = sum(areas.values()) / workers, sorted(areas), {}
    for worker in range(1, workers + 1):
        held = 0
        while todo and held < quota:
            want[todo[0]] = worker
            held += areas[todo.pop(0)]
    assert {r.group_id: r.worker for r in got.collect()} == want


def test_groups_are_numbered_by_area(spark):
    tree = spark.createDataFrame([(1, 1, 5), (2, 1, 2), (3, 3, 9), (4, 4, 5)], "obsid long, root long, upstream_cells long")
    got = {r.obsid: r.group_id for r in network.nested_groups(tree).collect()}
    assert got == {3: 1, 1: 2, 2: 2, 4: 3}


def test_cycles_are_reported(spark, monkeypatch):
    monkeypatch.setattr(placement, "MAX_ROUNDS", 8)
    ldd = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "cell long, down long")
    gauges = spark.createDataFrame([], "cell long, obsid long")
    with pytest.raises(ValueError):
        network.interstation_regions(ldd, gauges)


def test_conflicts(spark):
    ldd = spark.createDataFrame([(1, None), (2, 1)], "cell long, down long")
    gauges = spark.createDataFrame([(1, 10), (2, 11), (2, 12), (7, 13)], "cell long, obsid long")
    got = {(r.obsid, r.conflict) for r in network.station_conflicts(gauges, ldd).collect()}
    assert got == {(11, "shared cell"), (12, "shared cell"), (13, "off grid")}


def test_outlet_conflicts(spark):
    gauges = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40), (5, 50)], "obsid long, cell long")
    outlets = spark.createDataFrame([(10, 1), (20, 9), (30, 3), (31, 3), (40, 5), (41, 4)], "cell long, station long")
    got = {(r.obsid, r.found, r.instead, r.conflict) for r in network.outlet_conflicts(gauges, outlets).collect()}
    assert got == {(2, 0, 9, "lost"), (3, 2, 3, "found multiple times"), (4, 1, 5, "wrong id")}


@pytest.mark.parametrize("tile", [1, 3, 64])
def test_clip_equals_range_test(spark, tile):
    rng = random.Random(4)
    cells = [(x, y, float(x * 100 + y)) for x in range(-5, 25) for y in range(18)]
    boxes = []
    for obsid in range(12):
        x0, y0 = rng.randrange(-5, 20), rng.randrange(0, 15)
        boxes.append((obsid, x0, x0 + rng.randrange(0, 9), y0, y0 + rng.randrange(0, 9)))
    got = grid.clip_to_boxes(spark.createDataFrame(cells, "x long, y long, value double"),
                             spark.createDataFrame(boxes, "obsid long, x0 long, x1 long, y0 long, y1 long"), tile)
    want = sorted((b[0], x, y) for b in boxes for x, y, _ in cells if b[1] <= x <= b[2] and b[3] <= y <= b[4])
    assert sorted((r.obsid, r.x, r.y) for r in got.collect()) == want


def test_mosaic_variants(spark):
    cells = spark.createDataFrame([(1, 7), (2, 8), (3, -1), (4, 9)], "cell long, region long")
    stations = spark.createDataFrame([(7,), (8,)], "obsid long")  # 9 has no known area
    values = spark.createDataFrame([(7, "a", 0.5), (7, "b", 0.0), (9, "a", 0.7)], "obsid long, param string, value double")
    defaults = spark.createDataFrame([("a", 10.0), ("b", 20.0)], "param string, value double")

    def paint(fill):
        return {(r.cell, r.param): r.value
                for r in grid.mosaic(cells, stations, values, defaults, fill).collect()}

    assert paint(None) == {(1, "a"): 0.5, (1, "b"): 0.0, (2, "a"): 10.0, (2, "b"): 20.0,
                           (3, "a"): 10.0, (3, "b"): 20.0, (4, "a"): 10.0, (4, "b"): 20.0}
    assert paint(-1)[(2, "a")] == -1.0 and paint(-1)[(3, "a")] == 10.0


def test_masks_keep_missing_outside(spark):
    clipped = spark.createDataFrame([(1, 0, 0, 5.0), (1, 0, 1, 6.0)], "obsid long, x long, y long, value double")
    masks = spark.createDataFrame([(1, 0, 1)], "obsid long, x long, y long")
    assert {(r.y, r.value) for r in grid.mask_values(clipped, masks).collect()} == {(0, None), (1, 6.0)}
    kept = grid.cells_in_masks(clipped.select("x", "y", "value"), masks.withColumn("z", F.lit(1)))
    assert [r.y for r in kept.collect()] == [1]


@pytest.mark.parametrize("seed", [41, 42])
def test_marks_with_ties_lost_marks_and_hot_cells(spark, seed):
    """Several marks on one cell, in an order that runs against the river, and more marks than cells."""
    rng = random.Random(seed)
    down, _ = random_network(seed, cells=25, wide=seed % 2 == 0)
    cells = [rng.choice([3, 4, 9, 20, 24]) if rng.random() < 0.7 else rng.randrange(25) for _ in range(22)]
    turns = rng.sample(range(100), 22)
    ldd, _ = frames(spark, down, [])
    marks = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(zip(turns, cells))], "id long, turn long, cell long")
    got = {r.id: r.cell for r in placement.first_come(marks, ldd, ["turn"], hot_rows=6).collect()}
    taken, want = set(), {}
    for _, i in sorted(zip(turns, range(22))):
        want[i] = next((c for c in path(down, cells[i]) if c not in taken), None)
        taken.add(want[i])
    assert got == want and (None in want.values()) | (seed == 41)


def test_placement_rounds_grow_with_the_logarithm(spark, monkeypatch):
    """Tables written for marks on one cell: eight times the marks are far from eight times the tables."""
    written, settle = [0], placement.settle

    def counted(df):
        written[0] += 1
        return settle(df)

    monkeypatch.setattr(placement, "settle", counted)
    ldd = spark.range(100).selectExpr("id as cell", "case when id < 99 then id + 1 end as down")
    used = []
    for n in (4, 32):
        written[0] = 0
        marks = spark.range(n).selectExpr("id as turn", "3L as cell")
        got = placement.first_come(marks, ldd, ["turn"]).collect()
        assert sorted((r.turn, r.cell) for r in got) == [(i, 3 + i) for i in range(n)]
        used.append(written[0])
    assert used[1] < 4 * used[0]


def test_loops_write_fewer_rows_by_round(spark, monkeypatch):
    """Cells that have arrived leave the loop: each round writes only those still on their way."""
    written, settle = [], placement.settle

    def counted(df):
        out = settle(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(placement, "settle", counted)
    ldd = spark.range(600).selectExpr("id as cell", "case when id > 0 then id - 1 - id % 3 end as down")
    links = ldd.filter("down IS NOT NULL").selectExpr("cell", "down as next")
    ends = {r.end for r in placement.follow(links, []).collect()}
    assert ends <= {-1, 0} and len(written) > 4
    assert all(a >= b for a, b in zip(written, written[1:])) and written[-1] < written[0] / 2


@pytest.mark.parametrize("workers", [1, 7, 10_000])
def test_allocation_jobs_grow_with_the_logarithm(spark, workers, monkeypatch):
    settled, settle = [0], network.settle

    def counted(df):
        settled[0] += 1
        return settle(df)

    monkeypatch.setattr(network, "settle", counted)
    groups = spark.range(500).selectExpr("id as obsid", "id + 1 as group_id", "1 + id % 5 as upstream_cells")
    got = [r.worker for r in network.allocate_workers(groups, workers).orderBy("group_id").collect()]
    held, worker, want, quota = 0, 1, [], sum(1 + i % 5 for i in range(500)) / workers
    for i in range(500):
        if held >= quota:
            held, worker = 0, worker + 1
        held += 1 + i % 5
        want.append(worker if worker <= workers else None)
    assert got == want and settled[0] <= 4 + 2 * workers.bit_length()


def test_allocation_without_area(spark):
    groups = spark.createDataFrame([(1, 1, 0), (2, 2, 0)], "obsid long, group_id long, upstream_cells long")
    assert [r.worker for r in network.allocate_workers(groups, 3).collect()] == [1, 1]
    assert network.allocate_workers(groups.limit(0), 3).collect() == []
