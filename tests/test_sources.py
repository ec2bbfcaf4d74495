"""Text readers and writers on real files."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeflow.operators import inflows, logs
from gaugeflow.sources import jobs, series, tables

START, END = datetime(2016, 12, 31, 6), datetime(2017, 1, 1, 0)
FLOWS = {2822: [8.37713, 5.97804, 4.19268, 3.03034], 2824: [9.9869, 7.848739999999999, 5.60951, 1e31]}
LINKS = """ID,IDs of directly connected nested subcatchments,,,,,,,,,,,,,,,,,,,
380,,,,,,,,,,,,,,,,,,,,
428,380,,,,,,,,,,,,,,,,,,,
2822,,,,,,,,,,,,,,,,,,,,
2823,2824,2822,,,,,,,,,,,,,,,,,,
2824,,,,,,,,,,,,,,,,,,,,
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("cal")
    for obsid, flow in FLOWS.items():
        out = base / str(obsid) / "out" / "7"
        out.mkdir(parents=True)
        lines = ["timeseries scalar settingsfile: x date: y", "2", "timestep", "1"]
        lines += [f"        {i}        {q}" for i, q in enumerate(flow, 1)]
        (out / "dis.tss").write_text("\n".join(lines) + "\n")
    (base / "stations_links.csv").write_text(LINKS)
    return base


def test_series_reader(spark, folder):
    got = series.stamped(series.read_series(spark, str(folder / "*" / "out" / "*" / "dis.tss")), START, 360)
    rows = {(r.obsid, r.run_id, r.step): (r.ts, r.q) for r in got.collect()}
    assert len(rows) == 8
    assert rows[(2824, "7", 1)] == (START, 9.9869)
    assert rows[(2824, "7", 4)] == (END, None)  # the sentinel is missing
    assert series.checked_end(got, END, ["obsid", "run_id"]) is got
    with pytest.raises(ValueError):
        series.checked_end(got, END + timedelta(days=1), ["obsid"])
    with pytest.raises(FileNotFoundError):
        series.checked_end(got.filter("obsid = 1"), END, ["obsid"])
    expected = spark.createDataFrame([(2822,), (2824,), (2825,)], "obsid long")
    with pytest.raises(FileNotFoundError, match="2825"):  # a missing station among those that exist
        series.checked_end(got, END, ["obsid"], expected)
    assert series.checked_end(got, END, ["obsid"], expected.filter("obsid < 2825")) is got
    whole, wrong = series.complete(got, expected.withColumn("end", F.lit(END)), ["obsid"])
    assert whole.count() == 8 and [(r.obsid, r.last_ts) for r in wrong.collect()] == [(2825, None)]
    links = spark.createDataFrame([(9, 1, 2822), (9, 2, 2825)], "obsid long, inlet_no long, upstream_id long")
    found = inflows.incomplete_inflows(links, got, END).collect()
    assert [(r.obsid, r.upstream_id, r.last_ts) for r in found] == [(9, 2825, None)]


def test_gauges_and_last_gauge(spark, tmp_path):
    (tmp_path / "a.tss").write_text("timeseries scalar\n3\ntimestep\n11\n12\n 1 5 6\n 2 7 1e31\n")
    gauges = series.read_gauges(spark, str(tmp_path))
    assert sorted((r.step, r.gauge, r.q) for r in gauges.filter("q IS NOT NULL").collect()) == [
        (1, 1, 5.0), (1, 2, 6.0), (2, 1, 7.0)]
    last = series.parse_last_gauge(series.text_lines(spark, str(tmp_path)))
    assert sorted((r.step, r.q) for r in last.collect() if r.q is not None) == [(1, 6.0)]


def test_links_reader(spark, folder):
    got = tables.read_links(spark, str(folder / "stations_links.csv"))
    assert sorted(tuple(r) for r in got.collect()) == [(428, 1, 380), (2823, 1, 2824), (2823, 2, 2822)]


def test_inflow_text_in_link_order(spark, folder, tmp_path):
    links = tables.read_links(spark, str(folder / "stations_links.csv"))
    sim = series.read_series(spark, str(folder / "*" / "out" / "*" / "dis.tss"))
    gathered = inflows.gather_inflows(links, sim.select("obsid", "step", "q"))
    path = str(tmp_path / "inflow")
    series.write_inflow_text(gathered, path)
    lines = [r.value for r in spark.read.text(f"{path}/obsid=2823").collect()]
    assert lines[:7] == ["timeseries scalar", "3", "timestep", "2824", "2822", "1 9.9869 8.37713",
                         "2 7.848739999999999 5.97804"]
    assert len(lines) == 9 and lines[-1].startswith("4 1.0E31 ")
    back = series.read_gauges(spark, f"{path}/obsid=2823")
    assert back.filter("step = 1 AND gauge = 2").first().q == 8.37713
    flags = {r.obsid: (r.n_inflows, r.inflow_flag) for r in inflows.inflow_flags(
        spark.createDataFrame([(2823,), (380,)], "obsid long"), links).collect()}
    assert flags == {2823: (2, "1"), 380: (0, "0")}
    missing = inflows.missing_upstream(links, sim)
    assert [r.upstream_id for r in missing.collect()] == [380]


def test_wide_reader_and_stamped_writer(spark, tmp_path):
    source = tmp_path / "obs.csv"
    source.write_text("Timestamp,380,892\n30/01/2017 12:00,1.5,\n30/01/2017 18:00,NaN,2\n")
    got = series.read_wide(spark, str(source))
    rows = {(r.obsid, r.ts): r.q for r in got.collect()}
    assert rows == {(380, datetime(2017, 1, 30, 12)): 1.5, (892, datetime(2017, 1, 30, 12)): None,
                    (380, datetime(2017, 1, 30, 18)): None, (892, datetime(2017, 1, 30, 18)): 2.0}
    out = str(tmp_path / "out")
    series.write_stamped_csv(got, out)
    back = spark.read.option("header", True).csv(out)
    assert {(r.obsid, r.Timestamp, r.q) for r in back.collect()} == {
        (380, "30/01/2017 12:00", "1.5"), (380, "30/01/2017 18:00", None),
        (892, "30/01/2017 12:00", None), (892, "30/01/2017 18:00", "2.0")}
    source.write_text("Timestamp,380\n2017-01-30 12:00,1.5\n")
    with pytest.raises(PySparkException):
        series.read_wide(spark, str(source)).collect()


def test_station_readers(spark, tmp_path):
    meta = tmp_path / "stations.csv"
    meta.write_text("ObsID,StationName,River,EC_calib,DrainingArea.km2.LDD,CatchmentArea,GridX,GridY\n"
                    "380,Borgotaro,Taro,T,400,16.0,4307500,2377500\n2733,\"Raskov, Morava\",-,3,-,,-,1\n")
    table = tables.read_stations(spark, str(meta), coordinates=("GridX", "GridY"))
    got = {r.obsid: r for r in table.collect()}
    assert (got[380].x, got[380].y) == (4307500, 2377500) and (got[2733].x, got[2733].y) == (None, 1)
    assert got[380]["DrainingArea.km2.LDD"] == 400 and got[380].CatchmentArea == 16
    assert got[2733].River is None and got[2733].StationName == "Raskov, Morava"
    assert got[2733]["DrainingArea.km2.LDD"] is None and got[2733].CatchmentArea is None
    for obsid in (380, 892):
        station = tmp_path / str(obsid) / "station"
        station.mkdir(parents=True)
        (station / "station_data.csv").write_text(f",{obsid}\nRiver,Taro\nN_data,{obsid + 1}\nHeight,\n")
    records = tables.read_station_records(spark, str(tmp_path / "*" / "station" / "station_data.csv"))
    wide = {r.obsid: r for r in tables.records_wide(records, ["River", "N_data", "Height"]).collect()}
    assert wide[380].N_data == "381" and wide[892].River == "Taro" and wide[892].Height is None


def test_best_parameter_reader(spark, tmp_path):
    station = tmp_path / "380"
    station.mkdir()
    (station / "pareto_front.csv").write_text(",effover,R,param_00_a,param_01_b\n0,,,20.007,0.25\n")
    got = tables.read_best_parameters(spark, str(tmp_path / "*" / "pareto_front.csv"), ["a", "b"]).first()
    assert got.obsid == 380 and got.params == [20.007, 0.25]


def test_station_and_partition_writers(spark, tmp_path):
    path = str(tmp_path / "stations")
    tables.write_stations(spark.createDataFrame([(1, True), (2, False)], "obsid long, is_valid boolean"), path)
    assert [r.obsid for r in spark.read.parquet(path).filter("is_valid = 'true'").collect()] == [1]
    path = str(tmp_path / "parts")
    tables.write_table(spark.createDataFrame([(1, 1.0), (2, 2.0)], "obsid long, q double"), path, ["obsid"])
    tables.write_table(spark.createDataFrame([(2, 5.0)], "obsid long, q double"), path, ["obsid"])
    assert {(r.obsid, r.q) for r in spark.read.parquet(path).collect()} == {(1, 1.0), (2, 5.0)}
    runs = spark.createDataFrame([(1, 0, 1, "a", 0.5)], "obsid long, gen int, run int, rand_id string, kge double")
    path = str(tmp_path / "history")
    tables.append_runs(runs, path)
    tables.append_runs(runs.withColumn("gen", F.lit(1)), path)
    back = spark.read.parquet(path)
    assert back.count() == 2 and [tuple(r) for r in tables.runs_log(back).distinct().collect()] == [("a", 0.5)]


OUT_LOG = """DrainingArea.km2.LDD          400
Found inflow for subcatchment 2824
Found 2 inflows
Starting calibration
Generation {first}, run 1 done. KGE: 0.512
>> gen: 3, effmax_KGE: 0.100
Done generation 3
>> gen: 6, effmax_KGE: 0.912
{stops}Done generation 6
>> Time elapsed: 1234.56 s
"""


def test_job_logs(spark, tmp_path):
    both = logs.LAST_GENERATION + "\n" + logs.NO_IMPROVEMENT + "\n"
    cases = {"568.{}123456": (both, "maxGen AND no-improvement", "0.912"),
             "569.{}123457": (logs.NO_IMPROVEMENT + "\n", "no-improvement", "0.912"),
             "570.{}123458": ("", None, "error")}
    for name, (stops, _, _) in cases.items():
        (tmp_path / ("cal_01_" + name.format("e"))).write_text("real\t12m34.567s\nuser\t1m0.0s\nreal\t0m59.9s\n")
        (tmp_path / ("cal_01_" + name.format("o"))).write_text(OUT_LOG.format(first=0, stops=stops))
    (tmp_path / "cal_01_571.e123459").write_text("no times\n")
    (tmp_path / "cal_01_571.o123459").write_text("killed\n")
    got = {r.catchment: r for r in logs.job_table(jobs.read_job_logs(spark, str(tmp_path))).collect()}
    assert set(got) == {568, 569, 570, 571}
    for name, (_, termination, kge) in cases.items():
        r = got[int(name[:3])]
        assert (r.calib_sec, r.longrun_sec, r.draining_area, r.inflows) == (754, 59, "400", 2)
        assert (r.first_gen, r.elapsed_sec, r.last_gen) == (0, 1234.56, 6)
        assert (r.termination, r.kge) == (termination, kge)
    assert got[568].job == "123456"
    assert all(v is None for k, v in got[571].asDict().items() if k not in ("catchment", "job"))


def test_folder_sizes(spark, tmp_path):
    for folder, size in {"out": 3000, "maps": 100}.items():
        (tmp_path / "380" / folder / "deep").mkdir(parents=True)
        (tmp_path / "380" / folder / "deep" / "f.bin").write_bytes(b"x" * size)
    files = jobs.list_files(spark, str(tmp_path), r"/(\d+)/(out|settings|maps|inflow)/")
    got = logs.folder_sizes(files, ["out", "settings", "maps", "inflow"]).first()
    assert tuple(got) == ("380", 3, None, 1, None)


def test_links_of_files_with_different_slots(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,up,,\n1,7,,\n2,,8.0,\n" + "3,,,\n" * 50)
    (tmp_path / "b.csv").write_text('ID,up,,,,\n4,5, ,6,"9",10\n5\n')
    got = tables.read_links(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 7), (2, 1, 8), (4, 1, 5), (4, 2, 6), (4, 3, 9), (4, 4, 10)]


def test_scenarios_under_nested_roots(spark, tmp_path):
    head = "randId,a," + ",".join(tables.OBJECTIVE_COLUMNS) + ",generation,runNumber\n"
    for place, rid in (("cal/380", "x"), ("cal/zero/380", "y"), ("cal/zero/deep/892", "z"), ("other/obsid=7", "w")):
        (tmp_path / place).mkdir(parents=True)
        (tmp_path / place / "paramsHistory.csv").write_text(head + f"MinValue,0\n{rid},1,0.5,1,1,1,2,0,1\n")
        (tmp_path / place / "notes.csv").write_text("not a history\n")
    roots = {"all": f"file://{tmp_path}/cal/", "zero": str(tmp_path / "cal" / "zero"), "other": str(tmp_path / "other")}
    got = tables.read_scenarios(spark, roots, ["a"])
    assert sorted((r.scenario, r.obsid, r.rand_id) for r in got.collect()) == [
        ("all", 380, "x"), ("other", 7, "w"), ("zero", 380, "y"), ("zero", 892, "z")]


def test_six_digits_equal_the_c_format(spark):
    rng = random.Random(4)
    values = [0.0, None, float("nan"), float("inf"), -float("inf"), 999999.5, 999999.4999, 0.0001, 0.000099999950, 2.5052505, 15.0015,
              123456.5, 123457.5, 1234565.0, 1234575.0, 1e5, 1e6, 1e-5, 1e22, 1e23, 1.5e-17, -0.166375]
    values += [round(rng.uniform(-1, 1) * 10 ** rng.randrange(-6, 9), rng.randrange(12)) for _ in range(3000)]
    values += [rng.randrange(10**6, 10**7) * 10.0 ** rng.randrange(-14, 15) for _ in range(3000)]
    values += [(rng.randrange(10**5, 10**6) + 0.5) * 2.0 ** rng.randrange(-6, 6) for _ in range(1000)]
    df = spark.createDataFrame(list(enumerate(values)), "i long, x double").select("i", tables.six_digits(F.col("x")).alias("t"))
    got = {r.i: r.t for r in df.collect()}
    assert [got[i] for i in range(len(values))] == [None if x is None else "0" if x == 0 else f"{x:g}" for x in values]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_appends_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "history")
    runs = spark.createDataFrame([(1, g, r, 0.1 * r) for g in range(3) for r in range(4)], "obsid long, gen int, run int, kge double")
    for part in ("gen < 2", "gen > 0", "gen = 1"):
        tables.append_runs(runs.filter(part), path)
    assert tables.read_runs(spark, path).count() == 12
    tables.write_table(runs.filter("gen = 2").withColumn("gen", F.lit(7)), path, ["gen"])
    assert {r.gen for r in tables.read_runs(spark, path).collect()} == {0, 1, 2}
