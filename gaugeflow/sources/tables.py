"""Readers and writers of station, link, parameter and history tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach_stats
from gaugeflow.functions.values import let, present
from gaugeflow.operators.history import PSEUDO_RUNS

# Column names of the text formats.
OBJECTIVE_COLUMNS = {
    "Kling Gupta Efficiency": "kge",
    "Correlation": "corr",
    "Signal ratio (s/o) (Bias)": "bias",
    "Noise ratio (s/o) (Spread)": "spread",
    "sae": "sae",
}
NOT_GIVEN = "-"
STATION_PARENT = r"/(?:obsid=)?([0-9]+)/[^/]+$"
COMMITS = "_commits"  # not listed with the data, as its name begins with an underscore


def given(text: Column) -> Column:
    """NULL for blanks and for the dash that marks an absent value."""
    trimmed = F.trim(text)
    return F.when((trimmed != "") & (trimmed != NOT_GIVEN), trimmed)


def read_stations(spark: SparkSession, path: str | list[str],
                  numbers: tuple[str, ...] = ("DrainingArea.km2.LDD", "CatchmentArea", "SamplingFrequency",
                                              "Spinup_days", "Min_calib_days"),
                  coordinates: tuple[str, str] | None = None) -> DataFrame:
    """Station metadata: text columns, the named ones as numbers, keyed by obsid.

    ``coordinates`` names the two columns that become ``x`` and ``y`` on the model grid.
    """
    renamed = dict(zip(coordinates, ("x", "y"))) if coordinates else {}
    table = spark.read.option("header", True).csv(path)
    columns = []
    for name in table.columns:
        value = given(F.col(f"`{name}`"))
        if name == "ObsID":
            columns.append(value.cast("long").alias("obsid"))
        elif name in renamed or name in numbers:
            columns.append(value.try_cast("double").alias(renamed.get(name, name)))
        else:
            columns.append(value.alias(name))
    return table.select(*columns)


def read_station_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(obsid, key, value) from transposed station files; the station id heads the value column."""
    rows = spark.read.option("header", False).csv(path, schema="key STRING, value STRING").select(
        F.col("_metadata.file_path").alias("file"), "key", "value")
    return parse_station_records(rows)


def parse_station_records(rows: DataFrame) -> DataFrame:
    heads = rows.filter("key IS NULL AND value IS NOT NULL").select(
        "file", F.col("value").cast("long").alias("obsid"))
    return rows.filter("key IS NOT NULL").join(heads, "file").select("obsid", "key", "value")


def records_wide(records: DataFrame, names: list[str]) -> DataFrame:
    return records.groupBy("obsid").pivot("key", names).agg(F.first("value"))


def _numbered_links(table: DataFrame, obsid: Column, ids: Column) -> DataFrame:
    kept = F.filter(F.transform(ids, lambda v: F.nullif(F.trim(v), F.lit("")).cast("double").cast("long")), lambda v: v.isNotNull())
    return table.select(obsid.cast("long").alias("obsid"), F.posexplode(kept).alias("i", "upstream_id")).select(
        "obsid", (F.col("i") + 1).cast("long").alias("inlet_no"), "upstream_id")


def read_links(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(obsid, inlet_no, upstream_id) from wide link tables; blanks are skipped.

    Lines are split one by one, so files may have different numbers of slots; header lines, which
    begin with no number, are left out.
    """
    cells = spark.read.text(path).select(F.split(F.regexp_replace("value", '"', ""), ",").alias("c"))
    rows = cells.filter(F.col("c")[0].try_cast("double").isNotNull())
    return _numbered_links(rows, F.col("c")[0].cast("double"), F.slice("c", F.lit(2), F.size("c")))


def parse_links(table: DataFrame, slots: list[str]) -> DataFrame:
    """Blanks do not count as inlets: the remaining ids are numbered in slot order."""
    return _numbered_links(table, F.col("ID"), F.array(*[F.col(c).cast("string") for c in slots]))


def write_links(links_wide: DataFrame, path: str) -> None:
    links_wide.write.mode("overwrite").option("header", True).csv(path)


def read_param_ranges(spark: SparkSession, path: str) -> DataFrame:
    """(idx, name, min, max, default) in file order; one row per model parameter."""
    table = spark.read.option("header", True).csv(
        path, schema="ParameterName STRING, MinValue DOUBLE, MaxValue DOUBLE, DefaultValue DOUBLE")
    return table.coalesce(1).select(
        F.monotonically_increasing_id().cast("int").alias("idx"), F.col("ParameterName").alias("name"),
        F.col("MinValue").alias("min"), F.col("MaxValue").alias("max"), F.col("DefaultValue").alias("default"))


def _station_of(file: Column) -> Column:
    return F.regexp_extract(file, STATION_PARENT, 1).try_cast("long")


def read_history(spark: SparkSession, path: str | list[str], params: list[str],
                 recursive: bool = False, pattern: str = "paramsHistory.csv") -> DataFrame:
    """Run history without the three pseudo runs: (obsid, rand_id, gen, run, params, objectives, file).

    With ``recursive``, all files below the paths whose name matches ``pattern`` are read. The
    station is the folder that holds the file, also in the form obsid=380.
    """
    columns = ["randId", *params, *OBJECTIVE_COLUMNS, "generation", "runNumber"]
    types = {"randId": "STRING", "generation": "INT", "runNumber": "INT"}
    schema = ", ".join(f"`{c}` {types.get(c, 'DOUBLE')}" for c in columns)
    reader = spark.read.option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    table = reader.csv(path, schema=schema)
    file = F.col("_metadata.file_path")
    return table.filter(~F.col("randId").isin(PSEUDO_RUNS)).select(
        _station_of(file).alias("obsid"), F.col("randId").alias("rand_id"), F.col("generation").alias("gen"),
        F.col("runNumber").alias("run"), F.array(*[F.col(f"`{p}`") for p in params]).alias("params"),
        *[present(F.col(f"`{c}`")).alias(n) for c, n in OBJECTIVE_COLUMNS.items()], file.alias("file"))


def read_scenarios(spark: SparkSession, roots: dict[str, str], params: list[str], pattern: str = "paramsHistory.csv") -> DataFrame:
    """All histories below the roots, each with the name of its root in ``scenario``.

    Roots may lie inside each other: a file is read once and belongs to the innermost root.
    """
    places = {name: re.sub(r"^\w+:(//[^/]*)?", "", root).rstrip("/") + "/" for name, root in roots.items()}
    outer = [roots[n] for n, p in places.items() if not any(p != q and p.startswith(q) for q in places.values())]
    found = read_history(spark, list(dict.fromkeys(outer)), params, recursive=True, pattern=pattern)
    inner = sorted(places, key=lambda n: (-len(places[n]), n))
    scenario = F.when(F.contains("file", F.lit(places[inner[0]])), F.lit(inner[0]))
    for name in inner[1:]:
        scenario = scenario.when(F.contains("file", F.lit(places[name])), F.lit(name))
    return found.withColumn("scenario", scenario)


def read_best_parameters(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """(obsid, params): the param columns of the best-parameter files."""
    columns = ["_row", "effover", "R", *[f"param_{i:02d}_{n}" for i, n in enumerate(names)]]
    schema = ", ".join(f"`{c}` {'STRING' if c == '_row' else 'DOUBLE'}" for c in columns)
    # only the schema names columns: a folder name such as obsid=380 is read from the path
    table = (spark.read.option("header", True).option("enforceSchema", True).option("recursiveFileLookup", True)
             .csv(path, schema=schema))
    return table.select(_station_of(F.col("_metadata.file_path")).alias("obsid"),
                        F.array(*[F.col(f"`{c}`") for c in columns[3:]]).alias("params"))


DIGITS = 6
SPLITTER = 2.0 ** 27 + 1


def _halves(x: Column) -> tuple[Column, Column]:
    """x as a sum of two numbers of half the bits, so that products of halves are exact."""
    wide = x * F.lit(SPLITTER)
    high = wide - (wide - x)
    return high, x - high


def _product_error(x: Column, y: Column, product: Column) -> Column:
    """What rounding took from the product of x and y, exactly."""
    (a, b), (c, d) = _halves(x), _halves(y)
    return ((a * c - product) + a * d + b * c) + b * d


def _rounded_digits(x: Column, power: Column) -> Column:
    """Struct of the DIGITS digits of x, rounded, as a whole number, and the power of ten of the first."""
    shift = F.lit(DIGITS - 1) - power  # x * 10^shift has DIGITS digits before the point
    up, down = (F.pow(F.lit(10.0), F.greatest(s, F.lit(0)).cast("double")) for s in (shift, -shift))

    def of(s: Column) -> Column:
        middle = s["whole"] + 0.5
        # distance of the value from the middle of two neighbours, up to a positive factor; its sign is exact
        over = F.when(s["shift"] >= 0, (s["scaled"] - middle) + _product_error(x, s["up"], s["scaled"])).otherwise(
            let(middle * s["down"], lambda p: (x - p) - _product_error(middle, s["down"], p)))
        more = let(over, lambda o: (o > 0) | ((o == 0) & (s["whole"] % 2 == 1)))
        number = (s["whole"] + F.when(more, 1.0).otherwise(0.0)).cast("long")
        return let(number, lambda n: F.struct(
            F.when(n >= 10 ** DIGITS, F.lit(10 ** (DIGITS - 1))).otherwise(n).alias("number"),
            (power + (n >= 10 ** DIGITS).cast("int")).alias("power")))

    def scaled(s: Column) -> Column:
        value = F.when(s["shift"] >= 0, x * s["up"]).otherwise(x / s["down"])
        return let(value, lambda v: let(F.struct(*[s[n].alias(n) for n in ("shift", "up", "down")], v.alias("scaled"),
                                                 F.floor(v).cast("double").alias("whole")), of))

    return let(F.struct(shift.alias("shift"), up.alias("up"), down.alias("down")), scaled)


def _written(digits: Column, power: Column) -> Column:
    """Digits without trailing zeros in fixed form, or in powers of ten where that is shorter."""
    n = F.length(digits)
    science = F.concat(F.substring(digits, 1, 1), F.when(n > 1, F.concat(F.lit("."), F.substring(digits, 2, DIGITS))).otherwise(""),
                       F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    large = F.concat(F.substring(F.rpad(digits, F.greatest(n, power + 1), "0"), F.lit(1), power + 1),
                     F.when(n > power + 1, F.concat(F.lit("."), F.substring(digits, power + 2, F.lit(DIGITS)))).otherwise(""))
    return F.when((power < -4) | (power >= DIGITS), science).when(power < 0, small).otherwise(large)


def six_digits(value: Column) -> Column:
    """Six significant digits as C prints them with %g.

    The digits are those of the exact binary value, ties to even, while the JVM's own formats round
    the shortest decimal text. So the value is scaled by a power of ten with an exact error term,
    which decides when the scaled value looks like a tie. Exact for magnitudes from 1e-17 to 1e27.
    """
    def text(x: Column) -> Column:
        power = F.regexp_extract(F.format_string("%.17e", x), r"e([+-][0-9]+)$", 1).cast("int")
        found = let(power, lambda p: _rounded_digits(x, p))
        return let(found, lambda f: let(F.regexp_replace(f["number"].cast("string"), "0+$", ""), lambda d: _written(d, f["power"])))

    x = value.cast("double")
    sign = F.when(x < 0, F.lit("-")).otherwise("")
    return (F.when(x.isNull(), F.lit(None).cast("string")).when(F.isnan(x), "nan")
            .when(F.abs(x) == float("inf"), F.concat(sign, F.lit("inf"))).when(x == 0, "0")
            .otherwise(F.concat(sign, let(F.abs(x), text))))


def ranked_export(ranked: DataFrame, params: list[str]) -> DataFrame:
    """Ranked history as text: the column names of the format and six significant digits."""
    renamed = {v: k for k, v in OBJECTIVE_COLUMNS.items()}
    return ranked.select(
        "obsid", F.col("rand_id").alias("randId"),
        *[six_digits(F.element_at("params", i + 1)).alias(p) for i, p in enumerate(params)],
        *[six_digits(F.col(c)).alias(renamed[c]) for c in renamed],
        F.col("gen").alias("generation"), F.col("run").alias("runNumber"),
        *[six_digits(F.col(c)).alias(c) for c in ("corrRank", "saeRank", "KGERank", "paretoRank")])


def best_export(best: DataFrame) -> DataFrame:
    """Best parameter sets as text with six significant digits."""
    return best.select("obsid", *[six_digits(F.col(c)).alias(c) for c in best.columns if c != "obsid"])


def write_exports(table: DataFrame, path: str) -> None:
    """CSV with one folder per station; best parameters and ranked runs are a small share of a history."""
    table.repartition("obsid").write.mode("overwrite").partitionBy("obsid").option("header", True).csv(path)


def write_stations(screened: DataFrame, path: str) -> None:
    """Accepted and rejected stations in one write, apart by ``is_valid``."""
    screened.write.mode("overwrite").partitionBy("is_valid").parquet(path)


def write_table(table: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Parquet; with keys, only the partitions present in ``table`` are replaced."""
    writer = table.write.mode("overwrite")
    if keys:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
    writer.parquet(path)


def append_runs(runs: DataFrame, path: str, gens: list[int] | None = None) -> None:
    """Add evaluated generations to a history, or replace them; safe to repeat and to interrupt.

    Only the partitions of these generations are overwritten. Their row counts are committed after
    the data, so a write that broke off stays invisible to ``read_runs``. ``gens`` names them where
    the caller knows; otherwise ``runs`` is read for them first. A search has few generations.
    """
    spark = runs.sparkSession
    if gens is None:
        gens = [r.gen for r in runs.select("gen").distinct().collect()]
    write_table(runs, path, ["gen"])
    counts = spark.read.parquet(path).filter(F.col("gen").isin(gens)).groupBy("gen").agg(F.count(F.lit(1)).alias("n"))
    write_table(counts.coalesce(1), f"{path}/{COMMITS}", ["gen"])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The committed generations of a history, each with all rows that were committed."""
    stored = spark.read.parquet(path)
    counts = stored.groupBy("gen").agg(F.count(F.lit(1)).alias("n"))
    whole = spark.read.parquet(f"{path}/{COMMITS}").join(counts, ["gen", "n"]).select("gen")
    return attach_stats(stored, whole, ["gen"])


def runs_log(runs: DataFrame) -> DataFrame:
    """(run_id, kge) of every run."""
    return runs.select(F.col("rand_id").alias("run_id"), "kge")
