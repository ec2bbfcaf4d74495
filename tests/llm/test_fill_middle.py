import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import fill_middle as op


def expected(i, text, units=None):
    """By plain slicing; ``units`` cuts a text into its units."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    parts = list(text) if units is None else units(text)
    n = len(parts)
    if not n or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < 20:
        return i, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return i, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def got(df, **kw):
    return sorted((tuple(r) for r in op.transform(df, **kw).collect()), key=str)


TEXTS = [None, "", "a", "<P>", "a<S>b", "x<M", "<", "<P", "P>", "M>S>P>", "é😀\n\r\ńz", "\0", "<<<>>>" * 30, "<S <P <M >" * 40, "ab " * 50_000]


def test_hard_texts_and_round_trip(spark):
    rows = [(i, t) for i in [*range(40), None, -3, 2**62] for t in TEXTS]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _id", "'k' as form", "2 as n", "3 as _h0")
    assert got(df) == sorted((expected(i, t) for i, t in rows), key=str)
    back = op.transform(df).select("doc_id", op.restore(F.col("output"), F.col("form")).alias("t")).collect()
    assert sorted(((r.doc_id, r.t) for r in back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    forms = {r.form for r in op.transform(df).select("form").distinct().collect()}
    assert forms == {"plain", "psm", "spm"}
    assert op.transform(df.limit(0)).collect() == []


def test_random_texts(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("<PSM>ab é😀") for _ in range(rng.randrange(40)))) for i in range(600)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == sorted((expected(*r) for r in rows), key=str)


@pytest.mark.parametrize("unit, units", [
    (r"[^\n]*\n|[^\n]+", lambda t: t.splitlines(keepends=True)),
    (r"(?:(a)|(b)|.)", list),  # groups of its own
])
def test_other_units(spark, unit, units):
    rows = [(i, "line a\nb b\n\nlast" * (i % 5)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, unit=unit) == sorted((expected(i, t, units) for i, t in rows), key=str)


def test_units_that_do_not_cover_leave_a_text_plain(spark):
    df = spark.createDataFrame([(1, "ab1")], "doc_id long, text string")
    assert got(df, unit="[a-z]") == [(1, 0, "plain", None, None, "ab1")]


def test_stretches_give_the_ends_of_one_match(monkeypatch):
    text = "aé\n😀x" * 500
    whole = op.unit_ends(text, *op.patterns())
    monkeypatch.setattr(op, "STRETCH", 37)
    assert op.unit_ends(text, *op.patterns()).tolist() == whole.tolist() == list(range(1, 2501))
    assert op.unit_ends(text, *op.patterns("[^😀]")).tolist() == []


def test_very_long_text(spark):
    text = "é😀 word\n" * 700_000  # past one match of the library
    df = spark.createDataFrame([(7, text)], "doc_id long, text string")
    assert got(df) == [expected(7, text)]
