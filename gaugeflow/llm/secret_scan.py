"""Secret scan in DataFrame operations only: fixed patterns and sliding-window entropy.

Patterns give the base spans. Entropy adds spans: candidate strings are long runs of token
characters that hold both letters and digits and are not on the allow-list. A window of ``WINDOW``
characters slides over a candidate; the counts of its characters and the sum of c * log2(c) are
updated by the character that enters and the one that leaves. A window is hot when its Shannon
entropy reaches the bound of the candidate's character class, and touching hot windows make one
span. Spans inside a base span are not added.

Defined cases: a null text is empty and has no spans; rows that repeat a doc_id are scanned each; an
empty table gives an empty result; other columns of the input, whatever their names, are left out;
of equal starts the kind listed first comes first. A very long text is scanned in its row, in time
that grows with its length, also where it is one single candidate or one path of many parts.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import id_and_text, id_of

# fixed patterns of the base kinds, in the order of the kinds
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a shorter run fails whole, so the length can be in the pattern
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Character classes by pattern, with the alphabet counted and the entropy (bits) that makes a window hot.
CLASSES = [
    ("[0-9a-f-]+", "0123456789abcdef-", 3.0),
    ("[0-9A-F-]+", "0123456789ABCDEF-", 3.0),
    ("[A-Z0-9]+", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", 3.5),
    (".*", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-", 3.7),
]
#: Harmless strings: identifiers in 8-4-4-4-12 form, numbers with separators, paths of plain words, placeholders.
#: The repeated group is possessive: its parts can't be cut otherwise, and Java matches it without recursion.
ALLOWED = [
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[0-9+/_=-]+", r"(?:[A-Za-z]+[0-9]{0,4}[/_=-]+)++[A-Za-z]*[0-9]{0,4}",
    r"(?i).*(example|placeholder|changeme|x{8}|0{8}|1234567890|abcdefgh).*",
]


def _located(text: Column, pattern: str) -> Column:
    """Start, end and text of every leftmost match, from the lengths of matches and of what lies between."""
    between, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("out"))

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["text"])
        one = F.struct(start.alias("start"), end.alias("end"), pair["text"].alias("text"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    pairs = F.zip_with(matches, F.transform(between, F.length), lambda m, gap: F.struct(gap.alias("gap"), m.alias("text")))
    return F.aggregate(F.filter(pairs, lambda p: p["text"].isNotNull()), none, add)["out"]


def _spans(found: Column, order: int, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(order).alias("order"), m["end"].alias("end"), F.lit(kind).alias("kind")))


SPANS = "array<struct<start:int,order:int,end:int,kind:string>>"


def _only_where(condition: Column, value: Column) -> Column:
    return F.when(condition, value).otherwise(F.array().cast(SPANS))


def _hot(text: Column, alphabet: str, bound: float) -> Column:
    """Merged spans of the hot windows of one candidate, by incremental counts."""
    size = len(alphabet)
    state = F.struct(F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("sum"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def f(c: Column) -> Column:  # c * log2(c)
        return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))

    def slide(chars: Column, s: Column, i: Column) -> Column:
        enters = F.instr(F.lit(alphabet), F.get(chars, i))
        leaves = F.when(i >= WINDOW, F.instr(F.lit(alphabet), F.get(chars, i - WINDOW))).otherwise(F.lit(0))
        came, went = F.element_at(s["counts"], enters), F.when(leaves > 0, F.element_at(s["counts"], F.greatest(leaves, F.lit(1))))
        change = F.when(enters == leaves, F.lit(0.0)).otherwise(
            f(came + 1) - f(came) + F.when(leaves > 0, f(went - 1) - f(went)).otherwise(F.lit(0.0)))
        counts = F.transform(s["counts"], lambda c, k: c + F.when(k + 1 == enters, 1).otherwise(0) - F.when(k + 1 == leaves, 1).otherwise(0))
        total = s["sum"] + change
        entropy = F.lit(math.log2(WINDOW)) - total / WINDOW
        start, end = i - WINDOW + 1, i + 1
        last = F.element_at(s["out"], -1)
        merged = F.when((F.size(s["out"]) > 0) & (F.get(s["out"], F.size(s["out"]) - 1)["end"] >= start),
                        F.concat(F.slice(s["out"], F.lit(1), F.greatest(F.size(s["out"]) - 1, F.lit(0))),
                                 F.array(F.struct(last["start"].alias("start"), end.alias("end"))))
                        ).otherwise(F.concat(s["out"], F.array(F.struct(start.alias("start"), end.alias("end")))))
        out = F.when((end >= WINDOW) & (entropy >= bound), merged).otherwise(s["out"])
        return F.struct(counts.alias("counts"), total.alias("sum"), out.alias("out"))

    def slid(chars: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.length(text) - 1), state, lambda s, i: slide(chars, s, i))["out"]

    return F.get(F.transform(F.array(F.split(text, "")), slid), F.lit(0))  # characters are cut apart once a candidate


def _entropy_spans(text: Column) -> Column:
    def of(candidate: Column) -> Column:
        inner = reduce(lambda rest, c: F.when(candidate["text"].rlike(f"^({c[0]})$"), _hot(candidate["text"], c[1], c[2])).otherwise(rest),
                       CLASSES[-2::-1], _hot(candidate["text"], *CLASSES[-1][1:]))
        return F.transform(inner, lambda w: F.struct(
            (candidate["start"] + w["start"]).alias("start"), F.lit(3).alias("order"),
            (candidate["start"] + w["end"]).alias("end"), F.lit("entropy").alias("kind")))

    mixed = F.filter(_located(text, CANDIDATE), lambda c: c["text"].rlike("[0-9]") & c["text"].rlike("[A-Za-z]")
                     & ~reduce(lambda x, y: x | y, [c["text"].rlike(f"^({a})$") for a in ALLOWED]))
    return F.flatten(F.transform(mixed, of))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy."""
    text = F.col("_text")
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assigned = F.filter(F.zip_with(_located(text, ASSIGN), values, lambda m, v: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), v.alias("value"))), lambda m: F.length(m["value"]) >= LEAST_VALUE)
    found = id_and_text(docs, id_col, text_col).select(
        "_id",
        _only_where(text.rlike(ASSIGN), _spans(assigned, 0, "assign")).alias("_assign"),
        _only_where(text.contains("AKIA") & text.rlike(ACCESS), _spans(_located(text, ACCESS), 1, "access")).alias("_access"),
        _only_where(text.rlike(HEX), _spans(_located(text, HEX), 2, "hex")).alias("_hex"),
        _only_where(text.rlike(CANDIDATE), _entropy_spans(text)).alias("_hot"))
    base = found.select("_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.concat("_assign", "_access", "_hex").alias("_base"), "_hot")
    added = F.filter("_hot", lambda h: ~F.exists("_base", lambda b: (b["start"] <= h["start"]) & (h["end"] <= b["end"])))
    out = base.select("_id", "n_assign", "n_access", "n_hex", "_base", added.alias("_added"))
    return out.select(id_of("_id").alias(id_col), "n_assign", "n_access", "n_hex", F.sha2(_joined(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
                      _joined(F.concat("_base", "_added")).alias("spans"), F.size("_added").cast("long").alias("n_entropy"))


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
