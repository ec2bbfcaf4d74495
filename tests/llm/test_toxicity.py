import math
import re
import zlib

import numpy as np
import pytest

from gaugeflow.llm import toxicity as op

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op.op10_toxicity(spark, SF).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= .7) for r in rows)
    out = [r for r in rows if r.held_out]
    caught = [r.predicted for r in out if r.toxic == 1]
    wrong = [r.predicted for r in out if r.toxic == 0]
    assert np.mean(caught) >= .7 and np.mean(wrong) <= .02


def plain_channels(g, text):
    """The same sums by looking at every word's surroundings, without tables of states."""
    out = dict.fromkeys(op.CHANNELS, 0.0)
    for clause in re.split(r"[.!?;:|\n]", text.lower()):
        words = re.findall(r"[^\W\d_]+", clause)
        for i, word in enumerate(words):
            weight = max((w for e, w in g.lexicon.items() if e == f"={word}" or not e.startswith("=") and len(e) in op.BEGINNINGS and word.startswith(e)), default=0)
            threat = not weight and word in op.THREATS

            def special(w, fixed):  # a fixed word that is no insult
                return w in fixed and g.symbol(w)[0] not in (op.INSULT, op.THREAT)

            def target(w):
                return special(w, op.TARGETS)

            aimed = any(map(target, words[max(0, i - 4):i] + words[i + 1:i + 5]))
            if not (weight and (aimed or len(words) > 2)) and not (threat and aimed):
                continue
            if any(special(w, op.REPORTS) for w in words[:i] + words[i + 1:]):
                name = "reported"
            elif any(special(w, op.NEGATIONS) for w in words[max(0, i - 3):i]):
                name = "negated"
            else:
                name = "threat" if threat else "aimed" if aimed else "predicated"
            out[name] += weight or op.LEAST_WEIGHT
    return [out[c] for c in op.CHANNELS]


def test_clauses_decide():
    g = op.Grammar({"=idiot": 3.0})

    def only(text):
        return {c: w for c, w in zip(op.CHANNELS, g.channels(text)) if w}

    assert only("Idiot.") == only("an idiot") == only("") == only("idiotic x1 was here") == {}
    assert only("the man is an idiot") == only("not here. An idiot came") == {"predicated": 3}
    assert only("you idiot") == only("idiot, you") == {"aimed": 3}
    assert only("you are not an idiot") == {"negated": 3}
    assert only("she said he is an IDIOT") == only("he is an idiot, she said") == {"reported": 3}
    assert only("they will kill") == only("I kill you") == {"threat": op.LEAST_WEIGHT} and only("kill the process") == {}


def test_machines_agree_with_a_plain_scorer():
    r = np.random.default_rng(3)
    g = op.Grammar({"=idiot": 3.0, "scum": 4.5, "=you": 0.0})
    words = ["idiot", "scummy", "kill", "you", "not", "said", "the", "a", "of", "Él", "x9", ".", "\n", "!", "word"]
    for _ in range(3000):
        text = " ".join(r.choice(words, r.integers(0, 16)))
        assert g.channels(text) == pytest.approx(plain_channels(g, text)), text


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_the_fitted_grammar_scores_clauses(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf{sf}/{t}.parquet") for t in ("documents", "labels"))
    g = op.fit(docs, labels)

    def score(text):
        return float(g.score([g.channels(text)])[0])

    for word in [e[1:] for e in g.lexicon if e.startswith("=")]:
        alone, aimed = score(word), score(f"you {word}")
        assert alone == score("") < op.REJECT
        assert aimed > score(f"the man was {word}") > max(score(f"she said he is {word}"), score(f"you are not {word}")) > alone
    assert score("I will kill you") > score("")
    for r in docs.limit(300).collect():
        evidence = [math.log1p(x) for x in plain_channels(g, r.text or "")]
        assert score(r.text or "") == pytest.approx(1 / (1 + math.exp(-g.weights[0] - sum(w * e for w, e in zip(g.weights[1:], evidence)))))


def test_weights_keep_their_order_against_the_labels():
    x = np.repeat(np.eye(5) * 8, 40, axis=0)
    for y in (np.zeros(200), np.r_[np.zeros(80), np.ones(80), np.zeros(40)]):
        plain, aimed, negated, reported, threat = op.ordered_logistic(op.design(x), y)[1:]
        assert aimed > plain > max(negated, reported) >= min(negated, reported, threat) > 0


def test_nulls_empty_clashing_names_and_filter(spark):
    docs = [(i, "the scoundrel of " + "x" * (i + 1)) if i % 2 else (i, f"the word {i}") for i in range(120)]
    docs += [(500, None), (501, ""), (None, "scoundrel"), (1, "the scoundrel of x again"), (502, "fine " * 50000), (503, "you fine " * 30000 + "scoundrel")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "'a' as _id", "2 as toxic")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)] + [(500, None), (None, 1)], "doc_id long, toxic int")
    g = op.fit(df, labels)
    assert "=scoundrel" in g.lexicon
    got = {r.doc_id: r.score for r in op.score(df, g).collect()}
    assert len(got) == 125 and op.score(df, g).count() == 126 and got[500] == got[501] == got[502] < .3 and got[None] == got[500] and got[503] > .7
    left = op.drop_toxic(df, g)
    assert left.schema == df.schema and {r.doc_id for r in left.collect()} == {i for i, s in got.items() if s < .7}
    none = op.fit(df, labels.limit(0))
    assert {r.score for r in op.score(df, none).collect()} == {.5}
    assert op.score(df.limit(0), g).collect() == []
