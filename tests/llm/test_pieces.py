import numpy as np
import pytest
import sentencepiece

from gaugeflow.llm import pieces as op


@pytest.fixture(scope="module")
def model():
    return op.Model(op.default_model())


TEXTS = ["Hello world", "", " two  spaces   here ", "tab\tand\nline\n\n", "Ünïcödé 日本語 emoji 😀 done", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa",
         "x" * 300 + "the" * 100, "internationalization of tokenization", "ciónmenteear asiell", "\x00\x07 <0x41> <s> </s>"]


def whole(encoder, texts):
    ids, bounds = encoder.encode(texts, np.arange(len(texts)))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def restored(model, encoder, texts):
    ids, bounds = encoder.encode(texts, np.arange(len(texts)))
    raw, at = op.decode(model, ids, bounds)
    return [raw[at[i] + 1:at[i + 1]].decode() for i in range(len(texts))]


def test_without_dropout_it_is_the_library(spark, model):
    sp = sentencepiece.SentencePieceProcessor(model_file=op.default_model())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + [t for t in TEXTS if t]
    got = whole(op.Encoder(model, dropout=0.0), texts)
    for text, ids in zip(texts, got):
        assert ids == sp.encode(text, add_bos=False), text[:50]


def test_heap_and_steps_agree(model, monkeypatch):
    encoder = op.Encoder(model, seed=3, dropout=.3)
    steps = whole(encoder, TEXTS)
    monkeypatch.setattr(op, "LONGEST", 48)
    assert whole(encoder, TEXTS) == steps
    long = [t.replace(" ", "_") for t in TEXTS]
    for text in long:
        p = model.char_ids[[ord(c) for c in text]] if text else np.zeros(0, np.int32)
        if len(p) > 1 and (p >= 0).all():
            key = np.uint64(12345)
            rows, n = encoder._in_step(p[None, :].astype(np.int32), np.array([len(p)]), np.array([key]))
            assert rows[0, :n[0]].tolist() == encoder._by_heap(p, key).tolist()


def test_lossless_and_varied(model):
    texts = [*TEXTS, "mark ▁ itself▁", "▁"]
    outs = set()
    for seed in range(4):
        encoder = op.Encoder(model, seed=seed, dropout=.5)
        assert restored(model, encoder, texts) == texts
        assert whole(encoder, texts) == whole(encoder, texts)
        outs.add(tuple(whole(encoder, texts)[7]))
    assert len(outs) > 1
    assert whole(op.Encoder(model, dropout=1.0), ["abc"])[0] == [model.char_ids[ord(c)] for c in " abc"]


def test_documents(spark):
    rows = [(1, None), (2, ""), (None, "hello there"), (3, "word " * 20000), (3, "again"), (4, "z" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as _id", "'x' as lossless")
    got = op.encode_documents(df, op.default_model(), seed=5).collect()
    assert len(got) == 6 and all(r.lossless and r.n_tokens == len(r.ids) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2)} == {1}
    again = op.encode_documents(df.repartition(3), op.default_model(), seed=5).collect()
    assert sorted((r.ids_sha256 for r in got)) == sorted(r.ids_sha256 for r in again)
    assert op.encode_documents(df.limit(0), op.default_model()).collect() == []


def forms(encoder, text, ids):
    """Segmentations of the words of one text under several document ids."""
    ids, bounds = encoder.encode([text] * len(ids), np.array(ids))
    raw = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    starts = {i for i in range(encoder.model.size) if encoder.model.blob[encoder.model.ends[i]:encoder.model.ends[i + 1]].tobytes().startswith(b" ")}
    out = []
    for row in raw:
        cuts = [i for i, x in enumerate(row) if x in starts] + [len(row)]
        out.append([tuple(row[a:b]) for a, b in zip(cuts[:-1], cuts[1:])])
    return out


def test_every_occurrence_is_drawn(model):
    encoder = op.Encoder(model, seed=2, dropout=.3)
    one = forms(encoder, " ".join(["internationalization"] * 50), [7])[0]
    assert len(one) == 50 and len(set(one)) > 10
    assert len({row[0] for row in forms(encoder, "internationalization", list(range(50)))}) > 10


def test_sharing_changes_nothing(model, monkeypatch):
    texts = TEXTS * 20 + ["the same words in the same places of the text"] * 50
    encoder = op.Encoder(model, seed=4)
    shared = whole(encoder, texts)
    monkeypatch.setattr(op, "DRAWS", 7)
    monkeypatch.setattr(op, "ROWS", 5)
    assert whole(encoder, texts) == shared
    monkeypatch.setattr(op.Encoder, "_drawn", lambda self, of, keys, offered: np.flatnonzero(np.isin(of, offered[0])))
    assert whole(encoder, texts) == shared


def plain_agenda(encoder, pieces, key):
    """Best-scored pair first, leftmost of equals, every pair looked up anew; pieces and the distinct pairs that arose."""
    row, arose = [(i, int(x)) for i, x in enumerate(pieces)], set()
    while True:
        best = None
        for i in range(len(row) - 1):
            end = row[i + 2][0] if i + 2 < len(row) else len(pieces)
            place = [np.array([x]) for x in (row[i][0], row[i + 1][0], end)]
            arose.add(tuple(int(x[0]) for x in place))
            piece = int(encoder.model.pair(np.array([row[i][1]]), np.array([row[i + 1][1]]))[0])
            if piece >= 0 and not encoder._skipped(np.array([key]), *place)[0] and (best is None or encoder.model.scores[piece] > best[0]):
                best = encoder.model.scores[piece], i, piece
        if best is None:
            return [x for _, x in row], len(arose)
        _, i, piece = best
        row[i:i + 2] = [(row[i][0], piece)]


def test_steps_follow_the_plain_agenda_and_look_up_no_pair_twice(model, monkeypatch):
    encoder = op.Encoder(model, seed=1, dropout=.2)
    words = [" of", " the", "aa", " internationalization", " banana", "aaaaaaaaaa", " un", " word", " tokenizing"] * 3
    rows = [model.char_ids[[ord(c) for c in w]] for w in words]
    keys = np.arange(len(words), dtype=np.uint64)
    want = [plain_agenda(encoder, p, k) for p, k in zip(rows, keys)]
    asked, pair = [], op.Model.pair
    monkeypatch.setattr(op.Model, "pair", lambda self, left, right: asked.append(len(left)) or pair(self, left, right))
    width = max(map(len, rows))
    padded = np.array([np.pad(p, (0, width - len(p)), constant_values=-1) for p in rows])
    got, n = encoder._in_step(padded, np.array([len(p) for p in rows]), keys)
    assert [g[:k].tolist() for g, k in zip(got, n)] == [w for w, _ in want]
    assert all((g[k:] == -1).all() for g, k in zip(got, n))
    assert sum(asked) <= sum(k for _, k in want)
