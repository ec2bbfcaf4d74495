import brute
import corpus_pipeline
import pytest

import compare
from gaugeflow.llm import pieces, toxicity
from gaugeflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_match_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        tables.append((docs, spark.read.parquet(f"{tmp_path}/{i}")))
        docs = tables[-1][1]
    rows = [[{r.doc_id: r for r in t.collect()} for t in pair] for pair in tables]
    assert all(after.columns == columns for _, after in tables[:-1])
    before, after = rows[0]
    grammar = toxicity.fit(tables[0][0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert {i for i, s in toxicity.score(tables[0][0], grammar).collect() if s < toxicity.REJECT} == set(after)
    before, after = rows[1]
    assert {r[0]: r[3] for r in brute.removed_lines([(i, r.text) for i, r in before.items()])} == {i: r.text for i, r in after.items()}
    assert all(r.n_chars == len(r.text) for r in after.values())
    before, after = rows[2]
    classes = brute.near_classes([(i, r.text) for i, r in before.items()])
    assert set(after) == {i for i, (_, c) in classes.items() if i == c}
    before, after = rows[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(after) == {r[0] for r in brute.contaminated([(i, x.text) for i, x in before.items()], items) if not r[2]}
    before, after = rows[4]
    assert set(after) == set(before) and all(r.lossless for r in after.values())
    model = pieces.Model(pieces.default_model())
    import numpy as np
    for i, r in after.items():
        raw, _ = pieces.decode(model, np.array(r.ids), np.array([0, len(r.ids)]))
        assert raw.decode()[1:] == before[i].text


@pytest.mark.parametrize("name", ["op2_line_dedup", "op9_substring_dedup"])
def test_matches_sql(spark, name):
    assert compare.run_pair(spark, compare.connect(SF), QUERIES[name], ORACLES[name], SF) is None
