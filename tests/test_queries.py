"""Every query against its reference SQL, and every query without one for a stable schema."""

import pytest

import __spark_entry__ as entry_point
from compare import connect, run_pair

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_reference_sql(spark, con, name):
    assert run_pair(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None


#: Queries that SQL can't express: their key, and the table with a row for each of its values. Results are tested in tests/llm.
KEYED = {
    "op3_secret_scan": "doc_id", "op5_near_dedup": "doc_id", "op6_pieces": "doc_id", "op7_personal_data": "doc_id",
    "op10_toxicity": "doc_id", "op11_quality_rules": "doc_id", "op8_neighbours": "query_id", "pipeline": "doc_id"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_whole_tables_without_sql(spark, con, name):
    key = KEYED[name]
    got = sorted(r[0] for r in QUERIES[name](spark, SF_DIR).select(key).collect())
    docs = [r[0] for r in con.execute("select doc_id from documents order by 1").fetchall()]
    if name == "pipeline":
        assert set(got) < set(docs) and len(got) == len(set(got)) > len(docs) // 2
    elif name == "op8_neighbours":
        asked = [r[0] for r in con.execute("select vec_id from embeddings where vec_id % 50 = 0").fetchall()]
        assert got == sorted(asked * 5)
    else:
        assert got == docs
