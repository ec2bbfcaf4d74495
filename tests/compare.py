"""Run queries next to their reference SQL and compare whole results.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((c is not None, str(c)) for c in r))


def run_pair(spark, con, query, sql, sf_dir):
    """Error text, or None when both sides agree exactly."""
    df = query(spark, sf_dir)
    mine_cols, mine = _sorted_rows(df.columns, df.collect())
    cur = con.execute(sql)
    ref_cols, ref = _sorted_rows([d[0] for d in cur.description], cur.fetchall())
    if mine_cols != ref_cols:
        return f"columns {mine_cols} != {ref_cols}"
    if len(mine) != len(ref):
        return f"rows {len(mine)} != {len(ref)}"
    wrong = [(a, b) for a, b in zip(mine, ref) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ref)} rows differ, first: {mine_cols} {wrong[0]}"
    return None


def main() -> None:
    import __spark_entry__ as e
    from gaugeflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(e.queries())
    spark, con = build_session(8), connect(sf_dir)
    oracles = e.oracle_sql()
    bad = 0
    for name in names:
        started = time.time()
        try:
            if name in oracles:
                error = run_pair(spark, con, e.queries()[name], oracles[name], sf_dir)
                note = "ok" if error is None else f"WRONG {error}"
            else:
                note = f"rows only: {len(e.queries()[name](spark, sf_dir).collect())}"
        except Exception as exc:  # report and go on with the next query
            note = f"FAILED {type(exc).__name__} {str(exc)[:900]}"
        bad += note.startswith(("WRONG", "FAILED"))
        print(f"{name:32s} {time.time() - started:6.2f}s {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
