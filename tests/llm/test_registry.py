import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.01"


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


@pytest.mark.parametrize("name", ["op7_exact_topk", "op8_mix_sources", "op11_vector_codes", "op12_decontaminate", "op13_hard_negatives"])
def test_sql_twins(spark, name):
    from spanlog.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())
