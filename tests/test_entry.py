import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
TABLES = ["customer", "supplier", "part", "orders", "lineitem", "events", "pages", "conversations",
          "documents", "labels", "embeddings", "benchmark"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["time_ms", "sid", "surface"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    optional = set(entry.LLM_QUERIES)  # what SQL can't express is tested beside its operator
    assert set(entry.queries()) - optional == set(entry.oracle_sql()) - optional
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(round(x, 9))
        return str(x)
    return sorted("|".join(v(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
def test_queries_match_duckdb_at_small_scale(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    sql = entry.oracle_sql()
    bad = []
    for name, fn in entry.queries().items():
        if name not in sql:
            continue
        df = fn(spark, SMALL)
        got = _norm([tuple(r) for r in df.collect()], df.columns)
        res = con.execute(sql[name])
        cols = [d[0] for d in res.description]
        want = _norm(res.fetchall(), cols)
        if sorted(cols) != sorted(df.columns) or got != want:
            bad.append(name)
    assert bad == []


def test_a_subject_with_any_order_is_not_missing(spark, tmpdir_path):
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "c_custkey long, c_name string").write.parquet(f"{tmpdir_path}/customer.parquet")
    spark.createDataFrame([(1, "1-URGENT"), (2, "5-LOW")], "o_custkey long, o_orderpriority string").write.parquet(f"{tmpdir_path}/orders.parquet")
    assert [tuple(r) for r in entry.queries()["missing_subjects"](spark, tmpdir_path).collect()] == [(3, "c")]
