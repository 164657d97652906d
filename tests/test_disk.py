"""What the flows on files write to disk: tables, raw files and shuffles."""

import os
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from sensorweave import session
from sensorweave.operators import sequence as seq
from sensorweave.plans import source_queries
from sensorweave.sources import text


def _dealt(df):
    """The columns of every exchange of rows by a key, as Spark explains them."""
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [re.findall(r"(\w+)#\d+", cols) for cols in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)]


def _shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def _lineitem(spark, folder):
    # supplier 5 (subject 0) has 40 lines, supplier 15 (subject 1) has 12, supplier 27 has one
    rows = [(100 + i, 7 * i % 90, s, i % 7 + 1, float(i % 50), 1000.25 + i, (i % 11) / 100, (i % 9) / 100, "ANR"[i % 3], "FO"[i % 2])
            for s, n in ((5, 40), (15, 12), (27, 1)) for i in range(n)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{folder}/lineitem.parquet")
    return folder


def _same(df, sql, folder):
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet/*.parquet'")
        want = con.sql(sql)
        key = lambda row: tuple((x is None, round(x, 9) if isinstance(x, float) else x) for x in row)
        assert df.columns == want.columns
        assert sorted(map(key, df.collect())) == sorted(map(key, want.fetchall()))


@pytest.mark.parametrize("query", ["hugadb_layout", "mhealth_layout"])
@pytest.mark.parametrize("lines", [1 << 20, 10])
def test_raw_files_are_packed_up_to_a_size(spark, tmpdir_path, monkeypatch, query, lines):
    folder, roots, scratch = _lineitem(spark, tmpdir_path), [], source_queries._scratch
    monkeypatch.setattr(source_queries, "PACKED_LINES", lines)
    monkeypatch.setattr(source_queries, "_scratch", lambda *a: roots.append(scratch(*a)) or roots[-1])
    got = source_queries.QUERIES[query](spark, folder)
    _same(got, source_queries.ORACLE[query], folder)
    names = [f for _, _, found in os.walk(roots[0]) for f in found if f.startswith("part-")]
    files = {"hugadb_layout": (5, 2), "mhealth_layout": (3, 2)}[query]  # in all, and of more than ten lines
    assert len(names) == files[0]
    assert sum(n.endswith(".txt") for n in names) == (files[1] if lines == 10 else 0)
    assert sum(n.endswith(".txt.gz") for n in names) == files[0] - (files[1] if lines == 10 else 0)


def test_lines_are_made_text_after_they_are_dealt(spark):
    rows = spark.range(10).select((F.col("id") % 3).alias("sid"), F.col("id").alias("a"), F.lit("x").alias("unused"))
    out = source_queries._recording_lines(rows, ["sid"], ["a"], F.concat_ws(" ", *[F.col("a").cast("string")] * 30))
    assert _dealt(out) == [["sid", "a"]] and out.columns == ["value", "sid"]


def test_shuffles_of_a_write_are_removed_as_it_ends(spark, tmpdir_path):
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(cleanup)

    def left(name):  # shuffles of one write; they are removed in the background
        before, files = _shuffle_files(spark), None
        spark.range(1000).repartition(4, "id").write.parquet(os.path.join(tmpdir_path, name))
        for _ in range(100):
            files = _shuffle_files(spark) - before
            if not files:
                break
            time.sleep(0.1)
        return files

    with session.shuffles_removed(spark):
        assert not left("removed")
    assert spark.conf.get(cleanup) == setting
    assert left("kept")
    assert spark.read.parquet(os.path.join(tmpdir_path, "removed")).count() == 1000


def test_written_lines_are_packed(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "a.log"), "w") as fh:
        fh.write("1\t2\n")
    rows = text.read_delimited(spark, tmpdir_path, ["a", "b"]).rows
    assert any("/lines-" in f and ".zstd." in f for f in rows.inputFiles()) and rows.first().b == "2"


def test_a_fill_deals_the_rows_once(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("rec"), F.col("id").alias("t"), F.when(F.col("id") % 4 == 0, F.col("id")).alias("v"),
                                 F.col("id").cast("string").alias("payload"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        out = seq.seq_ffill(df, ["rec"], ["t"], "v", width=10.0)
        assert sum("payload" in columns for columns in _dealt(out)) == 1 and out.columns == df.columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kwargs", [{"width": 4.0}, {"segment": "part"}, {}, {"width": 4.0, "out": "filled"}])
def test_a_fill_keeps_rows_and_recordings_apart(spark, kwargs):
    # null and equal keys are recordings, a whole segment or recording may be without values, a row may be without place
    data = [(rec, t, t // 5, None if t % 9 or rec == "c" else f"{rec}{t}", [t]) for rec in (None, "a", "c") for t in range(40) if t % 13 > 1]
    data += [("a", None, None, None, [-1]), ("d", 3, 0, None, [3]), ("d", 4, 0, "d4", [4]), ("d", 900, 180, None, [900])]
    df = spark.createDataFrame(data, "rec string, t long, part long, v string, beside array<int>")
    got = seq.seq_ffill(df, ["rec"], ["t"], "v", **kwargs)
    assert got.columns == [*df.columns, *(["filled"] if "out" in kwargs else [])]
    want, last = [], {}
    for rec, t, part, v, beside in sorted(data, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        last[rec] = v or last.get(rec)
        want.append((rec, t, part, *((v, beside, last[rec]) if "out" in kwargs else (last[rec], beside))))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
