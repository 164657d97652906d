"""Line numbers under changing scan layouts, broken files, and records over several lines."""

import bz2
import csv
import gzip
import io
import os
import random

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from sensorweave.operators import align
from sensorweave.sources import text


def _write(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(content if isinstance(content, bytes) else content.encode())


@pytest.fixture()
def settings(spark):
    changed = []

    def put(name, value):
        changed.append(name)
        spark.conf.set(name, value)
    yield put
    for name in changed:
        spark.conf.unset(name)


def _reasons(scan):
    return sorted((os.path.basename(r.path), r.line_no, r.reason) for r in scan.rejects.collect())


def test_numbers_hold_when_the_scan_layout_changes(spark, tmpdir_path, settings):
    root = os.path.join(tmpdir_path, "layout")
    sizes = {f"f{i}.log": 200 + 37 * i for i in range(12)}
    for name, n in sizes.items():
        _write(f"{root}/{name}", "".join(f"{name}\t{i}\n" + ("surplus\ta\tb\n" if i % 50 == 7 and name < "f3" else "") for i in range(n)))
    for before, after in ((2, 8), (8, 2), (3, 4)):
        settings("spark.sql.files.minPartitionNum", str(before))
        scan = text.read_delimited(spark, root, ["who", "i"])
        settings("spark.sql.files.minPartitionNum", str(after))
        settings("spark.sql.files.maxPartitionBytes", "20000")
        got = sorted((r.who, r.i, r.line_no) for r in scan.rows.select("who", "i", "line_no").collect())
        assert len(got) == sum(sizes.values()) and all(str(n) == i for _, i, n in got)
        assert scan.rejects.count() == sum(len(range(7, n, 50)) for name, n in sizes.items() if name < "f3")


def test_a_file_that_grows_shifts_no_number(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "grows")
    for name in "abc":
        _write(f"{root}/{name}.csv", "i,x\n" + "".join(f"{i},{name}\n" for i in range(500)))
    scan = text.read_headed(spark, root, glob="*.csv")
    with open(f"{root}/a.csv", "a") as out:
        out.write("500,a\n501,a\n502,a\n")
    got = scan.rows.collect()
    assert len(got) == 1500 and all(str(r.line_no) == r.i for r in got)
    assert text.read_headed(spark, root, glob="*.csv").rows.count() == 1503


def _broken_folder(root, head, line):
    many = "".join(line(i) for i in range(20_000))
    _write(f"{root}/good.txt", head + line(1) + line(2))
    _write(f"{root}/empty.txt", "")
    _write(f"{root}/blank.txt", "\n \n\n")
    _write(f"{root}/latin.txt", (head + line(1)).encode() + b"\xff\xfe 2 3\n" + line(3).encode())
    packed = gzip.compress((head + many).encode())
    _write(f"{root}/whole.txt.gz", packed)
    _write(f"{root}/two.txt.gz", gzip.compress((head + line(1)).encode()) + gzip.compress(line(2).encode()))
    _write(f"{root}/cut.txt.gz", packed[: len(packed) // 2])
    _write(f"{root}/none.txt.gz", b"no packed file\n")
    _write(f"{root}/whole.txt.bz2", bz2.compress((head + line(1)).encode()))
    _write(f"{root}/cut.txt.bz2", bz2.compress((head + many).encode())[:-20])
    if head:
        _write(f"{root}/head.txt", head)


@pytest.mark.parametrize("layout", ["headed", "headerless", "commented", "delimited"])
def test_broken_files_cost_only_their_own_rows(spark, tmpdir_path, layout):
    root = os.path.join(tmpdir_path, layout)
    sep = {"headed": ",", "delimited": "\t"}.get(layout, " ")
    head = {"headed": "a,b,c\n", "commented": "# c\nnames of it\n"}.get(layout, "")
    _broken_folder(root, head, lambda i: f"{i}{sep}{i * 7919 % 1000}{sep}{i % 3}\n")
    scan = {"headed": lambda: text.read_headed(spark, root), "headerless": lambda: text.read_headerless(spark, root, 3),
            "commented": lambda: text.read_commented(spark, root, ["a", "b", "c"]), "delimited": lambda: text.read_delimited(spark, root, ["a", "b", "c"])}[layout]()
    counts = {r["name"]: r["count"] for r in scan.rows.groupBy("name").count().collect()}
    assert counts == {"good.txt": 2, "whole.txt.gz": 20_000, "two.txt.gz": 2, "whole.txt.bz2": 1}
    want = [("blank.txt", None, text.NO_LINES), ("cut.txt.bz2", None, text.UNREADABLE), ("cut.txt.gz", None, text.UNREADABLE), ("empty.txt", None, text.EMPTY),
            ("latin.txt", None, text.NOT_UTF8), ("none.txt.gz", None, text.UNREADABLE)]
    assert _reasons(scan) == sorted(want + ([("head.txt", None, text.NO_DATA)] if head else []))
    assert sorted(os.path.basename(r.path) for r in scan.files.collect() if "head.txt" not in r.path) == sorted(counts)


def test_sound_folders_are_scanned_once_and_strictly(spark, tmpdir_path, monkeypatch):
    root = os.path.join(tmpdir_path, "sound")
    _write(f"{root}/a.csv", "x\n1\n")
    monkeypatch.setattr(text, "_broken_files", lambda *a, **k: pytest.fail("looked for broken files"))
    assert text.read_headed(spark, root).rows.count() == 1


def _records(rng, n):
    parts = ["a", ",", '"', "\n", "  ", "é", "\n\n", "7", '""', "x\ny"]
    return [["".join(rng.choice(parts) for _ in range(rng.randint(0, 5))) for _ in range(3)] for _ in range(n)]


@pytest.mark.parametrize("split", [150, 1 << 20])
def test_quoted_fields_over_several_lines(spark, tmpdir_path, settings, split):
    # split sizes that cut records anywhere
    settings("spark.sql.files.maxPartitionBytes", str(split))
    settings("spark.sql.files.openCostInBytes", "0")
    rng, want = random.Random(split), []
    root = os.path.join(tmpdir_path, "quoted")
    for k in range(4):
        out, rows = io.StringIO(), _records(rng, 20 if split < 1000 else 400)
        writer = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL if k == 1 else csv.QUOTE_MINIMAL)
        writer.writerows([["A", "b", "c"], *rows])
        _write(f"{root}/f{k}.csv", out.getvalue())
        want += [(f"f{k}.csv", i, *r) for i, r in enumerate(rows)]
    _write(f"{root}/plain.csv", "c,a\n1,2\n\n \n3,4\n")
    want += [("plain.csv", 0, "2", None, "1"), ("plain.csv", 1, "4", None, "3")]
    scan = text.read_headed(spark, root, columns=["a", "b", "c"], skip_initial_space=False, strip=False)
    got = [(r["name"], r.line_no, r.a, r.b, r.c) for r in scan.rows.collect()]
    assert sorted(got, key=lambda r: r[:2]) == want and scan.rejects.count() == 0


def test_quotes_that_open_nothing_and_quotes_that_stay_open(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "stray")
    _write(f"{root}/inch.csv", 'a,b\n5" pipe,1\nx,7"\n"two\nlines",3\nz,4\n')
    _write(f"{root}/open.csv", 'a,b\n1,2\n"never closed,3\n4,5\n6,7\n')
    _write(f"{root}/head.csv", '"a\nb",c\n1,2\n')
    _write(f"{root}/surplus.csv", 'a,b\n"1\n",2,3\n4,5\n')
    scan = text.read_headed(spark, root, columns=["a", "b"])
    got = sorted((r["name"], r.line_no, r.a, r.b) for r in scan.rows.collect())
    assert got == [("inch.csv", 0, '5" pipe', "1"), ("inch.csv", 1, "x", '7"'), ("inch.csv", 2, "two\nlines", "3"), ("inch.csv", 3, "z", "4"),
                   ("open.csv", 0, "1", "2"), ("surplus.csv", 1, "4", "5")]
    assert _reasons(scan) == [("head.csv", None, text.LONG_HEADER), ("open.csv", 1, text.OPEN_QUOTE), ("surplus.csv", 0, "more fields than header")]
    short = text.read_headed(spark, root, columns=["a", "b"], max_record_lines=1, glob="inch.csv")
    assert _reasons(short) == [("inch.csv", 2, text.LONG_RECORD)] and short.rows.count() == 3


def test_long_quoted_fields_need_no_deep_recursion(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "long")
    field = 'say ""x"", ' * 20_000
    _write(f"{root}/a.csv", f'a,b\n"{field}",1\n"{field}\n",2\n')
    rows = sorted(text.read_headed(spark, root, skip_initial_space=False).rows.collect(), key=lambda r: r.line_no)
    assert [r.a.rstrip("\n") for r in rows] == [field.replace('""', '"')] * 2 and [r.b for r in rows] == ["1", "2"]


def _written_plans(monkeypatch, module):
    plans, write = {}, module.materialize

    def seen(df, name, *rest):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, *rest)

    monkeypatch.setattr(module, "materialize", seen)
    return plans


@pytest.mark.parametrize("header", [True, False])
def test_summaries_of_splits_sort_no_lines(spark, tmpdir_path, monkeypatch, header):
    for i in range(3):
        with open(os.path.join(tmpdir_path, f"f{i}.csv"), "w") as f:
            f.write("".join(f"{c}\n" for c in ["a,b"] * header + [f"{i},{n}" for n in range(20)]))
    plans = _written_plans(monkeypatch, text)
    scan = text.read_headed(spark, tmpdir_path) if header else text.read_headerless(spark, tmpdir_path, 2)
    assert "HashAggregate" in plans["splits"] and "SortAggregate" not in plans["splits"]
    assert sorted(tuple(r)[3:] for r in scan.rows.collect()) == sorted((str(i), str(n)) for i in range(3) for n in range(20))


def test_files_are_listed_for_rejects_only_when_asked(spark, tmpdir_path, monkeypatch):
    with open(os.path.join(tmpdir_path, "f.csv"), "w") as f:
        f.write("1,2\n3,4,5\n")
    listed, find = [], text.list_files
    monkeypatch.setattr(text, "list_files", lambda *a, **k: listed.append(a) or find(*a, **k))
    scan = text.read_headerless(spark, tmpdir_path, 2)
    assert scan.rows.count() == 1 and not listed
    assert scan.rejects.count() == 1 and len(listed) == 1


def test_many_columns_are_coerced_like_few(spark):
    cells = ["1", " 2.5 ", "1d", "0x1p3", "nan", "inf", "-1e3", "", None, "x", "7", "8"]
    names = [f"c{i}" for i in range(len(cells))]
    df = spark.createDataFrame([cells], ", ".join(f"{n} string" for n in names))
    many = text.as_double(df, names)
    assert [many.schema[n].dataType.simpleString() for n in names] == ["double"] * len(cells)
    assert list(many.first()) == [text.as_double(df, [n]).first()[n] for n in names] == [1.0, 2.5, None, None, None, float("inf"), -1000.0, None, None, None, 7.0, 8.0]
    digits = ["1", " 2.5\t", "1-2", "", None, "+7", "-.5", "3.", "1,5", "é", "--1", "9" * 400]
    plain = spark.createDataFrame([digits], df.schema)
    got = list(text.as_double(plain, names).first())
    assert got == [text.as_double(plain, [n]).first()[n] for n in names] and got[:8] == [1.0, 2.5, None, None, None, 7.0, -0.5, 3.0]
    assert "transform(" in many._jdf.queryExecution().optimizedPlan().toString()


def test_alignment_sorts_no_samples(spark, monkeypatch):
    plans = _written_plans(monkeypatch, align)
    df = spark.createDataFrame([(1, 1, "a", 1.0, None), (1, 1, "b", 2.0, 5.0), (1, 2, "a", 3.0, 4.0), (2, 1, "a", 1.0, 1.0), (2, 1, "a", None, None)],
                               "sid int, t int, s string, x double, y double")
    wide, bad = align.widen_or_set_aside(df, ["sid"], "t", "s", ["a", "b"], ["x", "y"])
    assert "SortAggregate" not in plans["aligned"] and [r.sid for r in bad.collect()] == [2]
    assert sorted(tuple(r) for r in wide.select("t", "a_x", "a_y", "b_x", "b_y").collect()) == [(1, 1.0, None, 2.0, 5.0), (2, 3.0, 4.0, None, None)]


def test_rules_on_paths_are_not_asked_of_every_line_without_need(spark, tmpdir_path, monkeypatch):
    root = os.path.join(tmpdir_path, "keep")
    _write(f"{root}/x=1/a.txt", "1,2\n3,4\n")
    _write(f"{root}/x=2/a.txt", "5,6\n")
    rule = lambda p: F.regexp_extract(p, r"x=(\d)/", 1).try_cast("int").isNotNull()
    plans = _written_plans(monkeypatch, text)
    kept = text.read_headerless(spark, root, 2, where=rule, skip_names=["readme.txt"])
    assert "regexp_extract" not in plans["lines"] and "readme" not in plans["lines"] and kept.rows.count() == 3
    # files that break the rules, one of them unreadable, are left out as before and are no rejects of lines
    _write(f"{root}/x=y/a.txt", "7,8\n9,9,9\n")
    os.makedirs(f"{root}/z")
    with open(f"{root}/z/a.txt.gz", "wb") as f:
        f.write(b"no packed file")
    some = text.read_headerless(spark, root, 2, where=rule, skip_names=["readme.txt"])
    assert "regexp_extract" in plans["lines"] and some.rows.count() == 3 and some.rejects.count() == 0


@pytest.mark.parametrize("pattern", [r"\s+", r"\s+|,", "\t", r"(?=;)"])
def test_separators_are_counted_as_fields_are_split(spark, pattern):
    lines = ["", "a", "a b", "a  b", "a , b", "a,,b", ",", "a b c d", "a\tb \t c", "\t\t\t", "a\r b c d", "a,b c,d", ";a;b;c", "  é x y"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    for n in (1, 2, 3):
        found = df.select(F.trim("line").alias("line")).select("line", text._fits(F.col("line"), pattern, n).alias("fits"), (F.size(F.split("line", pattern, -1)) <= n).alias("split"))
        assert [r for r in found.collect() if r.fits != r.split] == []
    plan = df.select(text._fits(F.col("line"), r"\s+", 3))._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan


def test_cells_without_letters_are_cast_as_one_array(spark):
    names = [f"c{i}" for i in range(10)]
    rows = [["1", " 2", "-0", "1e5", "", None, "7,", "0.1", "+3", "٣"], ["1", "2", "nan", "INF", "1d", "0X1", "x", "5F", "-infinity", "1E2"]]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    many = text.as_double(df, names)
    assert "array<double>" in many._jdf.queryExecution().optimizedPlan().toString()
    one = [text.as_double(df, [n]).select(n).collect() for n in names]
    assert [[str(v) for v in r] for r in many.collect()] == [[str(c[i][0]) for c in one] for i in range(2)]


def test_sensor_folders_are_listed_once_for_schema_and_rows(spark, tmpdir_path, monkeypatch):
    root = os.path.join(tmpdir_path, "folders")
    for sid, column in (("001", "x"), ("2", " X")):
        spark.range(2).select(F.lit(sid).alias("sid"), F.lit("a").alias("sensor"), F.col("id").cast("double").alias(column)).write.mode("append").partitionBy("sid", "sensor").parquet(root)
    read, parquet = [], DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *a, **k: read.append(a) or parquet(self, *a, **k))
    guess = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(guess)
    long, absent = text.read_sensor_folders(spark, root, ["a", "b"], values=["x"])
    assert len(read) == 1 and spark.conf.get(guess) == before
    assert sorted((r.sid, r.sensor, r.x) for r in long.collect()) == [("001", "a", 0.0), ("001", "a", 1.0), ("2", "a", 0.0), ("2", "a", 1.0)]
    assert sorted(tuple(r) for r in absent.collect()) == [("001", "b"), ("2", "b")]
