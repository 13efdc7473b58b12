"""Tables with versions: upserts that leave other buckets' files alone, crashes, conflicts, pinned readers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import tables
from tidemark.sources import versioned
from tidemark.sources.versioned import Conflict, Versioned

SCHEMA = "id long, name string, seen string, n int"


def made(spark, tmp_path, rows=None, buckets=8):
    table = Versioned(spark, str(tmp_path / "t"), "id", buckets)
    rows = rows if rows is not None else [(i, f"n{i}", "old", i % 3) for i in range(200)]
    assert table.replace(spark.createDataFrame(rows, SCHEMA)) == 1
    return table


def files(tmp_path):
    return {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "t" / "data").rglob("*.parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    table = made(spark, tmp_path)
    before, old = files(tmp_path), rows(table.read())
    new = spark.createDataFrame([(3, "x", "new", None), (4, " ", "new", 9), (5, "y", "new", 0), (1000, "z", "", 1)], SCHEMA)
    touched = {r[0] for r in table._dealt(new).select("_bucket").collect()}
    assert 1 < len(touched) < 8
    assert table.merge(new, always=["seen"], accept=F.col("id") != 5) == 2
    after = files(tmp_path)
    assert {f: t for f, t in after.items() if f in before} == before  # nothing that was there is changed
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in after if f not in before} == touched
    wanted = {r[0]: r for r in old} | {3: (3, "x", "new", 0), 4: (4, "n4", "new", 9), 1000: (1000, "z", "", 1)}  # of ``always`` even a blank one comes
    assert rows(table.read()) == sorted(wanted.values(), key=repr) and rows(table.read(1)) == old
    read = {"t/" + f.split("/t/")[1] for f in table.read().inputFiles()}
    assert read & set(before) and not {f for f in read & set(before) if int(f.split("_bucket=")[1].split("/")[0]) in touched}


def test_merge_equals_the_join_and_refuses_repeated_keys(spark, tmp_path):
    table = made(spark, tmp_path, [(1, "a", "o", 1), (2, None, "o", 2), (None, "nk", "o", 3)])
    old = table.read()
    new = spark.createDataFrame([(2, "b", None, None), (None, "new nk", "n", 4), (7, None, None, None)], SCHEMA)
    wanted = rows(tables.merge_records(old, new, "id", ["seen"]))
    table.merge(new, always=["seen"])
    assert rows(table.read()) == wanted == sorted([(1, "a", "o", 1), (2, "b", None, 2), (None, "nk", "o", 3), (None, "new nk", "n", 4), (7, None, None, None)], key=repr)
    with pytest.raises(ValueError, match="twice"):
        table.merge(new.unionByName(new))
    assert table.version() == 2


def test_replace_and_append(spark, tmp_path):
    table = made(spark, tmp_path, [(1, "a", "o", 1), (1, "b", "o", 2), (2, "c", "o", 3)])
    table.replace_keys(spark.createDataFrame([(1, "only", "n", 0)], SCHEMA))
    assert rows(table.read()) == [(1, "only", "n", 0), (2, "c", "o", 3)]
    kept = files(tmp_path)
    more = spark.createDataFrame([(2, "no", "n", 0), (3, "yes", "n", 0), (3, "yes", "n", 0)], SCHEMA)
    table.append_new(more)
    table.append_new(more)
    assert rows(table.read()) == [(1, "only", "n", 0), (2, "c", "o", 3), (3, "yes", "n", 0)]
    assert {f: t for f, t in files(tmp_path).items() if f in kept} == kept
    assert rows(made(spark, tmp_path / "none", []).read()) == []


def test_a_job_may_replace_what_it_reads(spark, tmp_path):
    table = made(spark, tmp_path)
    pinned = table.read()
    table.replace(table.read().where("n = 1").withColumn("n", F.col("n") + 10))
    assert pinned.count() == 200 and {r[3] for r in rows(table.read())} == {11}
    with pytest.raises(ValueError, match="no table"):
        Versioned(spark, str(tmp_path / "nothing"), "id").read()


def test_a_crash_before_the_commit_leaves_the_old_table(spark, tmp_path, monkeypatch):
    table = made(spark, tmp_path)
    old, kept = rows(table.read()), files(tmp_path)

    def dies(*_):
        raise OSError("power cut")

    monkeypatch.setattr(Versioned, "_swap", dies)
    with pytest.raises(OSError, match="power cut"):
        table.merge(spark.createDataFrame([(1, "x", "new", 1)], SCHEMA))
    monkeypatch.undo()
    assert rows(table.read()) == old and files(tmp_path) == kept
    failing = F.udf(lambda i: 1 // (i - 1), "int")
    with pytest.raises(Exception, match="ZeroDivision"):
        table.replace(table.read().withColumn("n", failing("id")))
    assert rows(table.read()) == old and files(tmp_path) == kept and table.version() == 1


def test_the_second_of_two_writers_is_told(spark, tmp_path, monkeypatch):
    first = made(spark, tmp_path)
    second = Versioned(spark, first.path, "id")
    plain = Versioned._commit

    def overtaken(self, *args, **kw):
        if self is second:
            first.merge(spark.createDataFrame([(1, "first", "new", 1)], SCHEMA))
        return plain(self, *args, **kw)

    monkeypatch.setattr(Versioned, "_commit", overtaken)
    with pytest.raises(Conflict):
        second.merge(spark.createDataFrame([(2, "second", "new", 1)], SCHEMA))
    monkeypatch.undo()
    assert {r[1] for r in rows(first.read()) if r[2] == "new"} == {"first"}
    assert second.merge(spark.createDataFrame([(2, "second", "new", 1)], SCHEMA)) == 3


def test_forget_keeps_what_later_versions_share(spark, tmp_path):
    table = made(spark, tmp_path)
    for i in range(3):
        table.merge(spark.createDataFrame([(i, f"v{i}", "new", 1)], SCHEMA))
    now = rows(table.read())
    assert table.forget(keep=2) == [1, 2] and table.versions() == [3, 4]
    assert rows(table.read()) == now and table.read(3).count() == 200
    left = {f for v in (3, 4) for f in table.read(v).inputFiles()}
    assert {"t/" + f.split("/t/")[1] for f in left} == set(files(tmp_path))
    assert versioned.BUCKET not in table.read().columns
