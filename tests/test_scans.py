"""Segmented scans against plain windows and loops."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import scans
from tidemark.operators import windows as W


def rows_with_hot_key(spark, n=3000):
    rng = np.random.default_rng(3)
    keys = [None if x < 0.2 else "hot" if x < 0.55 else f"k{rng.integers(0, 90)}" for x in rng.random(n)]
    rows = [(i, k, int(rng.integers(0, 60)) if rng.random() > 0.05 else None, int(rng.integers(-5, 9)) if rng.random() > 0.3 else None) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "id long, k string, day int, x long").repartition(7).withColumn("_n", F.lit("clash"))


@pytest.mark.parametrize("blocks, own", [(1, False), (5, False), (64, True)])
def test_scans_equal_windows(spark, blocks, own):
    df = rows_with_hot_key(spark)
    order = ["day", "id"]
    w = W._spec(["k"], order).rowsBetween(W.UP, 0 if own else -1)
    wanted = df.select("id", F.sum("x").over(w).alias("total"), F.bit_xor("x").over(w).alias("mixed"), F.last("x", ignorenulls=True).over(w).alias("latest"), F.row_number().over(W._spec(["k"], order)).cast("long").alias("n"))
    cut = scans.in_blocks(df, ["k"], order, blocks=blocks)
    found = scans.scan(scans.numbered(cut, ["k"]), ["k"], {"total": F.col("x")}, {"latest": F.col("x")}, {"mixed": F.col("x")}, own)
    assert set(found.columns) == {*df.columns, "n", "total", "mixed", "latest", scans.BLOCK, scans.PLACE}
    assert sorted(map(tuple, found.select("id", "total", "mixed", "latest", "n").collect())) == sorted(map(tuple, wanted.collect()))
    if blocks == 64:
        most = cut.groupBy(scans.BLOCK).count().agg(F.max("count")).first()[0]
        assert most < 300  # over a third of 3,000 rows have one key


def test_blocks_of_another_make(spark):
    df = rows_with_hot_key(spark).withColumns({scans.BLOCK: F.col("id") % 10, scans.PLACE: F.col("id") % 10 * 10_000 + F.col("id")})
    wanted = df.select("id", F.sum("x").over(W._spec(["k"], [scans.PLACE])).alias("total"))
    assert sorted(map(repr, scans.scan(df, ["k"], {"total": F.col("x")}, own=True, send=False).select("id", "total").collect())) == sorted(map(repr, wanted.collect()))


def test_two_keys_and_empty_tables(spark):
    df = rows_with_hot_key(spark).withColumn("j", F.col("id") % 2)
    w = W._spec(["k", "j"], ["id"]).rowsBetween(W.UP, -1)
    found = scans.scan(scans.in_blocks(df, ["k", "j"], ["id"], blocks=20), ["k", "j"], {"total": F.col("x")})
    assert sorted(map(repr, found.select("id", "total").collect())) == sorted(map(repr, df.select("id", F.sum("x").over(w).alias("total")).collect()))
    assert scans.scan(scans.in_blocks(df.limit(0), ["k"], ["id"]), ["k"], {"total": F.col("x")}).count() == 0


def test_asof_equals_window(spark):
    df = rows_with_hot_key(spark)
    event, payload = F.col("x") > 3, {"p_id": F.col("id"), "p_x": F.col("x")}
    a = scans.asof_before(df, ["k"], ["day", "id"], event, payload)
    b = W.asof_before(df, ["k"], ["day", "id"], event, payload)
    assert a.columns == b.columns
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_dense_global_order(spark):
    df = rows_with_hot_key(spark)
    found = {r["id"]: r["ordinal"] for r in scans.in_order(df, ["day", "k", "id"], blocks=11).collect()}
    last = lambda x: (x is None, x if x is not None else 0)
    wanted = sorted(df.collect(), key=lambda r: (last(r["day"]), (r["k"] is None, r["k"] or ""), r["id"]))
    assert found == {r["id"]: i for i, r in enumerate(wanted)}
    assert scans.in_order(df.limit(0), ["id"]).count() == 0
