"""Fields of any size: what must not cost the pairs of a race."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import elo, tables


def expected_by_pairs(ratings):
    return np.array([(1.0 / (1.0 + 10.0 ** ((ratings - r) / 400.0))).sum() - 0.5 for r in ratings])


def test_expected_wins_of_large_fields_are_those_of_all_pairs():
    rng = np.random.default_rng(5)
    for ratings in (rng.normal(1500, 150, 3000), rng.uniform(200, 4000, 700), np.full(999, 1500.0), np.repeat([900.0, 2100.0], 300)):
        assert np.abs(elo.expected_wins(ratings) - expected_by_pairs(ratings)).max() < 1e-11 * len(ratings)


def test_elo_of_fields_that_span_batches(spark):
    """Three races of 12,000 runners, each longer than an Arrow batch, with ties, unplaced runners and one that runs twice."""
    n = 12_000
    df = spark.range(3 * n).select(
        F.col("id").alias("result_id"), F.concat(F.lit("r"), (F.col("id") / n).cast("int")).alias("race_id"), F.lit("2024-01-01").cast("date").alias("race_date"), (F.col("id") / n).cast("int").alias("race_number"),
        F.when(F.col("id") % n == 7, 3).otherwise(F.col("id") * 7919 % n).alias("horse_id"), F.when(F.col("id") % 11 != 5, F.col("id") * 31 % 997 + 1).alias("finishing_position"),
    )
    found = {r["result_id"]: r["horse_elo_before"] for r in elo.add_elo(df).collect()}
    rows = [r for r in df.orderBy("result_id").collect()]
    ratings: dict = {}
    for race in (rows[:n], rows[n : 2 * n], rows[2 * n :]):
        before = np.array([ratings.get(r["horse_id"], 1500.0) for r in race])
        assert np.abs(before - np.array([found[r["result_id"]] for r in race])).max() < 1e-9
        placed = [i for i, r in enumerate(race) if r["finishing_position"] is not None]
        position = np.array([race[i]["finishing_position"] for i in placed], dtype=float)
        actual = np.array([(p < position).sum() + ((p == position).sum() - 1) / 2 for p in position])
        change = 16.0 * (actual - expected_by_pairs(before[placed])) / (len(placed) - 1)
        ratings |= {race[i]["horse_id"]: before[i] + c for i, c in zip(placed, change, strict=True)}
    assert len({round(x, 6) for x in ratings.values()}) > 3000


def test_balance_of_pairs_without_making_them(spark):
    """One group over all blocks and two billion pairs, beside small ones; equal values, rows without a value, a null group."""
    rng = np.random.default_rng(7)
    long = [("long", int(i), int(v)) for i, v in enumerate(rng.integers(0, 60_000, 65_000))]
    rows = long + [("few", 5, 2), ("few", 1, 3), ("few", 9, 3), ("few", 4, None), ("one", 1, 1), (None, 1, 1), (None, 2, 2), ("same", 1, 4), ("same", 2, 4)]
    df = spark.createDataFrame(rows, "g string, i long, x int").repartition(5)
    found = {r["g"]: (r["n_pairs"], r["balance"]) for r in tables.balance_of_pairs(df, "g", "i", "x").collect()}
    x = np.array([v for _, _, v in long])
    balance = sum(int(np.sign(x[at + 1 :] - v).sum()) for at, v in enumerate(x))
    assert found == {"long": (65_000 * 64_999 // 2, balance), "few": (3, 0), "same": (1, 0)}


def test_balance_of_pairs_is_that_of_the_pairs(spark):
    df = spark.range(900).select((F.col("id") * 31 % 7).alias("g"), (F.col("id") * 577 % 900).alias("i"), (F.col("id") * 13 % 41).cast("int").alias("x"))
    pairs = tables.pairs_in_group(df, ["g"], "i", ["x"]).groupBy("g").agg(F.count("*").alias("n"), F.sum(F.signum(F.col("b.x") - F.col("a.x")).cast("bigint")).alias("s"))
    assert sorted(map(tuple, tables.balance_of_pairs(df, "g", "i", "x").collect())) == sorted(map(tuple, pairs.collect()))


def test_few_days_are_sent_and_many_joined(spark, monkeypatch):
    """Days of a trainer are broadcast where they are few, and joined where not; both give the same."""
    from tidemark.plans import features

    df = spark.range(400).select((F.col("id") % 3).alias("trainer"), (F.col("id") % 9).cast("int").alias("_day"), F.lit(1).alias("_started"), (F.col("id") % 2).cast("int").alias("_is_win"), F.lit(1).alias("_is_top3"), F.col("id"))
    df = df.withColumn("trainer", F.when(F.col("trainer") > 0, F.col("trainer")))
    plain = features.entity_form(df, "trainer", "t")
    want = sorted(map(str, plain.collect()))
    for small, sent in ((1000, True), (0, False)):
        monkeypatch.setattr(features, "SMALL", small)
        made = features.entity_form(df, "trainer", "t", history=df, measured=True)
        assert sorted(map(str, made.collect())) == want
        assert ("ResolvedHint" in made._jdf.queryExecution().analyzed().toString()) == sent


def test_pairs_of_a_horse_over_rows_are_those_over_days(spark):
    from tidemark.plans import features

    df = spark.range(300).select(F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("horse_id"), (F.col("id") % 4).alias("jockey"), (F.col("id") * 5 % 11).cast("int").alias("_day"), (F.col("id") % 5 > 0).cast("int").alias("_started"), (F.col("id") % 2).cast("int").alias("_is_win"), F.lit(1).alias("_is_top3"), "id")
    combos = {"horse_jockey": ["horse_id", "jockey"]}
    over_rows, over_days = features.combo_of_horse(df, combos), features.combo_history(df, combos)
    assert sorted(map(str, over_rows.select(*over_days.columns).collect())) == sorted(map(str, over_days.collect()))
