"""Group aggregates that keep or report on rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import windows as W


def payout_shares(df: DataFrame, race: str, position: str, day: str) -> DataFrame:
    """Adds ``share``: n runners that tie at a position split the shares of that position and the n - 1 after it. The
    schedule is that of the race's first day; 0 without a position or a day."""
    ties = F.count(F.lit(1)).over(W._spec([race, position]))
    schedule = numbers.payout_schedule(F.min(day).over(W._spec([race])))
    df = df.withColumns({"_ties": ties.cast("int"), "_schedule": schedule})
    places = F.sequence(F.col(position), F.col(position) + F.col("_ties") - 1)
    total = F.aggregate(places, F.lit(0.0), lambda a, p: a + F.coalesce(F.try_element_at(F.col("_schedule"), p), F.lit(0.0)))
    share = F.when(F.col(position).isNull() | F.col("_schedule").isNull(), 0.0).otherwise(total / F.col("_ties"))
    return df.withColumn("share", share).drop("_ties", "_schedule")


def missing_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """name, n_missing and percent of each column, in one pass."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n_missing")) for c in columns]))
    return counts.select("_n", rows.alias("r")).select("r.name", "r.n_missing", F.round(F.col("r.n_missing") * 100.0 / F.col("_n"), 3).alias("percent"))
