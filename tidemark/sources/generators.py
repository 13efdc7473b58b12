"""Sequences of days and of probes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import race_key


def days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from start to end, both inclusive."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))


def days_of(table: DataFrame, column: str, before: int = 0, after: int = 0) -> DataFrame:
    """Every day from the first to the last of a table's column, and some more on either side; none of a table without one."""
    ends = table.agg(F.min(F.col(column).cast("date")).alias("first"), F.max(F.col(column).cast("date")).alias("last")).where("first is not null")
    return ends.select(F.explode(F.sequence(F.date_sub("first", before), F.date_add("last", after))).alias("day"))


def probes(meetings: DataFrame, codes: Sequence[str], numbers: int) -> DataFrame:
    """day, code, number 1 to ``numbers`` and race_id for each day and code."""
    out = meetings.select("day", F.explode(F.array(*map(F.lit, codes))).alias("code"))
    out = out.select("day", "code", F.explode(F.sequence(F.lit(1), F.lit(numbers))).alias("number"))
    return out.withColumn("race_id", race_key(F.col("code"), F.col("day"), F.col("number")))
