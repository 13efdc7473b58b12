"""Clean, slice, first pass: from results to the rows a model may learn from. The order of the steps matters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import tables
from tidemark.operators import windows as W


def add_result_status(df: DataFrame) -> DataFrame:
    """result_status, actually_started, is_completed, is_dead_heat. A race without any position has no result."""
    seen = F.coalesce(F.max(F.col("finishing_position").isNotNull()).over(W._spec(["race_id"])), F.lit(False))
    seen = F.when(F.col("race_id").isNull(), F.col("finishing_position").isNotNull()).otherwise(seen)
    said = F.coalesce(*[F.col(c) for c in ("race_status", "race_status_raw") if c in df.columns], F.lit(None).cast("string"))
    df = df.withColumn("_seen", seen).withColumn("result_status", numbers.result_status(said, F.col("_seen"), F.col("finishing_position"), F.col("finish_time"))).drop("_seen")
    return df.withColumns(numbers.result_flags(F.col("result_status"), F.col("margin")))


def first_pass(df: DataFrame, remove_dead_heats: bool = True) -> DataFrame:
    """Whole races with a disqualification or without result go, then all but finishers, then races with two winners;
    the field size is that of what is left."""
    status = F.upper(F.trim("result_status"))
    df = tables.without_groups(df, "race_id", status.isin("DISQUALIFIED", "NO_RESULT"))
    df = df.where(status == "FINISHED").drop("horse_age_at_race")
    if remove_dead_heats:
        df = tables.groups_having(df, "race_id", F.sum(F.coalesce(F.col("finishing_position") == 1, F.lit(False)).cast("int")), 1)
    size = F.when(F.col("race_id").isNotNull(), F.count("*").over(W._spec(["race_id"])).cast("short"))
    return df.withColumn("actual_field_size", size)


def violations(df: DataFrame) -> DataFrame:
    """(contract, n) of each data contract that the trainable rows break; all in two passes."""
    status, position = F.upper(F.trim("result_status")), F.col("finishing_position")
    rows = df.agg(
        F.count_if(F.coalesce(status != "FINISHED", F.lit(True))).alias("only_finished"), F.count_if(position.isNull()).alias("position_known"),
        (F.count("*") - F.countDistinct("result_id")).alias("result_id_unique"), (F.count("*") - F.countDistinct("race_id", "horse_id")).alias("race_horse_unique"),
    )
    race = df.groupBy("race_id").agg(F.count("*").alias("n"), F.count_if(position == 1).alias("winners"), F.min("actual_field_size").alias("low"), F.max("actual_field_size").alias("high"))
    races = race.agg(F.count_if(F.col("n") < 2).alias("two_runners"), F.count_if(F.col("winners") != 1).alias("one_winner"), F.count_if((F.col("low") != F.col("n")) | (F.col("high") != F.col("n"))).alias("field_size_is_count"))
    stacked = [t.select(F.explode(F.array(*[F.struct(F.lit(c).alias("contract"), F.col(c).alias("n")) for c in t.columns])).alias("r")).select("r.*") for t in (rows, races)]
    return stacked[0].unionByName(stacked[1])
