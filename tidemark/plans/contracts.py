"""What must hold of tables before and after a build. Each check is a count; only counts and a few examples reach the driver."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators import windows as W

# Columns without which a history can't be built on.
REQUIRED = (
    "result_id", "race_id", "race_date", "racecourse_code", "race_number", "distance_m", "field_size", "horse_id", "horse_name", "horse_rating_before", "finishing_position", "is_winner", "is_top_three",
    "jockey", "trainer", "actual_weight", "declared_horse_weight", "draw", "margin", "finish_time", "race_class", "going", "surface", "course",
)


def _stacked(*parts: DataFrame) -> DataFrame:
    """(contract, n) of one-row frames of counts."""
    rows = [p.select(F.explode(F.array(*[F.struct(F.lit(c).alias("contract"), F.col(c).alias("n")) for c in p.columns])).alias("r")).select("r.*") for p in parts]
    return reduce(DataFrame.unionByName, rows)


def _repeated(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("result_id").count().where("count > 1").agg(F.count("*").alias(name))


def input_violations(history: DataFrame, rows: DataFrame) -> DataFrame:
    """(contract, n): result_ids that repeat in the history or in the rows to emit, and rows that the history lacks."""
    lost = rows.select("result_id").distinct().join(history.select("result_id"), "result_id", "left_anti").agg(F.count("*").alias("rows_not_in_history"))
    return _stacked(_repeated(history, "history_ids_repeated"), _repeated(rows, "row_ids_repeated"), lost)


def output_violations(built: DataFrame, rows: DataFrame, target: str = "is_winner") -> DataFrame:
    """(contract, n): ids that repeat in the output, rows that are missing or too many, and targets other than 0 and 1."""
    ids = lambda df: df.groupBy("result_id").agg(F.count("*").alias("n"))
    both = ids(built).withColumnRenamed("n", "a").join(ids(rows).withColumnRenamed("n", "b"), "result_id", "full")
    counts = both.agg(F.coalesce(F.sum(F.greatest(F.coalesce("b", F.lit(0)) - F.coalesce("a", F.lit(0)), F.lit(0))), F.lit(0)).alias("rows_missing"), F.coalesce(F.sum(F.greatest(F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0)), F.lit(0))), F.lit(0)).alias("rows_too_many"))
    bad = built.agg(F.count_if(~F.col(target).cast("double").isin(0.0, 1.0)).alias("target_not_0_or_1"))
    return _stacked(_repeated(built, "output_ids_repeated"), counts, bad)


def clean_violations(df: DataFrame) -> DataFrame:
    """(contract, n) of cleaned results; a dead heat that isn't finished is only to be looked at."""
    status, position = F.col("result_status"), F.col("finishing_position")
    no_time = F.upper(F.trim(F.coalesce(F.col("finish_time").cast("string"), F.lit("")))).isin("", "---", "-", "NAN", "NONE")
    return _stacked(df.agg(
        F.count_if((status == "FINISHED") & position.isNull()).alias("finished_without_position"), F.count_if((status == "DISQUALIFIED") & position.isNotNull()).alias("disqualified_with_position"),
        F.count_if((status == "DISQUALIFIED") & no_time).alias("disqualified_without_time"), F.count_if(F.col("is_dead_heat") & (status != "FINISHED")).alias("warning_dead_heat_not_finished"),
    ))


def watched_output(built: DataFrame, rows: DataFrame, place: str, target: str = "is_winner") -> tuple[DataFrame, Callable[[DataFrame], DataFrame], Observation]:
    """The built rows with the column ``place`` of the rows asked for; a function for ``write_checked`` that counts the output's
    contracts as rows are written, and leaves out those not asked for; and the counts. Repeated ids are found by a window that
    shares the join's exchange, so that nothing is scanned for a contract alone."""
    seen, ids = Observation("output"), W._spec(["result_id"])
    columns = built.columns
    built = built.withColumns({"_built": F.lit(True), "_copy": F.row_number().over(W._spec(["result_id"], [target])), "_copies": F.count(F.lit(1)).over(ids)})
    joined = rows.select("result_id", F.col(place), F.lit(True).alias("_asked")).join(built, "result_id", "full")

    def watch(df: DataFrame) -> DataFrame:
        is_built, asked = F.col("_built").isNotNull(), F.col("_asked").isNotNull()
        df = df.observe(
            seen, F.count_if(is_built & ~F.col(target).cast("double").isin(0.0, 1.0)).alias("target_not_0_or_1"), F.count_if(asked & ~is_built).alias("rows_missing"),
            F.count_if(is_built & (~asked | (F.col("_copy") > 1))).alias("rows_too_many"), F.count_if(is_built & (F.col("_copies") > 1) & (F.col("_copy") == 1)).alias("output_ids_repeated"),
        )
        return df.where(is_built & asked).select(*columns)

    return joined, watch, seen


def watched_first_pass(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Trainable rows as they are, and the eight contracts that they must keep, counted while they go by: rows, or races by their
    first row. All windows but that of result_id share one exchange by race."""
    seen = Observation("first_pass")
    status, position = F.upper(F.trim("result_status")), F.col("finishing_position")
    race, over_race = ["race_id"], lambda c, f: getattr(F, f)(c).over(W._spec(["race_id"]))
    # the helper columns hold what a contract needs of a row's race and of the rows with its ids
    helped = df.withColumns({
        "_n": over_race(F.lit(1), "count"), "_winners": over_race(F.when(position == 1, 1), "count"), "_low": over_race("actual_field_size", "min"), "_high": over_race("actual_field_size", "max"),
        "_of_race": F.row_number().over(W._spec(race, ["result_id"])), "_of_horse": F.row_number().over(W._spec(["race_id", "horse_id"], ["result_id"])),
    })
    helped = helped.withColumn("_of_id", F.row_number().over(W._spec(["result_id"], ["race_id"])))
    first = F.col("_of_race") == 1
    helped = helped.observe(
        seen, F.count_if(F.coalesce(status != "FINISHED", F.lit(True))).alias("only_finished"), F.count_if(position.isNull()).alias("position_known"),
        F.count_if(F.coalesce(status.isin("DISQUALIFIED", "NO_RESULT", "WITHDRAWN"), F.lit(False))).alias("no_bad_status"), F.count_if(F.col("_of_id") > 1).alias("result_id_unique"),
        F.count_if(F.col("_of_horse") > 1).alias("race_horse_unique"), F.count_if(first & (F.col("_n") < 2)).alias("two_runners"), F.count_if(first & (F.col("_winners") != 1)).alias("one_winner"),
        F.count_if(first & ((F.col("_low") != F.col("_n")) | (F.col("_high") != F.col("_n")))).alias("field_size_is_count"),
    )
    return helped.select(*df.columns), seen


def require(violations: DataFrame | dict[str, int], label: str) -> None:
    """An error that names every broken contract; warnings don't count."""
    counts = violations if isinstance(violations, dict) else {r["contract"]: r["n"] for r in violations.where("n > 0").collect()}
    broken = {k: n for k, n in counts.items() if n > 0 and not k.startswith("warning_")}
    if broken:
        raise ValueError(f"{label}: " + ", ".join(f"{k} ({n})" for k, n in sorted(broken.items())))


def validate_emit(history: DataFrame, rows: DataFrame) -> None:
    """Errors for lacking columns, repeated ids, and rows that the history doesn't know, of which ten are named."""
    from tidemark.operators.tables import require_columns

    require_columns(history, REQUIRED, "the history")
    require_columns(rows, REQUIRED, "the rows to emit")
    lost = rows.select(F.col("result_id").cast("string")).join(history.select(F.col("result_id").cast("string")), "result_id", "left_anti").orderBy("result_id").limit(10).collect()
    if lost:
        raise ValueError(f"rows that the history lacks, such as {', '.join(r[0] for r in lost)}")
    require(input_violations(history, rows), "history and rows")


def in_emit_order(built: DataFrame, rows: DataFrame, place: str) -> DataFrame:
    """The built rows in the order of ``rows`` by its column ``place``; ordered at the sink, so it costs one range exchange."""
    order = rows.select("result_id", F.col(place).alias("_place"))
    return built.join(order, "result_id").orderBy("_place").drop("_place")


def date_range(df: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """The rows of the days from start to end. Errors: start after end, days that are no dates, nothing left."""
    from tidemark.functions.dates import parse_day
    from tidemark.operators.tables import between_days

    kept = between_days(df.withColumn("_day", parse_day(F.col(day).cast("string"))), "_day", start, end)
    counts = df.agg(F.count_if(parse_day(F.col(day).cast("string")).isNull()).alias("bad")).first()
    if counts["bad"]:
        raise ValueError(f"{counts['bad']} rows whose {day} is no date")
    if kept.isEmpty():
        raise ValueError(f"no rows from {start} to {end}")
    return kept.drop("_day")
