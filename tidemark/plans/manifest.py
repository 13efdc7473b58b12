"""The machine-readable feature manifest."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Outcomes of the row's own race, identifiers and columns for display or audit, what the build adds beside
# features, none of which is a predictor; and the categorical columns.
OUTCOMES = (
    "finishing_position", "is_winner", "is_top_three", "margin", "finish_time", "prize_payout_percentage", "prize_money_won_this_race", "career_prize_money_after",
    "horse_rating_after", "result_status", "is_completed", "is_dead_heat",
)
IDENTIFIERS = (
    "result_id", "race_id", "race_url", "horse_profile_url", "horse_profile_scraped_at", "horse_name", "race_name", "brand_number", "actual_field_size",
    "actually_started", "career_prize_money_before", "race_date",
)
TRAINING = ("ml_target_is_winner", "ml_group_id", "ml_split", "ml_row_weight")
CATEGORICAL = (
    "racecourse_code", "racecourse_name", "race_class", "rating_band", "going", "surface", "course", "country_of_origin", "hemisphere_of_origin",
    "hemisphere_of_origin_derived", "horse_colour", "horse_sex", "sire", "dam", "dam_sire", "jockey", "trainer", "distance_bucket", "going_bucket",
    "form_last5_latest_first",
)
LAGGED = re.compile(r"last\d+_(race_class|track|surface|course|going|jockey|trainer)")


def predictors(columns: Sequence[str], include_market: bool = False) -> tuple[list[str], list[str]]:
    """(predictors in the columns' order, the categorical ones among them sorted)."""
    never = {*OUTCOMES, *IDENTIFIERS, *TRAINING}
    market = lambda c: c == "odds" or c.startswith("market_")
    out = [c for c in columns if c not in never and not c.startswith("_") and (include_market or not market(c))]
    return out, sorted(c for c in out if c in CATEGORICAL or LAGGED.fullmatch(c))


def predictor_rows(spark: SparkSession, columns: Sequence[str], include_market: bool = False) -> DataFrame:
    used, categorical = predictors(columns, include_market)
    return spark.createDataFrame([(c, c in used, c in categorical) for c in columns], "column string, predictor boolean, categorical boolean")


def manifest(df: DataFrame, generated: Sequence[str], train_until: str, validate_until: str, include_market: bool = False, sources: dict[str, str] | None = None) -> str:
    """What a training job needs to know of a build, as JSON. ``sources``: paths of the history, the emitted rows, the output."""
    used, categorical = predictors(df.columns, include_market)
    return json.dumps({
        "target": "is_winner", "preferred_target_alias": "ml_target_is_winner", "group_id": "race_id", "preferred_group_alias": "ml_group_id", **(sources or {}),
        "generated_feature_count": len(generated), "generated_columns": list(generated), "recommended_predictor_count": len(used), "recommended_predictor_columns": used,
        "recommended_categorical_columns": categorical, "never_use_as_current_race_predictors": sorted({*OUTCOMES, *IDENTIFIERS}), "market_features_enabled": include_market,
        "recommended_split": {"train": f"race_date <= {train_until}", "validation": f"{train_until} < race_date <= {validate_until}", "test": f"race_date > {validate_until}"},
        "warnings": [
            "Features are computed on the whole history; rows are filtered afterwards.",
            "Outcomes of the row's own race are never predictors.",
            "Odds and market columns are predictors only if they were known at the time of prediction.",
            "Profile columns that change over time aren't history.",
        ],
    }, indent=2)
