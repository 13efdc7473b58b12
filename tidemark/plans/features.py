"""The feature build: every run of a history with what was known before it.

Stages are functions DataFrame -> DataFrame on the columns of a run (see plans.runs). Everything is computed on the whole
history; rows to emit are filtered last. Input null keys: an event without horse has no history; contexts, trainers and
jockeys treat null as a value. The stages that partition by horse come one after another, so that they cost one exchange.
Those of trainers, jockeys and pairs work on days: a row a key and day, however many runs, is what a window holds of a key,
and the rows meet their day in a join, which is broadcast or split where it is skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text
from tidemark.operators import elo
from tidemark.operators import windows as W
from tidemark.plans.runs import ORDER
from tidemark.sources.scratch import settled

# The names of what is remembered of a start, of the contexts and of the pairs.
KEPT_ALONG = {
    "date": "race_date", "race_id": "race_id", "finish": "finishing_position", "relative_finish": "_relative_finish", "margin_lengths": "_margin_lengths",
    "finish_time_seconds": "_finish_time_seconds", "speed_mps": "_speed_mps", "speed_context_z": "_speed_context_z",
    "time_behind_winner_seconds": "_time_behind_winner_seconds", "distance_m": "distance_m", "race_class": "race_class", "race_class_num": "_race_class_num",
    "horse_rating_before": "horse_rating_before", "horse_rating_after": "horse_rating_after", "actual_weight": "actual_weight",
    "declared_horse_weight": "declared_horse_weight", "draw": "draw", "odds": "odds", "track": "racecourse_code", "surface": "surface", "course": "course",
    "going": "going", "jockey": "jockey", "trainer": "trainer", "field_size": "field_size", "field_avg_rating": "field_avg_rating",
    "field_max_rating": "field_max_rating", "rating_vs_field_mean": "rating_vs_field_mean", "is_winner": "_is_win", "is_top_three": "_is_top3",
}

CONTEXTS = {
    "distance": ["distance_m"], "track": ["racecourse_code"], "track_distance": ["racecourse_code", "distance_m"], "surface": ["surface"], "going": ["going"],
    "class": ["race_class"], "distance_surface": ["distance_m", "surface"], "track_surface": ["racecourse_code", "surface"],
}
COMBOS = {"horse_jockey": ["horse_id", "jockey"], "trainer_jockey": ["trainer", "jockey"]} | {
    f"{who}_{name}": [who, c] for who in ("trainer", "jockey") for name, c in (("track", "racecourse_code"), ("distance", "distance_m"), ("class", "race_class"), ("surface", "surface"))
}
FORM_DAYS = (30, 90, 180, 365)
WORKLOAD_DAYS = (14, 30, 60, 90, 180, 365)
HELPERS_PREFIX = "_"


def hemispheres(df: DataFrame) -> dict[str, Column]:
    if "country_of_origin" not in df.columns:
        return {}
    derived = dates.derived_hemisphere(F.col("country_of_origin"))
    out = {"hemisphere_of_origin_derived": derived}
    return out | ({"hemisphere_mapping_conflict": numbers.conflict(derived, F.col("hemisphere_of_origin"))} if "hemisphere_of_origin" in df.columns else {})


def base_helpers(df: DataFrame) -> DataFrame:
    position, seconds = F.col("finishing_position"), text.finish_seconds(F.col("finish_time"))
    started = position.isNotNull() if "actually_started" not in df.columns else F.coalesce(F.col("actually_started").cast("boolean"), F.lit(False))
    return df.withColumns({
        "_started": started.cast("int"), "_is_win": F.coalesce(position == 1, F.lit(False)).cast("int"), "_is_top3": F.coalesce(position <= 3, F.lit(False)).cast("int"),
        "_day": W.day_number(F.col("race_date")), "_relative_finish": numbers.relative_finish(position, F.col("field_size")),
        "_margin_lengths": F.coalesce(text.margin_lengths(F.col("margin")), F.when(position == 1, 0.0)), "_finish_time_seconds": seconds,
        "_speed_mps": numbers.speed(F.col("distance_m"), seconds), "_race_class_num": text.class_number(F.col("race_class")),
        "distance_bucket": numbers.distance_bucket(F.col("distance_m")), "going_bucket": numbers.going_bucket(F.col("going")),
    } | hemispheres(df) | dates.date_parts(F.col("race_date")))


def outcome_helpers(df: DataFrame) -> DataFrame:
    """Time behind the winner of the race."""
    winner = F.min(F.when(F.col("finishing_position") == 1, F.col("_finish_time_seconds"))).over(W._spec(["race_id"]))
    return df.withColumn("_time_behind_winner_seconds", F.col("_finish_time_seconds") - winner)


SPEED_CONTEXT = ("racecourse_code", "surface", "course", "distance_m", "going")


def context_speed_z(df: DataFrame, least: int = 20, context: Sequence[str] = SPEED_CONTEXT, history: DataFrame | None = None) -> DataFrame:
    """Speed against all timed runs of earlier races in the same context: race totals first, then running totals of races.
    A race's context is the first known value of each column; null contexts and null race_ids are values of their own.
    ``history``: a table of the same runs, from which the races are made at once, to be sent to the rows if they are few."""
    order = F.struct("race_date", "race_number", "result_id")
    timed = (df if history is None else history).where("_speed_mps is not null")
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in context]
    race = timed.groupBy("race_id").agg(F.min(order).alias("o"), F.sum("_speed_mps").alias("s"), F.sum(F.col("_speed_mps") * F.col("_speed_mps")).alias("ss"), F.count("*").alias("n"), *first)
    before = W._spec(context, ["o"]).rowsBetween(W.UP, -1)
    n = F.sum("n").over(before)
    race = race.select("race_id", n.alias("_n"), (F.sum("s").over(before) / n).alias("_mean"), (F.sum("ss").over(before) / n).alias("_square"))
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("_square") - F.col("_mean") * F.col("_mean")))
    race = race.select(F.col("race_id").alias("_race"), "_n", "_mean", std.alias("_std"))
    out = df.join(race if history is None else sent_if_small(race, "speeds"), F.col("race_id").eqNullSafe(F.col("_race")), "left")
    z = F.when((F.col("_n") >= least) & (F.col("_std") > 0), (F.col("_speed_mps") - F.col("_mean")) / F.col("_std"))
    return out.select(*df.columns, z.alias("_speed_context_z"))


def field_features(df: DataFrame) -> DataFrame:
    race, r = ["race_id"], F.col("horse_rating_before")
    out = {f"field_{n}_rating": W.field(r, race, f) for n, f in (("avg", "avg"), ("median", "median"), ("max", "max"), ("min", "min"))}
    out["field_rating_std"] = W.field(r, race, "stddev_samp")
    df = df.withColumns(out)
    draw, size = F.col("draw"), F.col("field_size")
    percentile = numbers.draw_percentile(draw, size)
    more = {"field_rating_range": F.col("field_max_rating") - F.col("field_min_rating"), "rating_rank_in_field": W.rank_min(r, race), "rating_percentile_in_field": W.rank_pct(r, race)}
    more |= {f"rating_vs_field_{n}": r - F.col(f"field_{c}_rating") for n, c in (("mean", "avg"), ("median", "median"), ("max", "max"))}
    more |= {"draw_normalized": numbers.draw_normalized(draw, size), "draw_percentile": percentile} | numbers.draw_flags(percentile)
    for name, c in (("carried_weight", "actual_weight"), ("bodyweight", "declared_horse_weight")) + ((("horse_elo", "horse_elo_before"),) if "horse_elo_before" in df.columns else ()):
        mean = W.field(F.col(c).cast("double"), race, "avg")
        more |= {f"{name}_rank_in_field": W.rank_min(F.col(c), race), f"{name}_vs_field_mean": F.col(c) - mean}
        if name != "horse_elo":
            more[f"field_avg_{name}"] = mean
    return df.withColumns(more)


def _median(values: Sequence[Column]) -> Column:
    """The median of a few columns of one row, nulls left out."""
    known = F.array_sort(F.array_compact(F.array(*values)))
    at = lambda i: F.get(known, i.cast("int"))
    return (at(F.floor((F.size(known) - 1) / 2)) + at(F.floor(F.size(known) / 2))) / 2.0


def _started_history(df: DataFrame, slots: int, fields: Sequence[str], spans: Sequence[int]) -> dict[str, Column]:
    """What is known right after each start: some columns of the last starts and their summaries."""
    payload = F.struct(*[(F.col(KEPT_ALONG[k]) if KEPT_ALONG[k] in df.columns else F.lit(None).cast("double")).alias(k) for k in fields])
    w = W._spec(["horse_id", "_started"], ORDER)
    out = {f"start{k}": payload if k == 1 else F.lag(payload, k - 1).over(w) for k in range(1, slots + 1)}
    out["ordinal"] = F.row_number().over(w)
    finish = F.col("finishing_position").cast("double")
    finishes = [finish if k == 0 else F.lag(finish, k).over(w) for k in range(max(spans, default=0))]
    for n in spans:
        last = w.rowsBetween(1 - n, 0)
        over = lambda name, c, last=last: getattr(F, name)(F.col(c).cast("double")).over(last)
        wins, top3, count = over("sum", "_is_win"), over("sum", "_is_top3"), F.count("finishing_position").over(last)
        summary = {
            "avg_finish": over("avg", "finishing_position"), "median_finish": _median(finishes[:n]),
            "best_finish": over("min", "finishing_position"), "worst_finish": over("max", "finishing_position"), "finish_std": over("stddev_samp", "finishing_position"),
            "avg_relative_finish": over("avg", "_relative_finish"), "avg_margin_lengths": over("avg", "_margin_lengths"), "avg_speed_mps": over("avg", "_speed_mps"),
            "best_speed_mps": over("max", "_speed_mps"), "speed_std": over("stddev_samp", "_speed_mps"), "avg_speed_context_z": over("avg", "_speed_context_z"),
            "wins": wins, "top3": top3, "win_rate": F.try_divide(wins, count.cast("double")), "top3_rate": F.try_divide(top3, count.cast("double")),
        }
        out |= {f"{k}_last{n}": c for k, c in summary.items()}
    return out


#: The parts of a horse's history, each with the fields of past starts that it needs.
TRENDS = {"finish_trend_last5": "finish", "relative_finish_trend_last5": "relative_finish", "speed_trend_last5": "speed_mps"}
CHANGED = {"track": "racecourse_code", "surface": "surface", "course": "course", "going": "going", "jockey": "jockey", "trainer": "trainer"}
CHANGE_FIELDS = ("date", "race_class_num", "declared_horse_weight", "distance_m", "horse_rating_before", "horse_rating_after", "actual_weight", *CHANGED)
PARTS = ("workload", "lags", "summaries", "trends", "changes")


def horse_history(df: DataFrame, lags: int = 10, parts: Sequence[str] = PARTS, spans: Sequence[int] = (3, 5, 10)) -> DataFrame:
    """Lags, summaries, recency, coverage, workload, changes and form, as of each row: what was known right after the horse's
    last start before the row. Three windows of one exchange; nothing is kept for runs without horse. ``parts``: what is made;
    a part alone carries only the starts and columns that it needs. ``spans``: of how many starts summaries are made."""
    if "_speed_context_z" not in df.columns:
        df = df.withColumn("_speed_context_z", F.lit(None).cast("double"))
    known, parts = F.col("horse_id").isNotNull(), set(parts) - ({"trends"} if lags < 5 else set())
    slots = lags if "lags" in parts else 5 if "trends" in parts else 1
    fields = [k for k in KEPT_ALONG if "lags" in parts or ("trends" in parts and k in TRENDS.values()) or ("changes" in parts and k in CHANGE_FIELDS)] or ["date"]
    columns = df.columns
    workload = [F.when(known, W.prior_sum(F.col("_started").cast("bigint"), W.days_before(["horse_id"], "_day", d))).alias(f"starts_last{d}d") for d in WORKLOAD_DAYS if "workload" in parts]
    df = df.select("*", *workload)  # first, so that the rows are dealt by horse
    columns = df.columns
    if not parts - {"workload"}:
        return df
    after = _started_history(df, slots, fields, [x for x in spans if x <= lags and "summaries" in parts])
    df = df.select("*", *[c.alias(f"_h_{k}") for k, c in after.items()])
    packed = F.when((F.col("_started") == 1) & known, F.struct(*[F.col(f"_h_{k}").alias(k) for k in after]))
    df = df.select(*columns, packed.alias("_after"))
    df = df.select(*columns, F.last("_after", ignorenulls=True).over(W.rows_before(["horse_id"], ORDER)).alias("_known"))
    slot = lambda k: F.col("_known")[f"start{k}"]
    out = [slot(k)[name].alias(f"last{k}_{name}") for k in range(1, lags + 1) for name in KEPT_ALONG if "lags" in parts]
    out += [F.col("_known")[k].alias(k) for k in after if "_last" in k]
    derived = F.col("_known")["ordinal"]
    if "trends" in parts:
        out += [W.slope([slot(k)[source] for k in (5, 4, 3, 2, 1)]).alias(name) for name, source in TRENDS.items()]
        out.append(F.coalesce(text.form_string([slot(k)["finish"] for k in range(1, 6)]), F.lit("")).alias("form_last5_latest_first"))
    if "changes" not in parts:
        return df.select(*columns, *out)
    out.append(derived.alias("prior_completed_starts_derived"))
    out.append(F.datediff("race_date", slot(1)["date"]).alias("days_since_last_start"))
    stored = F.col("career_starts_before") if "career_starts_before" in columns else F.lit(None).cast("int")
    out += [F.when(stored.isNotNull() & derived.isNotNull(), F.greatest(F.lit(0), stored - derived)).alias("history_starts_missing_before"), F.when(stored > 0, derived / stored.cast("double")).alias("history_coverage_ratio"),
            F.when(stored.isNotNull() & derived.isNotNull(), (stored == derived).cast("int")).alias("history_appears_complete_flag")]
    class_change = F.col("_race_class_num") - slot(1)["race_class_num"]
    body = F.col("declared_horse_weight") - slot(1)["declared_horse_weight"]
    out += [
        (F.col("distance_m") - slot(1)["distance_m"]).alias("distance_change_from_last"), (F.col("horse_rating_before") - slot(1)["horse_rating_before"]).alias("rating_change_from_last_start_pre"),
        (F.col("horse_rating_before") - slot(1)["horse_rating_after"]).alias("rating_change_since_last_official"), (F.col("actual_weight") - slot(1)["actual_weight"]).alias("actual_weight_change_from_last"),
        body.alias("bodyweight_change_from_last"), F.try_divide(body.cast("double"), slot(1)["declared_horse_weight"].cast("double")).alias("bodyweight_change_pct_from_last"),
        class_change.alias("class_number_change_from_last"), F.when(class_change.isNotNull(), (class_change > 0).cast("int")).alias("class_drop_flag"),
        F.when(class_change.isNotNull(), (class_change < 0).cast("int")).alias("class_rise_flag"),
    ]
    out += [numbers.changed(F.col(c), slot(1)[n]).alias(f"{n}_change_flag") for n, c in CHANGED.items()]
    return df.select(*columns, *out)


def _totals(w) -> dict[str, Column]:
    starts, wins, top3 = (W.prior_sum(F.when(F.col("_started") == 1, F.col(c)).cast("bigint"), w) for c in ("_started", "_is_win", "_is_top3"))
    return {"starts": starts, "wins": wins, "top3": top3, "win_rate": numbers.rate(wins, starts), "top3_rate": numbers.rate(top3, starts)}


def context_history(df: DataFrame, contexts: dict[str, Sequence[str]] = CONTEXTS) -> DataFrame:
    """Row-prior totals of a horse's starts and means of its runs in each context."""
    out = []
    for name, keys in contexts.items():
        w = W.rows_before(["horse_id", *keys], ORDER)
        found = _totals(w) | {"avg_relative_finish": F.avg("_relative_finish").over(w), "avg_speed_mps": F.avg("_speed_mps").over(w)}
        out += [c.alias(f"horse_{name}_{k}_before") for k, c in found.items()]
    return df.select(*df.columns, *out)


#: A table of at most so many rows, each of some keys and a few numbers, is sent to the tasks.
SMALL = 50_000


def sent_if_small(df: DataFrame, name: str) -> DataFrame:
    """``df`` made once, and broadcast if it was found to be small: else a join would move its other side before it knew."""
    made = settled(df, name)
    return F.broadcast(made) if made.count() <= SMALL else made


def _daily(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Starts, wins and places of a day for each value of the keys, null ones too: a row a day, however many runs."""
    started = lambda c: F.sum(F.when(F.col("_started") == 1, F.col(c)).otherwise(0).cast("bigint")).alias(c)
    return df.groupBy(*keys, "_day").agg(*[started(c) for c in ("_started", "_is_win", "_is_top3")])


def _with_daily(df: DataFrame, keys: Sequence[str], daily: DataFrame, new: dict[str, Column], measured: bool = False) -> DataFrame:
    """``new``, computed over the days of the keys, on every row of these keys and that day. ``measured``: they are made at once,
    and sent to the rows if they are few."""
    on = [*keys, "_day"]
    found = daily.select(*[F.col(c).alias(f"_on_{c}") for c in on], *[c.alias(n) for n, c in new.items()])
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    return df.join(sent_if_small(found, "days") if measured else found, match, "left").select(*df.columns, *new)


def entity_form(df: DataFrame, entity: str, prefix: str, days: Sequence[int] = FORM_DAYS, history: DataFrame | None = None, measured: bool = False) -> DataFrame:
    """Career totals and calendar windows of a trainer or jockey, all before the day. ``history``: the runs that count, those
    of ``df`` itself if not given; where stages follow each other it keeps the plan from doubling with each."""
    daily, career = _daily(df if history is None else history, [entity]), _totals_of_days(W.days_before([entity], "_day"))
    new = {f"{prefix}_career_starts_before_derived": career["starts"], f"{prefix}_career_win_rate_before": career["win_rate"], f"{prefix}_career_top3_rate_before": career["top3_rate"]}
    for d in days:
        w = W.days_before([entity], "_day", d)
        starts, wins, top3 = (F.sum(c).over(w) for c in ("_started", "_is_win", "_is_top3"))
        new |= {f"{prefix}_starts_{d}d": starts, f"{prefix}_win_rate_{d}d": numbers.rate(wins, starts), f"{prefix}_top3_rate_{d}d": numbers.rate(top3, starts)}
    return _with_daily(df, [entity], daily, new, measured)


def _totals_of_days(w) -> dict[str, Column]:
    starts, wins, top3 = (W.prior_sum(F.col(c), w) for c in ("_started", "_is_win", "_is_top3"))
    return {"starts": starts, "wins": wins, "top3": top3, "win_rate": numbers.rate(wins, starts), "top3_rate": numbers.rate(top3, starts)}


def combo_history(df: DataFrame, combos: dict[str, Sequence[str]] = COMBOS, history: DataFrame | None = None, measured: bool = False) -> DataFrame:
    """Date-prior totals of pairs, from the runs of ``history`` (see ``entity_form``)."""
    history = df if history is None else history
    for prefix, keys in combos.items():
        new = {f"{prefix}_{k}_before": c for k, c in _totals_of_days(W.days_before(keys, "_day")).items()}
        df = _with_daily(df, keys, _daily(history, keys), new, measured)
    return df


def combo_of_horse(df: DataFrame, combos: dict[str, Sequence[str]]) -> DataFrame:
    """As ``combo_history`` for pairs of a horse, in windows over the rows: a horse's days are about as many as its rows."""
    new = {f"{prefix}_{k}_before": c for prefix, keys in combos.items() for k, c in _totals(W.days_before(keys, "_day")).items()}
    return df.select("*", *[c.alias(n) for n, c in new.items()])


#: Names, columns and whether more is better, of what is compared with the field after all histories are known.
RECENT = {
    "recent_speed": ("avg_speed_mps_last5", True, "field_avg_recent_speed_last5"),
    "recent_form": ("avg_relative_finish_last5", False, "field_avg_recent_relative_finish_last5"),
}
AFTER_HISTORY = {
    "career_win_rate": "career_win_rate_before", "trainer_form": "trainer_win_rate_90d", "jockey_form": "jockey_win_rate_90d",
    "horse_track_win_rate": "horse_track_win_rate_before", "horse_distance_win_rate": "horse_distance_win_rate_before",
    "horse_track_distance_win_rate": "horse_track_distance_win_rate_before",
}


#: The columns that the comparison needs, and those that the summaries are made of.
_COMPARED = {
    "result_id", "race_id", "horse_id", *ORDER, "_started", "_day", "finishing_position", "_is_win", "_is_top3", "_relative_finish", "_margin_lengths", "_speed_mps", "_speed_context_z", *AFTER_HISTORY.values(),
}


#: What a field's statistics are made of.
_FIELD = {"result_id", "race_id", "horse_rating_before", "draw", "field_size", "actual_weight", "declared_horse_weight"}
#: What contexts and pairs of a horse are run over beside these; the names of the summaries of last starts.
_RUN_OVER = {c for keys in (*CONTEXTS.values(), *COMBOS.values()) for c in keys}
_SUMMARIES = (
    "avg_finish", "median_finish", "best_finish", "worst_finish", "finish_std", "avg_relative_finish", "avg_margin_lengths", "avg_speed_mps", "best_speed_mps", "speed_std",
    "avg_speed_context_z", "wins", "top3", "win_rate", "top3_rate",
)


def post_history_field(df: DataFrame) -> DataFrame:
    """Ranks and differences from the field's mean of what the earlier stages found; columns that aren't there are left out."""
    out = []
    for name, (c, better_high, field) in (RECENT | {k: (c, True, "") for k, c in AFTER_HISTORY.items()}).items():
        if c in df.columns:
            x = F.col(c).cast("double")
            mean = W.field(x, ["race_id"], "avg")
            out += ([mean.alias(field)] if field else []) + [(x - mean).alias(f"{name}_vs_field_mean"), W.rank_min(x, ["race_id"], better_high).alias(f"{name}_rank_in_field")]
    return df.select(*df.columns, *out)


def market(df: DataFrame) -> DataFrame:
    implied = F.when(F.col("odds") > 0, 1.0 / F.col("odds"))
    over = F.coalesce(W.field(implied, ["race_id"], "sum"), F.lit(0.0))
    rank = W.rank_min(F.col("odds"), ["race_id"], descending=False)
    return df.withColumns({"market_implied_probability_raw": implied, "market_overround": over, "market_implied_probability_normalized": F.try_divide(implied, over), "market_rank": rank, "market_favourite_flag": F.when(rank.isNotNull(), (rank == 1).cast("int"))})


def training_metadata(df: DataFrame, train_until: str = "2024-07-31", validate_until: str = "2025-07-31") -> DataFrame:
    return df.withColumns({
        "ml_target_is_winner": F.coalesce(F.col("finishing_position") == 1, F.lit(False)).cast("int"), "ml_group_id": F.col("race_id"),
        "ml_split": numbers.time_split(F.col("race_date"), train_until, validate_until), "ml_row_weight": F.lit(1.0),
    })


def build_features(history: DataFrame, emit: DataFrame | None = None, lags: int = 10, include_market: bool = False, keep_helpers: bool = False, with_elo: bool = True) -> DataFrame:
    """All stages on the history, then the rows to emit: the history's columns first, new ones after them.

    ``emit``: result_ids, all of them known to the history. Rows stay narrow as long as they move: trainers', jockeys' and pairs'
    days are counted from the first stage's table and, where they turn out few, sent to the rows; a field's statistics, a horse's contexts and
    what is compared with the field are joined from passes over the few columns that they need. The 400 wide columns of the horses'
    histories are made last, from rows that are dealt by horse once, and cross no exchange."""
    lags = max(1, lags)
    parts = int(history.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, but many windows: not to be put together
    base = settled(outcome_helpers(base_helpers(history)), "runs")
    field = base.select(*[c for c in base.columns if c in _FIELD])
    if with_elo:
        field = field.join(settled(elo.elo_of(base), "elo"), F.col("result_id") == F.col("_result"), "left").drop("_result")
    field = field_features(field.repartition(parts, "race_id"))
    field = settled(field.select(F.col("result_id").alias("_of"), *[c for c in field.columns if c not in base.columns]), "fields")
    df = context_speed_z(base.join(field, F.col("result_id").eqNullSafe(F.col("_of")), "left").drop("_of"), history=base)
    for entity in ("trainer", "jockey"):
        df = entity_form(df, entity, entity, history=base, measured=True)
    of_horse = {name: keys for name, keys in COMBOS.items() if keys[0] == "horse_id"}
    df = combo_history(df, {name: keys for name, keys in COMBOS.items() if name not in of_horse}, history=base, measured=True)
    df = settled(market(df) if include_market else df, "narrow")
    run_over = df.select(*[c for c in df.columns if c in _COMPARED or c in _RUN_OVER]).repartition(parts, "horse_id")
    found = combo_of_horse(context_history(run_over), of_horse)
    found = post_history_field(horse_history(found, lags, ["summaries"], [5]) if lags >= 5 else found)
    summaries = {f"{x}_last5" for x in _SUMMARIES}
    found = settled(found.select(F.col("result_id").alias("_of"), *[c for c in found.columns if c not in run_over.columns and c not in summaries]), "found")
    df = df.join(found, F.col("result_id").eqNullSafe(F.col("_of")), "left").drop("_of").repartition(parts, "horse_id")
    df = training_metadata(horse_history(df, lags))
    if emit is not None:
        df = df.join(emit.select("result_id").distinct(), "result_id", "left_semi")
    df = df.select(*dict.fromkeys([*history.columns, *df.columns]))
    return df if keep_helpers else df.drop(*[c for c in df.columns if c.startswith(HELPERS_PREFIX)])
