"""Scalar numeric and conditional rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _both(a: Column, b: Column, then: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), then)


def relative_finish(position: Column, field: Column) -> Column:
    return F.when(field > 1, (position - 1).cast("double") / (field - 1).cast("double"))


def speed(distance: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, distance.cast("double") / seconds)


def draw_normalized(draw: Column, field: Column) -> Column:
    return F.when(field > 0, draw.cast("double") / field.cast("double"))


def draw_percentile(draw: Column, field: Column) -> Column:
    return F.when(field > 1, (draw - 1).cast("double") / (field - 1).cast("double"))


def draw_flags(percentile: Column) -> dict[str, Column]:
    inside, outside = percentile <= 0.33, percentile >= 0.67
    return {"inside_draw_flag": inside.cast("int"), "middle_draw_flag": (~inside & ~outside).cast("int"), "outside_draw_flag": outside.cast("int")}


def distance_bucket(d: Column) -> Column:
    return F.when(d <= 1200, "sprint_1200_or_less").when(d <= 1400, "1400").when(d <= 1650, "mile_1600_1650").when(d <= 2000, "middle_1800_2000").when(d > 2000, "staying_over_2000")


def going_bucket(going: Column) -> Column:
    g = F.upper(F.coalesce(going, F.lit("")))
    out = F.when(g.contains("FIRM"), "firm").when(g == "GOOD", "good").when(g.contains("YIELD"), "yielding").when(g.contains("SOFT"), "soft")
    return out.when(g.contains("WET"), "wet").when(g.contains("FAST"), "fast").otherwise("other")


def changed(now: Column, before: Column) -> Column:
    return _both(now, before, (now != before).cast("int"))


def conflict(a: Column, b: Column) -> Column:
    """1 if both are known and differ, else 0."""
    return F.coalesce((a != b).cast("int"), F.lit(0))


def prize_won(prize: Column, share: Column) -> Column:
    return F.bround(F.coalesce(prize.cast("double"), F.lit(0.0)) * share, 2)


def rate(part: Column, whole: Column, digits: int | None = None) -> Column:
    """part / whole, null where whole is 0; with ``digits`` rounded half-even and 0 for null."""
    out = F.try_divide(part.cast("double"), whole.cast("double"))
    return out if digits is None else F.coalesce(F.bround(out, digits), F.lit(0.0))


def time_split(day: Column, train_until: str, validate_until: str) -> Column:
    """An unknown day is in the test part."""
    return F.when(day <= F.lit(train_until).cast("date"), "train").when(day <= F.lit(validate_until).cast("date"), "validation").otherwise("test")


def payout_schedule(day: Column) -> Column:
    """Share of the prize by position; a sixth place is paid from 2023-09-10 on."""
    before, after = (F.create_map(*[F.lit(x) for kv in enumerate(s, 1) for x in kv]) for s in ((0.56, 0.21, 0.115, 0.06, 0.055), (0.56, 0.21, 0.115, 0.06, 0.035, 0.02)))
    return F.when(day < F.lit("2023-09-10").cast("date"), before).when(day.isNotNull(), after)


def result_status(race_status: Column, race_has_position: Column, position: Column, time: Column) -> Column:
    blank = F.upper(F.trim(F.coalesce(time, F.lit("")))).isin("", "---", "-", "NAN", "NONE")
    called_off = F.coalesce(F.upper(race_status).rlike("ABANDONED|NOT OFFERED"), F.lit(False))
    out = F.when(called_off, "ABANDONED").when(~race_has_position, "NO_RESULT").when(position.isNotNull(), "FINISHED")
    return out.when(blank, "WITHDRAWN").when(~blank, "DISQUALIFIED").otherwise("UNKNOWN")


def result_flags(status: Column, margin: Column) -> dict[str, Column]:
    return {"actually_started": status.isin("FINISHED", "DISQUALIFIED"), "is_completed": status == "FINISHED", "is_dead_heat": F.coalesce(F.upper(F.trim(margin)) == "DH", F.lit(False))}
