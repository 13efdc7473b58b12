"""Point-in-time windows. ``order`` always ends in a unique column; day frames take an integer day number.

Row-prior frames hold the rows before, date-prior ones the days before. The window operator holds one key's rows at a time
and spills them beyond a bound, so memory stays bounded, but one key is one task: keys whose rows grow with the input
(a trainer, say) are counted by day first. Bounded ranges are summed anew as they slide, so they suit rows of days too.
Windows whose partition keys start with one column share its exchange if the input is dealt by that column first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

UP = Window.unboundedPreceding


def _spec(keys: Sequence[str | Column], order: Sequence[str | Column] = ()) -> WindowSpec:
    w = Window.partitionBy(*keys)
    return w.orderBy(*[F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]) if order else w


def day_number(day: Column) -> Column:
    return F.unix_date(day)


def rows_before(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return _spec(keys, order).rowsBetween(UP, -1)


def days_before(keys: Sequence[str], day: str, days: int | None = None) -> WindowSpec:
    """All days before, or the last ``days`` of them; the row's own day is never in it."""
    return _spec(keys, [F.col(day)]).rangeBetween(UP if days is None else -days, -1)


def prior_sum(c: Column, w: WindowSpec) -> Column:
    """0 where nothing came before."""
    return F.coalesce(F.sum(c).over(w), F.lit(0).cast("bigint"))


def rank_min(x: Column, keys: Sequence[str], descending: bool = True) -> Column:
    """Competition rank, null for null."""
    return F.when(x.isNotNull(), F.rank().over(_spec(keys, [x.desc_nulls_last() if descending else x.asc_nulls_last()])))


def rank_pct(x: Column, keys: Sequence[str]) -> Column:
    """Average ascending rank by the number of non-null values."""
    ties = F.count(x).over(_spec([*keys, x]))
    return F.when(x.isNotNull(), (F.rank().over(_spec(keys, [x.asc_nulls_last()])) + (ties - 1) / 2.0) / F.count(x).over(_spec(keys)))


def field(x: Column, keys: Sequence[str], name: str) -> Column:
    """avg, median, max, min, stddev_samp, sum or count over the group."""
    return getattr(F, name)(x).over(_spec(keys))


def lead_or(x: Column, last: Column, keys: Sequence[str], order: Sequence[str]) -> Column:
    """The next row's value, also if it is null; ``last`` for the group's last row."""
    w = _spec(keys, order)
    return F.when(F.lead(F.lit(1)).over(w).isNull(), last).otherwise(F.lead(x).over(w))


def asof_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], event: Column, payload: dict[str, Column]) -> DataFrame:
    """Each row gets the payload of the last earlier row of its keys at which ``event`` holds. Null keys match nothing."""
    known = event
    for k in keys:
        known = known & F.col(k).isNotNull()
    packed = F.when(known, F.struct(*[c.alias(n) for n, c in payload.items()]))
    out = df.withColumn("_asof", F.last(packed, ignorenulls=True).over(rows_before(keys, order)))
    return out.select(*df.columns, *[F.col(f"_asof.{n}").alias(n) for n in payload])


def last_events(df: DataFrame, keys: Sequence[str], order: Sequence[str], event: Column, columns: dict[str, Column], n: int, name: str = "_last") -> DataFrame:
    """An array of structs: the columns of the last n earlier rows at which ``event`` holds, latest first. A row that is no
    event sees the same as an event would in its place. Null keys have no history."""
    known = event
    for k in keys:
        known = known & F.col(k).isNotNull()
    row = F.struct(*[c.alias(k) for k, c in columns.items()])
    df = df.withColumn("_event", F.coalesce(known, F.lit(False))).withColumn("_row", row)
    among = _spec([*keys, "_event"], order)
    lags = F.array(F.col("_row"), *[F.lag("_row", k).over(among) for k in range(1, n)])
    df = df.withColumn(name, F.when(F.col("_event"), lags))
    df = df.withColumn(name, F.last(name, ignorenulls=True).over(rows_before(keys, order)))
    return df.drop("_event", "_row")


def slope(values: Sequence[Column]) -> Column:
    """Least-squares slope over slots 0, 1, ..., nulls left out; null for fewer than two values."""
    there = [v.isNotNull().cast("double") for v in values]
    n = sum(there[1:], there[0])
    zero = [F.coalesce(v.cast("double"), F.lit(0.0)) for v in values]
    sx, sy, sxx, sxy = there[0] * 0, zero[0], there[0] * 0, zero[0] * 0
    for i in range(1, len(values)):
        sx, sxx, sy, sxy = sx + there[i] * i, sxx + there[i] * (i * i), sy + zero[i], sxy + zero[i] * i
    return F.when(n >= 2, F.try_divide(n * sxy - sx * sy, n * sxx - sx * sx))
