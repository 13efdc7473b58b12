"""Filters, joins, upserts and duplicates between tables. All are joins or aggregates on keys; none collects."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def complete_schema(df: DataFrame, schema: Sequence[tuple[str, str]]) -> DataFrame:
    """The declared columns in the declared order; a missing one is null."""
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in schema])


def require_columns(df: DataFrame, needed: Sequence[str], label: str) -> None:
    if gone := [c for c in needed if c not in df.columns]:
        raise ValueError(f"{label} lacks columns: {', '.join(gone)}")


def between_days(df: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """Both ends inclusive."""
    if start > end:
        raise ValueError(f"{start} is after {end}")
    return df.where(F.col(day).cast("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def without_groups(df: DataFrame, key: str, bad: Column) -> DataFrame:
    """Without the groups that have a bad member; rows without a key stay."""
    return df.join(df.where(bad).select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def groups_having(df: DataFrame, key: str, total: Column, most: int) -> DataFrame:
    """Only groups whose total is at most ``most``; rows without a key stay."""
    over = df.where(F.col(key).isNotNull()).groupBy(key).agg(total.alias("_total")).where(F.col("_total") > most).select(key)
    return df.join(over, key, "left_anti")


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str], overwrite: dict[str, str], keep_last_by: Column | None = None) -> DataFrame:
    """Left join that replaces columns where a row matches and keeps them where none does. Duplicate keys of ``dim``: the
    last by ``keep_last_by``. Whether ``dim`` is broadcast is left to its size at run time."""
    if keep_last_by is not None:
        dim = dim.groupBy(*on).agg(*[F.max_by(c, keep_last_by).alias(c) for c in set(overwrite.values())])
    dim = dim.select(*[F.col(k).alias(f"_k_{k}") for k in on], *[F.col(c).alias(f"_d_{c}") for c in set(overwrite.values())], F.lit(True).alias("_matched"))
    cond = None
    for k in on:
        same = F.col(k) == F.col(f"_k_{k}")
        cond = same if cond is None else cond & same
    joined = df.join(dim, cond, "left")
    return joined.select(*[F.when(F.col("_matched"), F.col(f"_d_{overwrite[c]}")).otherwise(F.col(c)).alias(c) if c in overwrite else F.col(c) for c in df.columns])


def new_rows(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return df.join(existing.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def replace_by_key(df: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All rows of the new keys go, the new rows come."""
    return df.join(new.select(key).distinct(), key, "left_anti").select(*df.columns).unionByName(new.select(*df.columns))


def merge_records(old: DataFrame, new: DataFrame, key: str, always: Sequence[str] = (), accept: Column | None = None) -> DataFrame:
    """Upsert by key: non-blank new values win, the columns ``always`` are replaced whenever there is a new record. A known
    key's record is left as it is where ``accept``, a condition on the new one, doesn't hold; an unknown key's record always comes."""
    o = old.select(*[F.col(c).alias(f"_o_{c}") for c in old.columns], F.lit(True).alias("_old"))
    taken = F.lit(True) if accept is None else F.coalesce(accept, F.lit(False))
    n = new.select(*[F.col(c).alias(f"_n_{c}") for c in old.columns], taken.alias("_new"))
    both = o.join(n, F.col(f"_o_{key}") == F.col(f"_n_{key}"), "full")
    blank = lambda c: F.trim(c.cast("string")) == ""

    def value(c: str) -> Column:
        mine, theirs = F.col(f"_o_{c}"), F.col(f"_n_{c}")
        merged = theirs if c in always else F.coalesce(F.when(~blank(theirs), theirs), mine)
        return F.when(F.col("_old").isNull() | F.col("_new"), merged).otherwise(mine)

    return both.select(*[value(c).alias(c) for c in old.columns])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the order given."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """value, n and percent (3 digits); null is a value."""
    counts = df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("value", "n", F.round(F.col("n") * 100.0 / F.col("total"), 3).alias("percent"))


def for_all(need: DataFrame, have: DataFrame, group: str, keys: Sequence[str], valid: Column, present: Column, latest: Sequence[str] = ()) -> DataFrame:
    """Relational division: for each non-null ``group`` of ``need`` how many of its distinct valid keys there are, how many of
    these ``have`` holds, and whether it holds them all. Keys are (group, keys); a key with a null part, or where ``valid`` doesn't
    hold, is none, and a group without a key is incomplete. Of several rows of ``have`` with one key the last by ``latest`` says
    whether it is ``present``.

    No join: both sides are stacked, folded by key with map-side combine, and then by group."""
    on = [group, *keys]
    whole = F.lit(True)
    for k in on:
        whole = whole & F.col(k).isNotNull()
    order = F.struct(*[F.col(c) for c in latest]) if latest else F.lit(1)
    asked = need.where(F.col(group).isNotNull()).select(*on, F.coalesce(whole & valid, F.lit(False)).alias("_asked"))
    asked = asked.select(group, *[F.when(F.col("_asked"), F.col(k)).alias(k) for k in keys], "_asked", F.lit(None).cast("boolean").alias("_there"), F.lit(None).cast(have.select(order.alias("o")).schema["o"].dataType).alias("_order"))
    held = have.where(whole).select(*on, F.lit(None).cast("boolean").alias("_asked"), F.coalesce(present, F.lit(False)).alias("_there"), order.alias("_order"))
    by_key = asked.unionByName(held).groupBy(*on).agg(F.max("_asked").alias("_asked"), F.max_by("_there", F.when(F.col("_there").isNotNull(), F.col("_order"))).alias("_there"))
    by_group = by_key.where("_asked is not null").groupBy(group).agg(F.count_if("_asked").alias("n_needed"), F.count_if(F.col("_asked") & F.col("_there")).alias("n_present"))
    return by_group.withColumn("complete", (F.col("n_needed") > 0) & (F.col("n_needed") == F.col("n_present")))


def pairs_in_group(df: DataFrame, group: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Each two rows of a group once, as structs a and b of (order, columns), a before b. The group's rows are one sorted array,
    each element of which meets those after it; nothing is joined. For groups that a task can hold, such as a race's field."""
    rows = df.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(order, *columns))).alias("_rows"))
    first = rows.select(*group, "_rows", F.posexplode("_rows").alias("_at", "a"))
    after = F.slice("_rows", F.col("_at") + 2, F.size("_rows"))
    return first.select(*group, "a", F.explode(after).alias("b"))


def _segments(*columns: np.ndarray) -> np.ndarray:
    """A number for each stretch of rows that are equal in all of the columns."""
    if not len(columns[0]):
        return np.empty(0, dtype=np.int64)
    new = np.zeros(len(columns[0]), dtype=bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def balance_in_order(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each of the groups 0, 1, ... (ascending rows) the pairs of rows of which the earlier has the lesser value, less those
    of which it has the greater one. Two values part at one bit of their ranks, so the rows that agree above a bit are counted
    at each bit: rows times bits, whatever the number of pairs."""
    n_groups = int(group[-1]) + 1 if len(group) else 0
    out = np.zeros(n_groups, dtype=np.int64)
    rank = np.unique(values, return_inverse=True)[1].astype(np.int64)
    for bit in range(int(rank.max(initial=0)).bit_length() - 1, -1, -1):
        order = np.lexsort((rank >> (bit + 1), group))  # stable: rows that agree above the bit, in their order
        segment, upper = _segments(group[order], rank[order] >> (bit + 1)), (rank[order] >> bit) & 1
        start = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])[segment]
        ones, zeros = np.r_[0, np.cumsum(upper)], np.r_[0, np.cumsum(1 - upper)]
        at = np.arange(len(order))
        earlier = np.where(upper == 1, zeros[at] - zeros[start], ones[start] - ones[at])
        np.add.at(out, group[order], earlier)
    return out


def balance_of_pairs(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """(group, n_pairs, balance): of each group's pairs of rows how many there are, and those of which the row that comes first by
    ``order`` has the lesser ``value`` less those of which it has the greater one; what ``pairs_in_group`` would give when its
    pairs are counted, without making them. Groups of one row have no pair and are left out, as are rows without a value; a
    null group is none. ``order`` must be distinct within a group.

    Rows are dealt in blocks by (group, order), so a group of any share of the rows is many tasks. A block counts its own pairs in
    numpy. Two blocks part at one bit of their numbers: at each bit the counts by value of the lower blocks stand against those
    of the upper ones, in running totals by value. So rows are met as often as block numbers have bits."""
    from tidemark.operators import windows as W
    from tidemark.operators.scans import BLOCK, PLACE, in_blocks

    rows = in_blocks(df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(group, order, value), [group], [order], "pairs", kept=(group, value))
    kind = dict(rows.dtypes)[group]

    def own(block: pa.Table) -> pa.Table:
        block = block.sort_by("place").combine_chunks()
        codes = block.column("of").combine_chunks()
        found = _segments(codes.dictionary_encode().indices.to_numpy())
        first = pa.array(np.flatnonzero(np.r_[True, found[1:] != found[:-1]]))
        return pa.table({"of": codes.take(first), "balance": balance_in_order(found, block.column("value").to_numpy())})

    within = rows.select(BLOCK, F.col(group).alias("of"), F.col(value).alias("value"), F.col(PLACE).alias("place")).groupBy(BLOCK).applyInArrow(own, f"of {kind}, balance long")

    counts = rows.groupBy(group, BLOCK, value).agg(F.count("*").alias("n"))
    spans = counts.groupBy(F.col(group).alias("_g")).agg(F.min(BLOCK).alias("_low"), F.max(BLOCK).alias("_high"), F.sum("n").alias("_rows"))
    parted = counts.join(spans.where("_low < _high"), F.col(group) == F.col("_g"))
    bits = F.sequence(F.lit(0), F.length(F.conv(F.col("_high").cast("string"), 10, 2)) - 1)
    parted = parted.select(group, value, BLOCK, "n", F.explode(bits).alias("_bit"))
    upper = F.getbit(F.col(BLOCK), F.col("_bit")) == 1
    node = F.expr(f"shiftright({BLOCK}, _bit + 1)").alias("_node")
    sides = parted.groupBy(group, "_bit", node, value).agg(F.sum(F.when(upper, 0).otherwise(F.col("n"))).alias("_first"), F.sum(F.when(upper, F.col("n")).otherwise(0)).alias("_then"))
    less = W._spec([group, "_bit", "_node"], [value]).rowsBetween(W.UP, -1)
    before = lambda c: F.coalesce(F.sum(c).over(less), F.lit(0))
    across = sides.select(F.col(group).alias("of"), (F.col("_then") * before("_first") - F.col("_first") * before("_then")).alias("balance"))

    found = within.unionByName(across).groupBy("of").agg(F.sum("balance").alias("balance"))
    return spans.where("_rows > 1").join(found, F.col("_g") == F.col("of")).select(F.col("_g").alias(group), F.expr("_rows * (_rows - 1) div 2").alias("n_pairs"), "balance")
