"""Segmented scans: running totals, row numbers and last known values where one key may hold any share of the rows.

A window gives a key to one task. Here the rows are range-partitioned by (keys, order) and sorted, which cuts a long key into
blocks that follow each other; each block is scanned by itself, blocks' totals are scanned over the key, and what a block's
first key has carried into it is joined back. Only the first key of a block can have begun in an earlier one, so there are
at most as many such rows as blocks, whatever the table's size: that side may be broadcast.

``order`` should end in a column that makes a key's rows distinct; rows that tie stand in the order in which the sort left
them, the same in every column of one scan. Nulls come last in the order, and a null key is a key. The blocks are written to
the shared folder once, since a place in a sorted partition must not be computed twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import windows as W
from tidemark.sources.scratch import settled

BLOCK, PLACE = "_block", "_place"


def in_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "blocks", blocks: int | None = None,
    ties: Sequence[str] = (), kept: Sequence[Column | str] = ("*",), store: Callable[[DataFrame, str], DataFrame] = settled,
) -> DataFrame:
    """``df`` with its block and a number that grows with the order of (keys, order, ties) over the whole table. ``ties`` order
    rows within a partition only: long values that needn't be sampled for ranges. ``kept``: the columns to go on with."""
    by = [F.col(c).asc_nulls_last() for c in (*keys, *order)]
    blocks = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.repartitionByRange(blocks, *by).sortWithinPartitions(*by, *[F.col(c).asc_nulls_last() for c in ties])
    place = F.monotonically_increasing_id()  # the partition's number in the high bits
    return store(df.select(*kept, F.shiftright(place, 33).cast("int").alias(BLOCK), place.alias(PLACE)), name)


#: How totals of two stretches of rows make that of both.
_JOINED = {"sum": lambda a, b: a + b, "bit_xor": lambda a, b: a.bitwiseXOR(b)}


def scan(
    df: DataFrame, keys: Sequence[str], sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None,
    xors: dict[str, Column] | None = None, own: bool = False, send: bool = True,
) -> DataFrame:
    """Adds to a table of ``in_blocks`` what came before each row of its keys: the sum of each of ``sums`` or the exclusive or
    of each of ``xors`` (null where nothing did), and the last non-null value of each of ``lasts``; with ``own``, up to and with
    the row. A table with blocks of another make, which may begin within a key anywhere, takes ``send=False``: then what is
    carried into blocks is joined as its size demands."""
    totalled = {n: ("sum", c) for n, c in (sums or {}).items()} | {n: ("bit_xor", c) for n, c in (xors or {}).items()}
    lasts = lasts or {}
    within = W._spec([BLOCK, *keys], [PLACE]).rowsBetween(W.UP, 0 if own else -1)
    columns = df.columns
    df = df.withColumns({f"_v_{n}": c for n, c in [*((n, c) for n, (_, c) in totalled.items()), *lasts.items()]})
    total = lambda n: getattr(F, totalled[n][0])
    local = [total(n)(f"_v_{n}").over(within).alias(f"_l_{n}") for n in totalled] + [F.last(f"_v_{n}", ignorenulls=True).over(within).alias(f"_l_{n}") for n in lasts]

    totals = df.groupBy(BLOCK, *keys).agg(*[total(n)(f"_v_{n}").alias(f"_t_{n}") for n in totalled], *[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(PLACE))).alias(f"_t_{n}") for n in lasts], F.lit(1).alias("_one"))
    earlier = W._spec(keys, [BLOCK]).rowsBetween(W.UP, -1)
    carried = [total(n)(f"_t_{n}").over(earlier).alias(f"_c_{n}") for n in totalled] + [F.last(f"_t_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in lasts]
    before = totals.select(F.col(BLOCK).alias("_b"), *[F.col(k).alias(f"_k_{k}") for k in keys], F.count("_one").over(earlier).alias("_n"), *carried).where("_n > 0").drop("_n")

    same = F.col(BLOCK) == F.col("_b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = df.select("*", *local).join(F.broadcast(before) if send else before, same, "left")  # sent: at most a row a block

    def both(n: str) -> Column:
        here, carried = F.col(f"_l_{n}"), F.col(f"_c_{n}")
        return F.when(here.isNotNull() & carried.isNotNull(), _JOINED[totalled[n][0]](carried, here)).otherwise(F.coalesce(here, carried))

    return joined.select(*columns, *[both(n).alias(n) for n in totalled], *[F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in lasts])


def numbered(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """The place of each row in its key, from 1."""
    return scan(df, keys, sums={name: F.lit(1).cast("long")}, own=True)


def asof_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], event: Column, payload: dict[str, Column]) -> DataFrame:
    """As ``windows.asof_before``, for keys of any share of the rows: each row gets the payload of the last earlier row of
    its keys at which ``event`` holds. Null keys match nothing."""
    known = event
    for k in keys:
        known = known & F.col(k).isNotNull()
    columns = df.columns
    packed = F.when(known, F.struct(*[c.alias(n) for n, c in payload.items()]))
    out = scan(in_blocks(df, keys, order, "asof"), keys, lasts={"_asof": packed})
    return out.select(*columns, *[F.col(f"_asof.{n}").alias(n) for n in payload])


def in_order(df: DataFrame, order: Sequence[str], name: str = "ordinal", blocks: int | None = None) -> DataFrame:
    """A dense number from 0 in the order given, over the whole table, without a window over it: range partitions, their
    counts, the counts' running total (a row a block), and the place in the partition. Written files keep the order."""
    rows = in_blocks(df, [], order, "ordered", blocks)
    first = rows.groupBy(BLOCK).agg(F.count("*").alias("_of_n"), F.min(PLACE).alias("_of_first"))
    start = first.select(F.col(BLOCK).alias("_of_block"), "_of_first", (F.sum("_of_n").over(W._spec([], [BLOCK])) - F.col("_of_n")).alias("_of_start"))
    numbered_rows = rows.join(F.broadcast(start), F.col(BLOCK) == F.col("_of_block"))  # a row a block
    return numbered_rows.select(*df.columns, (F.col("_of_start") + F.col(PLACE) - F.col("_of_first")).alias(name))
