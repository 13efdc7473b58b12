"""Exact top-k search by inner product: tiled matrix products, partial selection per tile, tree merging of top lists.

Vectors are packed into matrices: queries into blocks of QUERY_ROWS, candidates into tiles of TILE_ROWS, of PACK_BYTES at
most. Tiles and blocks are dealt into a grid: a cell gets the tiles of one group, which a task holds (GROUP_BYTES on
average), and then the blocks of one group, which stream by. Each block meets all tiles of its cell and gives one list for
each query there: scores of CHUNK queries are made at a time, and only those that a list still wants go on into it. Lists
are merged across cells by a window per query, at most k rows a cell. The grid follows from the bytes of both sides, so what
is sent stays in proportion to the tiles; nothing is broadcast, and the driver gets two rows of totals.

Components become floor(1024 * x), x as double, kept in 16 bits where they fit. Products are made in single floats where no
sum can reach 2**24 (the product of the lengths of the longest vectors bounds every partial sum), in doubles where all sums
stay below 2**53, in 64-bit integers where they stay below 2**63, and else in Python's integers (a score that doesn't fit a
long is null, and ranks by its sign). Ties go to the smaller vec_id. Vectors that are null, empty or hold a null or
non-finite component take no part; nor do rows without vec_id. A query meets candidates of its own length only. A candidate is any other row: rows with the
query's own vec_id are not candidates; a repeated vec_id counts as often as it occurs as a candidate, and as a query once,
with its smallest vector. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SCALE = 1024
#: Rows of a block and of a tile at most, bytes of either as doubles at most, and queries of a block looked at together.
QUERY_ROWS, TILE_ROWS, PACK_BYTES, CHUNK = 2048, 4096, 4 << 20, 128
#: Bytes of the tiles in a cell on average, and cells that are made, if there are partitions, however much is sent to them.
GROUP_BYTES, CELLS = 64 << 20, 64
#: Scores a query that wait for a sort; scores of a first tile that give a list its first bound.
WAITING, FIRST = 4, 1024

PACKED = "dim int, n int, part int, number int, least long, longest double, width int, ids binary, items binary"
LISTS = "query_id long, vec_id long, score long, over double"
LONG = np.iinfo(np.int64)
#: A scored row of a list on its way to the merge, in bytes.
LISTED = 24


def usable(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & (F.size(v) > 0)).where(F.coalesce(finite, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"))


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Matrices of up to ``rows`` vectors of one length, ids ascending: integral components in ``width`` bytes (16-bit integers,
    or doubles), the smallest id, the length of the longest vector; the ``number`` of the matrix in its partition."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        part, number = TaskContext.get().partitionId(), 0

        def sent(ids: np.ndarray, items: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            order = np.argsort(ids, kind="stable")
            ids, items = ids[order], items[order]
            with np.errstate(all="ignore"):
                longest = math.sqrt(np.einsum("ij,ij->i", items, items).max())
            kind = "<i2" if np.abs(items).max() < 2**15 else "<f8"
            row = {"dim": items.shape[1], "n": len(ids), "part": part, "number": number, "least": int(ids[0]), "longest": longest, "width": int(kind[2]), "ids": ids.astype("<i8").tobytes(), "items": items.astype(kind).tobytes()}
            number += 1
            return pa.RecordBatch.from_pylist([row], schema=_PACK_SCHEMA)

        for batch in batches:
            ids, vectors = batch.column("vec_id").to_numpy(), batch.column("embedding")
            dims = pc.list_value_length(vectors).to_numpy()
            starts, items = np.cumsum(dims) - dims, np.floor(SCALE * vectors.flatten().to_numpy())
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                own = held.setdefault(dim, ([], []))
                own[0].append(ids[at])
                own[1].append(items.reshape(-1, dim) if len(at) == len(dims) else items[starts[at][:, None] + np.arange(dim)])
                full = min(rows, max(1, PACK_BYTES // (8 * dim)))
                if sum(map(len, own[0])) >= full:
                    i, x = np.concatenate(own[0]), np.concatenate(own[1])
                    end = len(i) - len(i) % full
                    for begin in range(0, end, full):
                        yield sent(i[begin : begin + full], x[begin : begin + full])
                    held[dim] = ([i[end:]], [x[end:].copy()])
        for i, x in held.values():
            if sum(map(len, i)):
                yield sent(np.concatenate(i), np.concatenate(x))

    return vectors.mapInArrow(pack, PACKED)


_PACK_SCHEMA = pa.schema([
    ("dim", pa.int32()), ("n", pa.int32()), ("part", pa.int32()), ("number", pa.int32()), ("least", pa.int64()), ("longest", pa.float64()), ("width", pa.int32()), ("ids", pa.binary()), ("items", pa.binary()),
])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integral rows, in the narrowest arithmetic that holds them."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return a @ b.T
    if most < 2.0**62 and max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object)
    return whole(a) @ whole(b).T


class Lists:
    """The k best of each query of a block so far: scores down, ids up. ``floor`` and ``last``: score and id of a full list's end.
    What is added waits until there is enough of it to be worth a sort; until then the ends are lower than they could be."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.floor, self.last = k, np.full(n, LONG.min), np.full(n, LONG.max)
        self.owner, self.id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, owner: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        self.waiting.append((owner, ids, score))
        if sum(len(x[0]) for x in self.waiting) >= WAITING * len(self.floor):
            self.settle()

    def settle(self) -> None:
        owner, ids, score = (np.concatenate(x) for x in zip((self.owner, self.id, self.score), *self.waiting, strict=True))
        self.waiting.clear()
        order = np.lexsort((ids, -score, owner))
        owner, ids, score = owner[order], ids[order], score[order]
        at = np.arange(len(owner))
        rank = at - np.maximum.accumulate(np.where(np.r_[True, owner[1:] != owner[:-1]][: len(owner)], at, 0))
        full, keep = rank == self.k - 1, rank < self.k
        self.floor[owner[full]] = np.clip(score[full], LONG.min, LONG.max).astype(np.int64)
        self.last[owner[full]] = ids[full]
        self.owner, self.id, self.score = owner[keep], ids[keep], score[keep]

    def rows(self, q_ids: np.ndarray) -> pa.RecordBatch:
        self.settle()
        score, over = pa.array(self.score) if self.score.dtype != object else None, pa.nulls(len(self.owner), pa.float64())
        if score is None:
            fits = [LONG.min <= s <= LONG.max for s in self.score]
            score = pa.array([int(s) if f else None for s, f in zip(self.score, fits, strict=True)], pa.int64())
            over = pa.array([None if f else float(s) for s, f in zip(self.score, fits, strict=True)], pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(q_ids[self.owner]), pa.array(self.id), score, over], names=["query_id", "vec_id", "score", "over"])


def marked(mask: np.ndarray) -> np.ndarray:
    """Flat places of the few that are True: eight are passed over at a time where their number allows."""
    flat = mask.reshape(-1)
    if len(flat) % 8:
        return np.flatnonzero(flat)
    some = np.flatnonzero(flat.view(np.uint64) != 0)
    i, j = np.nonzero(flat.reshape(-1, 8)[some])
    return some[i] * 8 + j


def meet(block: dict, tile: dict, lists: Lists) -> None:
    """Put into the lists what a tile has for a block."""
    ids, k, single = tile["ids"], lists.k, block["longest"] * tile["longest"] < 0.99 * 2**24
    kind = np.float32 if single else np.float64
    b = tile["items"].astype(kind)
    place = np.minimum(np.searchsorted(block["ids"], ids), len(block["ids"]) - 1)
    own = np.flatnonzero(block["ids"][place] == ids)
    row_of = place[own]
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, len(block["ids"]), CHUNK):
        a, floor = block["items"][begin : begin + CHUNK].astype(kind), lists.floor[begin : begin + CHUNK]
        scores = a @ b.T if single else products(a, b)
        here = (row_of >= begin) & (row_of < begin + CHUNK)
        if scores.dtype == object:
            mask = np.ones(scores.shape, bool)
        else:
            whole = scores.dtype == np.int64
            scores[row_of[here] - begin, own[here]] = LONG.min if whole else -np.inf
            bound = floor if whole else np.clip(floor, -(2**24 if single else 2**53), 2**24 if single else 2**53).astype(kind)
            new = np.flatnonzero(floor == LONG.min)
            if len(new) and len(ids) > k:
                bound = bound.copy()
                some = scores[new, : max(k, FIRST)]  # the k-th best of some is no better than that of all
                bound[new] = np.maximum(bound[new], np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k])
            mask = scores >= bound[:, None]
        mask[row_of[here] - begin, own[here]] = False
        flat = marked(mask)
        if len(flat):
            i, j = np.divmod(flat, len(ids))
            score = scores.reshape(-1)[flat]
            score = score if score.dtype == object else score.astype(np.int64)
            # the end of a full list is beaten by a higher score, or by as high a one with a smaller id
            wanted = slice(None) if score.dtype == object else (score > floor[i]) | (ids[j] <= lists.last[begin + i])
            found.append((begin + i[wanted], ids[j[wanted]], score[wanted]))
    if found:
        lists.add(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _read(row: dict) -> dict:
    return {"ids": np.frombuffer(row["ids"], "<i8"), "items": np.frombuffer(row["items"], "<i2" if row["width"] == 2 else "<f8").reshape(row["n"], row["dim"]), "longest": row["longest"]}


def grid(parts: int, tiles: int, tile_bytes: int, blocks: int, block_bytes: int) -> tuple[int, int]:
    """Groups of blocks and of tiles: as many cells as partitions, as long as what is sent stays about three times the tiles' bytes
    or there are no more than CELLS; as near to the shape that sends least as the tiles of a cell allow."""
    ratio = tile_bytes / max(1, block_bytes)
    cells = max(1, min(parts, max(CELLS, int(2 * ratio)), tiles * blocks))
    across = max(1, min(tiles, max(-(-tile_bytes // GROUP_BYTES), min(cells, round(math.sqrt(cells * ratio))))))
    down = max(1, min(blocks, cells // across))
    return down, max(1, min(tiles, max(across, cells // down)))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, groups: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every query; both inputs: (vec_id, embedding). ``groups``: of
    tiles, if not what follows from the sizes."""
    spark = queries.sparkSession
    tiles = stored(packed(usable(candidates), TILE_ROWS), "tiles")
    once = usable(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    blocks = stored(packed(once, QUERY_ROWS), "query_blocks")
    totals = [F.count("*").alias("packs"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") * F.col("dim") * F.col("width")), F.lit(0)).alias("bytes"), F.coalesce(F.max("part") + 1, F.lit(1)).alias("parts")]
    t, b = tiles.agg(*totals).first(), blocks.agg(*totals).first()
    down, across = (1, groups) if groups else grid(int(spark.conf.get("spark.sql.shuffle.partitions")), t["packs"], t["bytes"], b["packs"], b["bytes"] + LISTED * k * b["rows"])

    def dealt(packs: DataFrame, total, n: int) -> F.Column:  # noqa: ANN001
        """Packs counted through, so that each of n groups gets as many."""
        return F.pmod(F.floor(F.col("part") * F.lit(total["packs"] / total["parts"])) + F.col("number"), F.lit(n)).cast("int")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["dim", "n", "longest", "width", "ids", "items", "least"]
    sent_tiles = tiles.select(*columns, F.lit(False).alias("asks"), dealt(tiles, t, across).alias("tile_group"), every(down).alias("block_group"))
    sent_blocks = blocks.select(*columns, F.lit(True).alias("asks"), every(across).alias("tile_group"), dealt(blocks, b, down).alias("block_group"))
    cells = sent_tiles.unionByName(sent_blocks).withColumn("cell", (F.col("block_group") * across + F.col("tile_group")).cast("int")).drop("tile_group", "block_group")
    # in a cell: of each length the tiles, smallest ids first, then the blocks
    cells = cells.repartitionById(down * across, "cell").sortWithinPartitions("cell", "dim", "asks", "least")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(j)[i] for j, c in enumerate(batch.schema.names)}
                row = {c: x.as_buffer() if pa.types.is_binary(x.type) else x.as_py() for c, x in row.items()}
                if (row["cell"], row["dim"]) != at:
                    at, held = (row["cell"], row["dim"]), []
                if not row["asks"]:
                    held.append(_read(row))
                    continue
                block, own = _read(row), Lists(row["n"], k)
                for tile in held:
                    meet(block, tile, own)
                yield own.rows(block["ids"])

    found = cells.mapInArrow(lists, LISTS)
    over = F.coalesce("over", F.col("score").cast("double"))
    order = Window.partitionBy("query_id").orderBy(over.desc(), F.col("score").desc(), F.col("vec_id"))
    merged = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
