"""Hard negatives by inner product, with a pivot table that brackets scores before they are computed.

Vectors get one more component that makes all of a length equally long, anchors a zero there; then the distance d between an
anchor q and a row x is |q|² + M² - 2 (q, x), M² being the square of that length, and falls as the score rises. A pivot table
keeps each row's distances to PIVOTS rows of its length. By the triangle inequality |d(q, p) - d(x, p)| <= d(q, x) <=
d(q, p) + d(x, p) for each pivot p, so the table brackets every score. Rows are sorted by label, nearest pivot and distance to
it and packed into tiles, which know the range of distances to each pivot; anchors are packed into blocks in the same way. A
block meets a tile only if their ranges allow a score that some anchor still wants; in a tile, anchors and then rows whose
bracket lies outside of what is wanted are left out, and the survivors' scores are computed exactly. What is wanted rises as
lists fill: an anchor has one list for its positives, and one for each positive's negatives.

The rows that pivots are: of each length, those with the smallest hash in each of PIVOTS buckets of all its rows. A bracket is
widened by more than rounding can make, so it refuses no row wrongly, and the result doesn't depend on the pivots.

Tiles are dealt into groups, each anchor block is sent to each group, and a group's lists are merged by a window over
(anchor, list). A task holds a block, its lists and a tile, both of bounded bytes, and Spark buffers a group's tiles, on disk
if need be. A label or cell that holds a third of all rows is many tiles in many groups.

Components become floor(SCALE * x), x as double; scores are exact, in doubles below 2**53, else in 64-bit or Python's integers;
a pair whose score times 100 doesn't fit a long takes no part. Ties go to the smaller vec_id. Rows without vec_id, label or vector
or with a null or non-finite component take no part. Vectors meet those of their own length only; empty ones score 0. Rows
with an anchor's vec_id are neither its positives nor negatives; a repeated anchor id is one anchor, with its smallest (label,
length, vector); other repeated rows count as often as they occur. A negative positive score has no negatives; 0 has those of score 0.
Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, temporary
from tidemark.llm.top_k import products

SCALE, PIVOTS = 256, 8
#: Bytes of a tile or block, and rows of one at most; anchors of a block looked at together.
PACK_BYTES, TILE_ROWS, BLOCK_ROWS, CHUNK = 2 << 20, 2048, 512, 128
#: Tiles of a group at most.
GROUP_TILES = 64

ROW = "dim int, m2 double, label long, cell int, near double, vec_id long, items binary, dists binary"
PACK = "dim int, m2 double, label long, n int, ids binary, items binary, dists binary, lo array<double>, hi array<double>, q2 double, need double, bands binary"
LONG = np.iinfo(np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim and embedding as doubles of the rows that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.size(v).alias("dim"), v.cast("array<double>").alias("embedding")
    )


def pivots_of(rows: DataFrame) -> DataFrame:
    """A row a length: its pivots, and a bound of its vectors' squared lengths."""
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + (F.abs(x) * SCALE + 1) * (F.abs(x) * SCALE + 1))
    slot = F.pmod(F.xxhash64("vec_id"), F.lit(PIVOTS))
    first = F.min(F.struct(F.xxhash64(F.lit(1), "vec_id").alias("h"), "vec_id", "embedding"))["embedding"]
    slots = rows.groupBy("dim", slot.alias("slot")).agg(first.alias("pivot"), F.max(square).alias("m2"))
    return slots.groupBy(F.col("dim").alias("p_dim")).agg(F.collect_list("pivot").alias("pivots"), F.max("m2").alias("m2"))


def _matrix(rows: list, dim: int) -> np.ndarray:
    return np.array(rows, np.float64).reshape(len(rows), dim)


def with_distances(rows: DataFrame, pivots: DataFrame, anchors: bool = False) -> DataFrame:
    """The rows with integral components, their distances to the pivots and the nearest one; as anchors, with a zero for the
    component that is added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {c: batch.column(c) for c in batch.schema.names}
            dims = cols["dim"].to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                m2, pivots = cols["m2"][int(at[0])].as_py(), np.floor(SCALE * _matrix(cols["pivots"][int(at[0])].as_py(), dim))
                x = np.floor(SCALE * _matrix(cols["embedding"].take(pa.array(at)).to_pylist(), dim))
                with np.errstate(all="ignore"):
                    square = np.einsum("ij,ij->i", x, x)
                    rest = np.sqrt(np.maximum(m2 - square, 0.0)) * (not anchors)
                    other = np.sqrt(np.maximum(m2 - np.einsum("ij,ij->i", pivots, pivots), 0.0))
                    dists = np.sqrt(np.maximum((square + rest**2 + m2)[:, None] - 2 * (x @ pivots.T + rest[:, None] * other), 0.0))
                cell = np.argmin(dists, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), dim), pa.int32()), pa.array(np.full(len(at), m2), pa.float64()), cols["label"].take(pa.array(at)), pa.array(cell, pa.int32()),
                        pa.array(dists[np.arange(len(at)), cell], pa.float64()), cols["vec_id"].take(pa.array(at)), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in dists], pa.binary()),
                    ],
                    names=["dim", "m2", "label", "cell", "near", "vec_id", "items", "dists"],
                )

    joined = rows.join(pivots, F.col("dim") == F.col("p_dim"))
    return joined.select("vec_id", "label", "dim", "embedding", "pivots", "m2").mapInArrow(run, ROW)


def packed(rows: DataFrame, most: int, parts: int) -> DataFrame:
    """Tiles or blocks of up to ``most`` rows of one length and label that lie close together. A block's rows have ``bands``:
    pairs of longs, the least and greatest score wanted of each of its lists."""
    order = ["dim", "label", "cell", "near", "vec_id"]
    has_bands = "bands" in rows.columns
    rows = rows if has_bands else rows.withColumn("bands", F.lit(b""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def sent() -> pa.RecordBatch:
            n, dim, m2, label = len(held), held[0]["dim"], held[0]["m2"], held[0]["label"]
            joined = {c: b"".join(r[c] for r in held) for c in ("items", "dists", "bands")}
            x, d = np.frombuffer(joined["items"]).reshape(n, dim), np.frombuffer(joined["dists"]).reshape(n, -1)
            bands = np.frombuffer(joined["bands"], "<i8").reshape(n, -1, 2)
            wanted = bands[..., 0][bands[..., 0] <= bands[..., 1]]
            with np.errstate(all="ignore"):
                q2 = float(np.einsum("ij,ij->i", x, x).max())
            row = {"dim": dim, "m2": m2, "label": label, "n": n, "ids": np.array([r["vec_id"] for r in held], "<i8").tobytes(), **joined, "lo": d.min(axis=0).tolist(), "hi": d.max(axis=0).tolist(), "q2": q2, "need": float(wanted.min()) if len(wanted) else float("inf")}
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=_PACK_SCHEMA)

        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) >= min(most, max(1, PACK_BYTES // (8 * max(1, row["dim"])))) or (row["dim"], row["label"]) != (held[0]["dim"], held[0]["label"])):
                    yield sent()
                held.append(row)
        if held:
            yield sent()

    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return dealt.select("dim", "m2", "label", "vec_id", "items", "dists", "bands").mapInArrow(run, PACK)


_PACK_SCHEMA = pa.schema([
    ("dim", pa.int32()), ("m2", pa.float64()), ("label", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("items", pa.binary()), ("dists", pa.binary()),
    ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("q2", pa.float64()), ("need", pa.float64()), ("bands", pa.binary()),
])


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray | bool]:
    """Inner products as longs, and where they times 100 fit a long."""
    scores = products(a, b)
    if scores.dtype == object:
        fits = np.array([[abs(s) <= LONG.max // 100 for s in row] for row in scores], bool).reshape(scores.shape)
        return np.where(fits, scores, 0).astype(np.int64), fits
    return scores.astype(np.int64), np.abs(scores) <= LONG.max // 100


class Lists:
    """The best of each list of a block's anchors so far: scores down, ids up."""

    def __init__(self, bands: np.ndarray, k: int) -> None:
        self.k, self.bands, self.floor = k, bands, bands[..., 0].copy()
        self.floor[bands[..., 0] > bands[..., 1]] = LONG.max
        self.owner, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        owner, score, ids = (np.concatenate(x) for x in ((self.owner, owner), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, owner))
        owner, score, ids = owner[order], score[order], ids[order]
        first = np.r_[True, owner[1:] != owner[:-1]][: len(owner)]
        rank = np.arange(len(owner)) - np.maximum.accumulate(np.where(first, np.arange(len(owner)), 0))
        full = rank == self.k - 1
        flat = self.floor.reshape(-1)
        flat[owner[full]] = np.maximum(flat[owner[full]], score[full])
        keep = rank < self.k
        self.owner, self.score, self.id = owner[keep], score[keep], ids[keep]


def meet(block: dict, tile: dict, lists: Lists) -> None:
    """Put into the lists what a tile has for a block."""
    m2, dists, q2, cap = tile["m2"], block["dists"], block["q2"], lists.bands[..., 1].max(axis=1).astype(np.float64)
    slack = 1e-6 * (np.sqrt(m2) + np.sqrt(q2)) + 1e-6  # of a distance; far more than rounding makes

    def most(gap: np.ndarray, at: np.ndarray) -> np.ndarray:
        shape = (len(at),) + (1,) * (gap.ndim - 1)
        return (q2[at].reshape(shape) + m2 - np.maximum(gap - slack[at].reshape(shape), 0.0) ** 2) / 2 + 1

    with np.errstate(all="ignore"):
        gap = np.maximum(tile["lo"] - dists, dists - tile["hi"]).max(axis=1)
        active = np.flatnonzero(~(most(gap, np.arange(len(q2))) < lists.floor.min(axis=1)))
        for begin in range(0, len(active), CHUNK):
            at = active[begin : begin + CHUNK]
            near, far = np.zeros((len(at), len(tile["ids"]))), np.full((len(at), len(tile["ids"])), np.inf)
            for own, theirs in zip(dists[at].T, tile["dists"].T, strict=True):
                np.maximum(near, np.abs(own[:, None] - theirs), out=near)
                np.minimum(far, own[:, None] + theirs, out=far)
            least = (q2[at][:, None] + m2 - (far + slack[at][:, None]) ** 2) / 2 - 1
            maybe = ~(most(near, at) < lists.floor[at].min(axis=1)[:, None]) & ~(least > cap[at][:, None])
            rows = np.flatnonzero(maybe.any(axis=0))
            if not len(rows):
                continue
            scores, fits = exact(block["items"][at], tile["items"][rows])
            maybe = maybe[:, rows] & fits & (tile["ids"][rows] != block["ids"][at][:, None])
            found: list[tuple[np.ndarray, ...]] = []
            for band in range(lists.bands.shape[1]):
                hit = maybe & (scores >= lists.floor[at, band][:, None]) & (scores <= lists.bands[at, band, 1][:, None])
                if hit.sum(axis=1).max() > lists.k:
                    held = np.where(hit, scores, LONG.min)
                    hit &= held >= np.partition(held, len(rows) - lists.k, axis=1)[:, len(rows) - lists.k][:, None]
                i, j = np.nonzero(hit)
                if len(i):
                    found.append((at[i] * lists.bands.shape[1] + band, scores[i, j], tile["ids"][rows[j]]))
            if found:
                lists.add(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _read(row: dict, prefix: str = "") -> dict:
    n, dim = row[f"{prefix}n"], row["dim"]
    out = {"m2": row["m2"], "ids": np.frombuffer(row[f"{prefix}ids"], "<i8"), "items": np.frombuffer(row[f"{prefix}items"]).reshape(n, dim), "dists": np.frombuffer(row[f"{prefix}dists"]).reshape(n, -1)}
    if prefix:
        with np.errstate(all="ignore"):
            return out | {"q2": np.einsum("ij,ij->i", out["items"], out["items"]), "bands": np.frombuffer(row["q_bands"], "<i8").reshape(n, -1, 2)}
    return out | {"lo": np.array(row["lo"]), "hi": np.array(row["hi"])}


def searched(blocks: DataFrame, tiles: DataFrame, k: int, same_label: bool, groups: int) -> DataFrame:
    """anchor_id, band, rank, vec_id, score: each list's first k rows of the anchors' own label, or of the others."""
    tiles = tiles.select("dim", "m2", "label", "n", "ids", "items", "dists", "lo", "hi", F.pmod(F.xxhash64("ids", "label", "lo"), F.lit(groups)).alias("group"))
    own = blocks.select("dim", F.col("label").alias("q_label"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")).alias("group"), F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("items").alias("q_items"),
                        F.col("dists").alias("q_dists"), F.col("lo").alias("q_lo"), F.col("hi").alias("q_hi"), F.col("q2"), F.col("need"), F.col("bands").alias("q_bands"))
    # what lies between the ranges of distances to a pivot lies between any anchor and any row
    between = F.zip_with(F.zip_with("lo", "q_hi", lambda x, y: x - y), F.zip_with("q_lo", "hi", lambda x, y: x - y), lambda x, y: F.greatest(x, y))
    gap = F.greatest(F.array_max(between) - 1e-6 * (F.sqrt("m2") + F.sqrt("q2")) - 1e-6, F.lit(0.0))
    within = ~((F.col("q2") + F.col("m2") - gap * gap) / 2 + 1 < F.col("need"))
    label = F.col("label") == F.col("q_label") if same_label else F.col("label") != F.col("q_label")
    # merge: an anchor block goes by all tiles of its group, so its lists are written once
    pairs = own.hint("merge").join(tiles, ["dim", "group"]).where(label & within)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, lists = None, None, None

        def done() -> pa.RecordBatch:
            anchor, band = np.divmod(lists.owner, lists.bands.shape[1])
            return pa.RecordBatch.from_arrays([pa.array(block["ids"][anchor], pa.int64()), pa.array(band, pa.int32()), pa.array(lists.id, pa.int64()), pa.array(lists.score, pa.int64())], names=["anchor_id", "band", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(k)[i] for k, c in enumerate(batch.schema.names)}
                row = {c: x.as_buffer() if pa.types.is_binary(x.type) else x.as_py() for c, x in row.items()}
                ids = bytes(row["q_ids"])
                if (row["dim"], ids) != at:
                    if at is not None:
                        yield done()
                    at, block = (row["dim"], ids), _read(row, "q_")
                    lists = Lists(block["bands"], k)
                meet(block, _read(row), lists)
        if at is not None:
            yield done()

    found = pairs.select("dim", "m2", "n", "ids", "items", "dists", "lo", "hi", "q_n", "q_ids", "q_items", "q_dists", "q_bands").mapInArrow(run, "anchor_id long, band int, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "band").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("anchor_id", "band", "rank", "vec_id", "score")


def mine(vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:  # noqa: ANN001
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``is_anchor``: a condition on vec_id. ``least``
    and ``most``: percents of the positive's score between which a negative's lies."""
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with temporary(spark) as keep:
        vectors = usable(vectors)
        pivots = stored(pivots_of(vectors), "pivots")
        rows = stored(with_distances(vectors, pivots), "pivot_table")
        tiles = stored(packed(rows, TILE_ROWS, parts), "tiles")
        size = tiles.agg(F.count("*").alias("tiles"), F.sum("n").alias("rows")).first()
        # by rows, so that many small tiles don't make many groups, each with lists of its own
        groups = max(1, min(parts, (size["rows"] or 0) // (4 * TILE_ROWS)), size["tiles"] // GROUP_TILES)

        first = F.min(F.struct("label", "dim", "embedding"))
        anchors = vectors.where(is_anchor).groupBy("vec_id").agg(first.alias("row")).select("vec_id", "row.label", "row.dim", "row.embedding")
        anchors = stored(with_distances(anchors, pivots, anchors=True), "anchors")
        every = np.array([[LONG.min, LONG.max]], "<i8").tobytes()
        blocks = stored(packed(anchors.withColumn("bands", F.lit(every)), BLOCK_ROWS, max(1, groups // 4)), "blocks")
        best = stored(searched(blocks, tiles, positives, True, groups), "positives")

        scores = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("rank", "score")).alias("found"))
        blocks = stored(packed(_with_bands(anchors.join(scores, "vec_id"), positives, least, most), BLOCK_ROWS, max(1, groups // 4)), "blocks_of_bands")
        hard = searched(blocks, tiles, negatives, False, groups)
        pos = best.select("anchor_id", (F.col("rank") - 1).alias("band"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        out = hard.join(pos, ["anchor_id", "band"])
        return keep(stored(out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives"))


def _with_bands(anchors: DataFrame, lists: int, least: int, most: int) -> DataFrame:
    """``bands``: for each positive the whole scores from ``least`` to ``most`` percent of its own; none where it has none."""
    columns = [c for c in anchors.columns if c != "found"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.select(*columns).schema) + ", bands binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = []
            for found in batch.column("found").to_pylist():
                own = np.tile(np.array([1, 0], "<i8"), (lists, 1))
                for x in found:
                    own[x["rank"] - 1] = -((-least * x["score"]) // 100), (most * x["score"]) // 100
                bands.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(bands, pa.binary())], names=[*columns, "bands"])

    return anchors.mapInArrow(run, schema)
