"""Removal of repeated byte strings by merged Burrows-Wheeler transforms.

A byte goes if a ``LENGTH``-byte string over it also starts earlier: in a smaller document, or earlier in the same one.
Suffixes of the whole corpus can't be sorted in one place, so they are dealt out by content such that equal windows of
LENGTH bytes meet:

1. Every window has a minimizer, the least hash of the GRAM-byte strings in it; consecutive windows of one minimizer make
   a segment. Equal windows have equal minimizers, so a minimizer that occurs in one text only has no repeats in others.
   Texts are scanned once for minimizers; those met in two texts are found by a shuffle of hashes. What a task itself
   sees in two texts is known at once and sends one row on, so a passage in a third of all documents is a row a task.
2. Documents of equal text keep their first; its copies are repeats from end to end, or too short.
3. The segments of repeated minimizers are cut out. A segment that a task has met before is a repeat from end to end. The
   others are dealt into buckets by minimizer. A minimizer with more than CROWD segments (a common line in many contexts)
   is dealt again by further, independently seeded minimizers of its windows, up to DEALS times.
4. In a bucket, equal segments keep their first. The rest are cut into shards, each shard's Burrows-Wheeler transform is
   made, and the transforms are merged (bwt_merge). Runs of common prefixes of LENGTH or more are the repeated windows;
   all of a run but its first in document order are removed.

Null text: the empty text. Rows without doc_id are left out. Rows that repeat doc_id and text have one result each, the
same; rows of one doc_id and different texts are taken in the order of their texts' hashes. Empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bwt_merge import merge
from tidemark.llm.common import id_text, sliced, stored, temporary, trim

LENGTH = 100
GRAM = 32
#: Segments of one minimizer beyond which its windows are dealt anew, how often, and the seeds that are added each time.
CROWD, DEALS, SEEDS = 2_000, 3, 4
#: Crowded minimizers up to which their list is broadcast.
BROADCAST_KEYS = 1_000_000
#: Bytes of segments in a bucket, on average, and in a shard.
BUCKET_BYTES, SHARD_BYTES = 600_000, 150_000
#: Minimizers that a task holds before it sends them on.
HELD = 3_000_000

U = np.uint64
MASK = (1 << 64) - 1
GOLDEN = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on, by doubling; needs len(text) >= GRAM."""
    h = mix((text.astype(np.uint64) + U(1)) * U(GOLDEN))
    width = 1
    while width < GRAM:
        h = mix(h[:-width] * U(GOLDEN) + (h[width:] ^ U(0x5851F42D4C957F2D * width & MASK)))
        width *= 2
    return h


def window_minima(h: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Least gram hash in the window of ``length`` bytes from each place on."""
    span, width = length - GRAM + 1, 1
    while 2 * width <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[: len(h) - (span - width)], h[span - width :]) if span > width else h


def keys_of(text: bytes, seeds: int = 0) -> np.ndarray:
    """A key for each window: its minimizer, together with those of ``seeds`` more orders of the grams."""
    h = gram_hashes(np.frombuffer(text, np.uint8))
    out = window_minima(h)
    for i in range(seeds):
        out = mix(out * U(GOLDEN) + window_minima(mix(h ^ U((i + 1) * 0xA0761D6478BD642F & MASK))))
    return out


def minimizers(h: np.ndarray, minima: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The hashes of all places that are the least of a window, equal ones as often as they occur."""
    span, width = length - GRAM + 1, 1
    most = np.concatenate([np.zeros(span - 1, np.uint64), minima, np.zeros(span - 1, np.uint64)])
    while 2 * width <= span:
        most = np.maximum(most[:-width], most[width:])
        width *= 2
    if span > width:
        most = np.maximum(most[: len(most) - (span - width)], most[span - width :])
    return h[most == h]


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of equal keys."""
    at = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], at]), np.concatenate([at, [len(keys)]])


def scan(docs: DataFrame) -> DataFrame:
    """kind 0: a document (doc_id, d1, d2, n_bytes, sha); kind 1: (key, d1) whose key may occur in other texts; kind 2: a
    (key, d1) of which the task knows that it does; kind 3: a key of kind 2, once."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys: list[np.ndarray] = []
        owners: list[tuple[int, int]] = []
        seen: set[tuple[int, int]] = set()
        held = 0

        def sent() -> Iterator[pd.DataFrame]:
            nonlocal held
            if keys:
                key = np.concatenate(keys)
                d1 = np.repeat(np.array([d for d, _ in owners], np.int64), [n for _, n in owners])
                order = np.argsort(key, kind="stable")
                key, d1 = key[order], d1[order]
                first = np.concatenate([[True], key[1:] != key[:-1]])
                known = ~(first & np.append(first[1:], True))
                kind = np.where(known, 2, 1)
                once = known & first
                yield from sliced(frame(kind, d1, key))
                yield from sliced(frame(np.full(once.sum(), 3), d1[once], key[once]))
            keys.clear()
            owners.clear()
            seen.clear()
            held = 0

        def frame(kind: np.ndarray, d1: np.ndarray, key: np.ndarray) -> pd.DataFrame:
            return pd.DataFrame({"kind": kind.astype(np.int8), "key": key.view(np.int64), "d1": d1, "doc_id": 0, "d2": 0, "n_bytes": 0, "sha": None})

        for pdf in batches:
            out = []
            for doc_id, d1, d2, text in zip(pdf["doc_id"].tolist(), pdf["d1"].tolist(), pdf["d2"].tolist(), pdf["text"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                out.append((0, 0, d1, doc_id, d2, len(raw), hashlib.sha256(raw).hexdigest()))
                if len(raw) < LENGTH or (d1, d2) in seen:
                    continue
                seen.add((d1, d2))
                h = gram_hashes(np.frombuffer(raw, np.uint8))
                own, times = np.unique(minimizers(h, window_minima(h)), return_counts=True)
                own = np.concatenate([own, own[times > 1]])  # twice in one text: known to repeat
                keys.append(own)
                owners.append((d1, len(own)))
                held += len(own)
            yield pd.DataFrame(out, columns=["kind", "key", "d1", "doc_id", "d2", "n_bytes", "sha"]).astype({"kind": np.int8})
            if held > HELD:
                yield from sent()
        yield from sent()

    return docs.mapInPandas(rows, "kind byte, key long, d1 long, doc_id long, d2 long, n_bytes long, sha string")


def repeated_keys(scanned: DataFrame) -> DataFrame:
    """(d1, keys): for each text, the minimizers in it that also occur elsewhere."""
    sent = scanned.where("kind in (1, 3)").select("key", F.when(F.col("kind") == 1, F.col("d1")).alias("d1"))
    found = sent.groupBy("key").agg(F.count("*").alias("n"), F.collect_list("d1").alias("d1")).where("n > 1").select("key", F.explode("d1").alias("d1"))
    known = scanned.where("kind = 2").select("key", "d1")
    return found.unionByName(known).groupBy("d1").agg(F.collect_set("key").alias("keys"))


def repeats_itself(piece: bytes, n_windows: int) -> bool:
    """Whether two windows of the segment may be equal. If so, the piece has a period over all that its windows share, so
    the gram that starts in the last window's first byte recurs; with many windows that gram may lie outside."""
    last = n_windows - 1
    return last > LENGTH - GRAM or (last > 0 and piece.find(piece[last : last + GRAM], last + 1) >= 0)


SEGMENT = "kind byte, key long, doc_id long, d1 long, start long, stop long, again boolean, bytes binary"


class Segments:
    """Segment rows of a task: those met before are repeats from end to end (kind 1), the others go on (kind 0)."""

    def __init__(self, limit: int = 400_000):
        self.limit, self.met, self.rows = limit, {}, []

    def cut(self, raw: bytes, base: int, doc_id: int, d1: int, keys: np.ndarray, wanted: np.ndarray | None) -> None:
        starts, stops = runs(keys)
        if wanted is not None:
            keep = np.isin(keys[starts], wanted)
            starts, stops = starts[keep], stops[keep]
        for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
            piece = raw[a : b + LENGTH - 1]
            key, mark = int(keys[a : a + 1].view(np.int64)[0]), hashlib.blake2b(piece, digest_size=16).digest()
            place = (doc_id, d1, base + a)
            row = [0, key, doc_id, d1, base + a, base + b, repeats_itself(piece, b - a), piece]
            other = self.met.get(mark)
            if other is None:
                self.met[mark] = (place, len(self.rows))
                self.rows.append(row)
                continue
            if place < other[0]:  # the new one is the first
                old = self.rows[other[1]]
                self.rows[other[1]] = row
                self.met[mark] = (place, other[1])
                row = old
            self.rows.append([1, 0, *row[2:6], False, None])

    def sent(self) -> pd.DataFrame:
        out = pd.DataFrame(self.rows, columns=["kind", "key", "doc_id", "d1", "start", "stop", "again", "bytes"])
        self.rows, self.met = [], {}
        return out.astype({"kind": np.int8, "again": bool})

    @property
    def full(self) -> bool:
        return len(self.rows) > self.limit


def first_segments(texts: DataFrame) -> DataFrame:
    """Segments of the repeated minimizers of (doc_id, d1, text, keys)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Segments()
        for pdf in batches:
            for doc_id, d1, text, wanted in zip(pdf["doc_id"].tolist(), pdf["d1"].tolist(), pdf["text"], pdf["keys"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                held.cut(raw, 0, doc_id, d1, keys_of(raw), np.asarray(wanted, np.int64).view(np.uint64))
                if held.full:
                    yield from sliced(held.sent())
        yield from sliced(held.sent())

    return texts.mapInPandas(rows, SEGMENT)


def finer_segments(segments: DataFrame, deal: int) -> DataFrame:
    """The segments cut again, where further minimizers of their windows change."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Segments()
        for pdf in batches:
            for doc_id, d1, start, raw in zip(pdf["doc_id"].tolist(), pdf["d1"].tolist(), pdf["start"].tolist(), pdf["bytes"], strict=True):
                held.cut(raw, start, doc_id, d1, keys_of(raw, SEEDS * deal), None)
                if held.full:
                    yield from sliced(held.sent())
        yield from sliced(held.sent())

    return segments.mapInPandas(rows, SEGMENT)


def settled(texts: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Segments that may hold repeats, in crowds of CROWD at most where dealing anew can get there; and known repeats."""
    rows = stored(first_segments(texts), "segments")
    going, known = [], []
    for deal in range(1, DEALS + 2):
        known.append(rows.where("kind = 1").select("doc_id", "d1", "start", "stop"))
        rows = rows.where("kind = 0")
        hot = stored(rows.groupBy("key").count().where(F.col("count") > CROWD).select("key"), "hot_minimizers")
        n_hot = hot.count()
        if deal > DEALS or not n_hot:
            going.append(rows)
            break
        hot = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
        going.append(rows.join(hot, "key", "left_anti"))
        rows = stored(finer_segments(rows.join(hot, "key", "left_semi"), deal), "segments")
    return going, known


def bucket_repeats(pdf: pd.DataFrame) -> pd.DataFrame:
    """doc_id, d1, start, stop (of windows, exclusive) of the repeats in one bucket's segments."""
    pdf = pdf.sort_values(["doc_id", "d1", "start"], kind="stable", ignore_index=True)
    first = ~pdf["bytes"].duplicated()
    out = [pdf.loc[~first, ["doc_id", "d1", "start", "stop"]]]
    pdf = pdf[first]
    crowd = pdf["key"].map(pdf["key"].value_counts())
    pdf = pdf[(crowd > 1) | pdf["again"]].reset_index(drop=True)
    if len(pdf):
        shards, held, owner, place, size = [], [], [], [], 0
        most = max(SHARD_BYTES, int(pdf["bytes"].map(len).sum()) // 200)
        for i, piece in enumerate(pdf["bytes"]):
            if size and size + len(piece) > most:
                shards.append(held)
                held, size = [], 0
            held.append(i)
            size += len(piece) + 1
        shards.append(held)
        pieces = pdf["bytes"].tolist()
        texts = []
        for held in shards:  # the separator 0 ends a segment; bytes are raised by one
            body = np.frombuffer(b"".join(pieces[i] + b"\xff" for i in held), np.uint8) + np.uint8(1)
            texts.append(body)
            length = np.array([len(pieces[i]) + 1 for i in held])
            owner.append(np.repeat(held, length))
            place.append(np.arange(len(body)) - np.repeat(np.cumsum(length) - length, length))
        side, position, common = merge(texts, LENGTH)
        base = np.cumsum([0, *map(len, texts)])
        at = base[side.astype(np.int64)] + position
        segment, offset = np.concatenate(owner)[at], np.concatenate(place)[at]
        n_windows = (pdf["stop"] - pdf["start"]).to_numpy()
        window = offset < n_windows[segment]
        run = np.cumsum(common < LENGTH)[window]
        segment, offset = segment[window], offset[window]  # segments are numbered in document order
        order = np.lexsort((offset, segment, run))
        later = np.concatenate([[False], run[order][1:] == run[order][:-1]])
        order = order[later]
        order = order[np.lexsort((offset[order], segment[order]))]
        segment, offset = segment[order], offset[order]
        if len(segment):
            new = np.concatenate([[True], (segment[1:] != segment[:-1]) | (offset[1:] != offset[:-1] + 1)])
            starts, ends = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(new)) - 1
            seg, start = segment[starts], pdf["start"].to_numpy()
            out.append(pd.DataFrame({
                "doc_id": pdf["doc_id"].to_numpy()[seg], "d1": pdf["d1"].to_numpy()[seg],
                "start": start[seg] + offset[starts], "stop": start[seg] + offset[ends] + 1,
            }))
    return pd.concat(out).astype("int64")


def repeats(segments: DataFrame) -> DataFrame:
    """Ranges of repeated windows in segments whose equal windows have equal keys."""
    segments = segments.select("key", "doc_id", "d1", "start", "stop", "again", "bytes")
    total = segments.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    dealt = segments.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(lambda pdf: bucket_repeats(pdf), "doc_id long, d1 long, start long, stop long")


def remove(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, d1, d2 (the text's hashes) and, if wanted, kept (the text left: a removed
    run may end inside a character, and what is left of that character goes too; null where nothing is removed)."""
    spark = docs.sparkSession
    texts = id_text(docs).where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), "text").alias("d2"), "text")
    with temporary(spark) as keep:
        scanned = stored(scan(texts), "scanned")
        stats = keep(stored(scanned.where("kind = 0").select("doc_id", "d1", "d2", "n_bytes", "sha"), "stats"))
        first = keep(stored(stats.groupBy("d1", "d2").agg(F.min("doc_id").alias("first_id")), "first_of_text"))
        lists = keep(stored(repeated_keys(scanned), "repeated_keys"))
    with temporary(spark) as keep:
        wanted = first.join(lists, "d1").withColumnsRenamed({"d1": "e1", "d2": "e2"})
        own = texts.join(wanted, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")) & (F.col("doc_id") == F.col("first_id")))
        own = keep(stored(own.select("doc_id", "d1", "d2", "text", "keys"), "texts"))
    with temporary(spark) as keep:
        going, known = settled(own)
        ranges = repeats(_union(going)).unionByName(_union(known))
        ranges = keep(stored(ranges.groupBy("doc_id", "d1").agg(F.collect_set(F.struct("start", "stop")).alias("ranges")), "ranges"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, found in zip(pdf["text"], pdf["ranges"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                gone = np.zeros(len(raw) + 1, np.int32)
                for r in found:
                    gone[r["start"]] += 1
                    gone[r["stop"] + LENGTH - 1] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((int(gone.sum()), spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if keep_text else None))
            columns = ["n_removed", "n_spans", "kept_sha256", "kept"]
            yield pd.concat([pdf[["doc_id", "d1", "d2"]].reset_index(drop=True), pd.DataFrame(rows, columns=columns)], axis=1)
        trim()

    partly = own.select("doc_id", "d1", "d2", "text").join(ranges, ["doc_id", "d1"]).mapInPandas(cut, "doc_id long, d1 long, d2 long, n_removed long, n_spans long, kept_sha256 string, kept string")
    partly = partly.select("doc_id", "d1", "d2", F.struct("n_removed", "n_spans", "kept_sha256", "kept").alias("own")).dropDuplicates(["doc_id", "d1", "d2"])
    rows = stats.join(first, ["d1", "d2"]).join(partly, ["doc_id", "d1", "d2"], "left")
    copy = (F.col("doc_id") != F.col("first_id")) & (F.col("n_bytes") >= LENGTH)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return rows.select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("own.n_removed", zero)).alias("n_removed"),
        F.when(copy, one).otherwise(F.coalesce("own.n_spans", zero)).alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("own.kept_sha256", "sha")).alias("kept_sha256"),
        "d1", "d2", F.when(copy, F.lit("")).otherwise(F.col("own.kept")).alias("kept"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
