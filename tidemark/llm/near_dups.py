"""MinHash near-duplicate grouping: SuperMinHash signatures, banding, exact verification, union-find grouping.

Words are runs of characters other than ASCII white space, A-Z lower-cased; a document's set holds its distinct 5-word
shingles as 64-bit hashes (fewer words: the whole sequence as one). Two documents are linked if 100 * |A & B| >=
75 * |A | B|, which is always confirmed on the full sets; a component is what links reach.

1. One pass over the texts makes, for each document, its set's size, a 128-bit digest of the set and a SuperMinHash
   signature's band keys. Documents of equal sets are one class; from here on only each class's smallest doc_id counts,
   so a group of exact copies is one row, whatever its size.
2. Every bucket (band, key) takes its smallest member as hub, and each member is compared with the distinct hubs of its
   buckets, never with all members. A min-label union-find over DataFrames merges the links, so a group of near copies
   is mostly one component after this turn. A hub has met all of its bucket and leaves it.
3. What is left in a bucket is the members of its commonest component and those outside it. Both are dealt into chunks of
   at most about CHUNK_MEMBERS members and CHUNK_ITEMS shingles, and every chunk of outsiders meets every other chunk in a
   block: an index of one chunk's shingles counts what each member of the other shares with all of them at once. A block
   emits a link only where it joins two components, fewer than it has members; pairs that aren't links never become rows.
4. A bucket with more than DEAL_BEYOND outsiders (texts around one common passage, say) is first dealt into smaller ones
   by a further, independent signature, which a pair that is similar enough shares as surely as the first, and step 2
   follows for these. So a member goes to a bounded number of blocks and the rows stay in proportion to the buckets.

Every comparison is exact: counts of the full sets, 48 bits a shingle. With BANDS bands of BAND_ROWS registers, a pair of
similarity 0.75 shares no bucket with probability (1 - 0.75 ** BAND_ROWS) ** BANDS = 1.7e-4, and pairs above it far less;
that much again for each level at which all the buckets that a pair shares were dealt anew.

Null or empty text, or no words: an empty set, linked with nothing. Rows without doc_id are left out; a repeated doc_id
counts as one document whose set is that of its smallest text, and gives one row. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, id_text, stored, temporary, trim

SHINGLE = 5
BANDS, BAND_ROWS = 32, 5
REGISTERS = BANDS * BAND_ROWS
LINK, OF = 75, 100
#: Members that are compared with a hub in one task.
CHUNK_PAIRS = 256
#: Members and shingles of a chunk; each side of a block is a chunk.
CHUNK_MEMBERS, CHUNK_ITEMS = 512, 200_000
#: Members outside a bucket's commonest component beyond which the bucket is dealt into smaller ones.
DEAL_BEYOND = 2048
#: Shingles whose signatures are made together: it bounds the permutation table, 320 bytes each.
SIGN_AT_ONCE = 50_000
#: Words whose hashes a task remembers.
REMEMBERED = 100_000
#: doc_ids (16 bytes each) up to which candidates are sent to every task that reads texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Shingles:
    """Distinct shingle hashes of texts, sorted. Word hashes are kept in a dictionary that is emptied at a limit."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit, self.hash = limit, {}

    def words(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        get = self.hash.__getitem__
        try:
            return np.fromiter(map(get, words), np.uint64, len(words))
        except KeyError:
            if len(self.hash) > self.limit:
                self.hash.clear()
            self.hash.update((w, xxhash.xxh3_64_intdigest(w)) for w in set(words) if w not in self.hash)
            return np.fromiter(map(get, words), np.uint64, len(words))

    def of(self, text: str) -> np.ndarray:
        h = self.words(text)
        if not len(h):
            return h
        k = min(SHINGLE, len(h))
        n = len(h) - k + 1
        x = np.full(n, U(k))
        for i in range(k):
            x = mix(x * GOLDEN + h[i : i + n])
        return np.unique(x)


def superminhash(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """SuperMinHash signatures (len(sets), m).

    Element e has a random permutation of the m registers and a uniform u_j a step j; register p_j of the signature gets
    the least u_j + j. Step j is done for all sets at once, and a set stops as soon as all its registers are filled, since
    later steps only give larger values. The permutation is a Fisher-Yates shuffle made as far as it is used.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.full((len(sets), m), np.inf)
    live = np.flatnonzero(sizes)
    element = np.concatenate([sets[i] for i in live]) if len(live) else np.zeros(0, np.uint64)
    row = np.repeat(live, sizes[live])
    swapped = None
    for j in range(m):
        if not len(row):
            break
        r = mix(element + U((j + 1) * int(GOLDEN) & MASK))
        u = (r >> U(32)).astype(np.float64) / 2.0**32
        k = j + ((r & U(0xFFFFFFFF)) * U(m - j) >> U(32)).astype(np.int64)
        if j == 0:
            register, first = k, k
        else:
            if swapped is None:  # few are left after the first step: all of large sets are done
                swapped = np.tile(np.arange(m, dtype=np.int16), (len(row), 1))
                at = np.arange(len(row))
                swapped[at, first] = 0
            register = swapped[at, k].astype(np.int64)
            swapped[at, k] = swapped[at, j]
        np.minimum.at(out.reshape(-1), row * m + register, u + j)
        open_sets = np.isinf(out).any(1)
        keep = open_sets[row]
        if not keep.all():
            element, row = element[keep], row[keep]
            first = first[keep] if j == 0 else first
            if swapped is not None:
                swapped, at = swapped[keep], np.arange(len(row))
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row."""
    bits = signature.view(np.uint64).reshape(len(signature), BANDS, BAND_ROWS)
    x = np.tile(np.arange(BANDS, dtype=np.uint64) * GOLDEN, (len(signature), 1))
    for i in range(BAND_ROWS):
        x = mix(x * GOLDEN + bits[:, :, i])
    return x.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest and bands (null for an empty set)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles()
        for pdf in batches:
            ids, texts = pdf["doc_id"].to_numpy(), pdf["text"].tolist()
            at = 0
            while at < len(texts):
                sets: list[np.ndarray] = []
                n = 0
                while at + len(sets) < len(texts) and (not sets or n < SIGN_AT_ONCE):
                    sets.append(shingles.of(texts[at + len(sets)]))
                    n += len(sets[-1])
                keys = band_keys(superminhash(sets))
                yield pd.DataFrame({
                    "doc_id": ids[at : at + len(sets)],
                    "n_shingles": [len(x) for x in sets],
                    "digest": [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets],
                    "bands": [k.tolist() if len(x) else None for k, x in zip(keys, sets, strict=True)],
                })
                at += len(sets)
        shingles.hash.clear()
        trim()

    return docs.mapInPandas(rows, "doc_id long, n_shingles long, digest binary, bands array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, items: the sorted set's low 48 bits of each hash, six bytes each."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles()
        for pdf in batches:
            sets = [shingles.of(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n": [len(x) for x in sets], "items": [pack48(x) for x in sets]})

    return docs.mapInPandas(rows, "doc_id long, n long, items binary")


def pack48(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(np.sort(x & U((1 << 48) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (hub, doc_id) whose full sets are similar enough. A hub's set is copied to every chunk of its members."""
    pairs = stored(pairs, "pairs")
    crowd = stored(pairs.groupBy("hub").agg(F.ceil(F.count("*") / CHUNK_PAIRS).alias("chunks")).where("chunks > 1"), "crowded_hubs")
    pairs = pairs.join(broadcast_if_small(crowd, BROADCAST_IDS), "hub", "left").select("hub", "doc_id", F.coalesce(F.pmod(F.xxhash64("doc_id"), "chunks"), F.lit(0)).alias("chunk"))
    pairs = stored(pairs, "chunked_pairs")
    chunks = pairs.select(F.col("hub").alias("hub_of"), F.col("chunk").alias("chunk_of")).distinct()
    hub_sets = chunks.join(sets.select(F.col("doc_id").alias("hub_of"), F.col("items").alias("hub_items")), "hub_of")
    members = pairs.join(sets, "doc_id")

    def compare(hubs: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        hub, found = unpack48(hubs["hub_items"].iloc[0]) if len(hubs) else np.zeros(0, np.uint64), []
        for doc_id, items in zip(own["doc_id"], own["items"], strict=True):
            other = unpack48(items)
            at = np.searchsorted(hub, other)
            both = int((hub[np.minimum(at, len(hub) - 1)] == other).sum()) if len(hub) else 0
            if OF * both >= LINK * (len(hub) + len(other) - both):
                found.append(doc_id)
        return pd.DataFrame({"hub": own["hub"].iloc[:1].repeat(len(found)).to_numpy(), "doc_id": found}).astype("int64")

    grouped = members.groupBy("hub", "chunk").cogroup(hub_sets.groupBy("hub_of", "chunk_of"))
    return grouped.applyInPandas(lambda own, hubs: compare(hubs, own), "hub long, doc_id long")


def block_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b: labels) of a block: members (doc_id, label, chunk, items) of one chunk among themselves, or of two with
    each other. Only those that join two components so far apart."""
    low, high = pdf[pdf["chunk"] == pdf["lower"]], pdf[pdf["chunk"] == pdf["upper"]]
    label = {x: x for x in pdf["label"].tolist()}

    def find(x: int) -> int:
        while label[x] != x:
            label[x] = x = label[label[x]]
        return x

    sets = [unpack48(x) for x in high["items"]]
    size = np.array([len(x) for x in sets], np.int64)
    items = np.concatenate(sets or [np.zeros(0, np.uint64)])
    order = np.argsort(items, kind="stable")
    items, owner = items[order], np.repeat(np.arange(len(sets)), size)[order]
    labels, found = high["label"].tolist(), []
    for own_label, raw in zip(low["label"].tolist(), low["items"], strict=True):
        own = unpack48(raw)
        start, stop = np.searchsorted(items, own, "left"), np.searchsorted(items, own, "right")
        n = stop - start
        at = np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)
        both = np.bincount(owner[at], minlength=len(sets))
        for i in np.flatnonzero(OF * both >= LINK * (len(own) + size - both)).tolist():
            x, y = find(own_label), find(labels[i])
            if x != y:
                label[max(x, y)] = min(x, y)
                found.append((own_label, labels[i]))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def blocks(open_buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b: labels) between the components of buckets: each member with the chunks that it has to meet."""
    chunk = F.when(F.col("label") == F.col("common"), F.col("outer") + F.pmod(F.xxhash64("doc_id"), F.col("inner"))).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("outer")))
    meets = F.when(F.col("label") == F.col("common"), F.col("outer")).otherwise(F.col("outer") + F.col("inner"))
    alone = F.col("inner") == 0  # a bucket that is one chunk
    rows = open_buckets.select("band", "key", "doc_id", "label", F.when(alone, F.lit(0)).otherwise(chunk).alias("chunk"), F.when(alone, F.lit(1)).otherwise(meets).alias("meets"))
    rows = rows.select("band", "key", "doc_id", "label", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("meets") - 1)).alias("other"))
    rows = rows.select("band", "key", "doc_id", "label", "chunk", F.least("chunk", "other").alias("lower"), F.greatest("chunk", "other").alias("upper"))
    rows = rows.join(sets.select("doc_id", "items"), "doc_id")
    return rows.groupBy("band", "key", "lower", "upper").applyInPandas(lambda pdf: block_links(pdf), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that links (a, b) reach, by min-label steps that also jump to the label's label."""
    edges = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("least"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = labels.join(near, "node").join(up, "label")
        new = stored(step.select("node", F.least("label", "least", "up").alias("label"), (F.least("least", "up") < F.col("label")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id (smallest doc_id of the same set) of every document."""
    texts = id_text(docs).where(F.col("doc_id").isNotNull())
    repeated = texts.groupBy("doc_id").count().where("count > 1")
    if not repeated.isEmpty():
        once = texts.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
        texts = texts.join(repeated, "doc_id", "left_anti").unionByName(once)
    with temporary(texts.sparkSession) as keep:
        sketch = stored(sketches(texts), "sketches")
        classes = stored(sketch.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("class_id")), "classes")
        labels = _linked(sketch, classes, texts)
        out = sketch.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
        out = out.select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"))
        out = out.join(labels.select(F.col("node").alias("class_id"), "label"), "class_id", "left").select("doc_id", "n_shingles", "class_id", F.coalesce("label", "class_id").alias("component_id"))
        return keep(stored(out.withColumn("kept", F.col("doc_id") == F.col("component_id")), "near_duplicate_groups"))


def _buckets(rows: DataFrame) -> DataFrame:
    """Rows (band, key, doc_id, n) of buckets with more than one member, and their hubs."""
    crowded = rows.groupBy("band", "key").agg(F.count("*").alias("size"), F.min("doc_id").alias("hub")).where("size > 1")
    return stored(rows.join(crowded.select("band", "key", "hub"), ["band", "key"]), "buckets")


def _dealt(crowded: DataFrame, sets: DataFrame, level: int) -> DataFrame:
    """Members of crowded buckets in smaller ones: each by the band keys of another signature of its set."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = U(level * 0xD1B54A32D192ED03 & MASK)
        for pdf in batches:
            for at in range(0, len(pdf), 128):
                part = pdf.iloc[at : at + 128]
                keys = band_keys(superminhash([mix(unpack48(x) ^ salt) for x in part["items"]]))
                yield pd.DataFrame({"doc_id": part["doc_id"], "keys": keys.tolist()})

    keys = sets.join(crowded.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "items").mapInPandas(rows, "doc_id long, keys array<long>")
    dealt = crowded.join(keys, "doc_id").select("doc_id", "n", "band", "key", F.posexplode("keys").alias("b", "k"))
    return dealt.select("band", F.xxhash64("key", "b", "k").alias("key"), "doc_id", "n")


def _open(placed: DataFrame) -> DataFrame:
    """Of the buckets with more than one label: the commonest label, how many members are outside it, and the chunks of the
    members outside it and in it (outer, inner; 1 and 0 if all are one chunk)."""
    by_label = placed.groupBy("band", "key", "label").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    of = by_label.groupBy("band", "key").agg(F.max(F.struct("m", "label", "w")).alias("top"), F.sum("m").alias("m"), F.sum("w").alias("w"))
    chunks = lambda m, w: F.ceil(F.greatest(m / CHUNK_MEMBERS, w / CHUNK_ITEMS))
    alone = chunks(F.col("m"), F.col("w")) <= 1
    outside = F.col("m") - F.col("top.m")
    outer = F.when(alone, F.lit(1)).otherwise(chunks(outside, F.col("w") - F.col("top.w")))
    inner = F.when(alone, F.lit(0)).otherwise(chunks(F.col("top.m"), F.col("top.w")))
    return of.select("band", "key", F.col("top.label").alias("common"), outside.alias("outside"), outer.alias("outer"), inner.alias("inner")).where("outside > 0")


def _linked(sketch: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, label) of the linked among the classes' smallest documents."""
    reps = sketch.join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi")
    member = _buckets(reps.select("doc_id", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "key")))
    own = stored(member.select("doc_id").distinct(), "candidates")
    sets = stored(shingle_sets(texts.join(broadcast_if_small(own, BROADCAST_IDS), "doc_id", "left_semi")), "sets")
    labels, level = texts.sparkSession.createDataFrame([], "node long, label long"), 0
    while True:
        member = member.where("doc_id <> hub")
        links = stored(verified(member.select("hub", "doc_id").distinct(), sets), "links").toDF("a", "b")
        labels = components(links.unionByName(labels.where("node <> label").toDF("a", "b")))
        placed = member.drop("hub").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
        rows = stored(placed.join(_open(placed), ["band", "key"]), "open_buckets")
        links = stored(blocks(rows.where(F.col("outside") <= DEAL_BEYOND), sets), "block_links")
        if not links.isEmpty():
            labels = components(links.unionByName(labels.where("node <> label").toDF("a", "b")))
        crowded = rows.where(F.col("outside") > DEAL_BEYOND).select("band", "key", "doc_id", "n")
        if crowded.isEmpty():
            return labels
        level += 1
        member = _buckets(_dealt(crowded, sets, level))
