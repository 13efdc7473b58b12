"""The trie of conversation prefixes, with totals of subtrees by leaf-peeling message passing.

A conversation is rebuilt from the first turns of the one its session began with and its own later ones (``Rebuild``). A
node is a distinct sequence of first turns; its members are the conversations that begin with it. A node is known by the
exclusive or of two 64-bit hashes of (depth, role, text) over its turns, so its parent's name is its own without its last
turn's hashes, and nodes, members and children are aggregates with map-side sums.

Peeling: the trie is cut into paths. A node's path is that of its longest conversation (the smallest id among these), so
every node has at most one child on its own path, and every path ends in a childless node. A path waits for the other
children of its nodes; one that waits for none sends its totals to the parent of its top node, and counters go down, until
only the root's path is left. A chain of any length is so peeled in one turn, and the number of turns is that of paths
nested in each other: each is longer than those hung on it, so below the square root of twice the number of nodes. Then a node's
totals are what its path has from it on: a running total over the path, deepest first.

Nothing is held by one task but blocks of a conversation or a path: turns are numbered and hashes and totals are run by
``operators.scans``. The ids that end in a node are joined to text by blocks of 4,096 ids; the digest of a node's ids is
sequential by definition, so one task streams a node's blocks, holding a block at a time.

Turns are ordered by turn, null first; ties by role, then text; a repeated row is a turn again. Null role or text: empty. Rows
without conv_id are left out. A conversation of which no turn is left is a member of the root only. An empty table gives
no rows, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, temporary
from tidemark.operators import scans

#: A session's first conversation has an id divisible by SESSION; at most HEAD - 1 of its turns begin the others.
SESSION, HEAD = 5, 9
#: Depths in a block of a conversation or path, and ids in a block of a node, as powers of two.
DEPTH_BITS, ID_BITS = 12, 12
NODE = ["h1", "h2"]


def session_of(conv_id: Column) -> Column:
    return conv_id - conv_id % SESSION


def taken_of(conv_id: Column) -> Column:
    """How many of the session's first turns stand before a conversation's own."""
    return (F.crc32(conv_id.cast("string")) % HEAD).cast("int")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, n (1, 2, ...), two hashes of the turn, bytes of its text."""
    empty = F.lit("")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("known"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    rows = rows.withColumn("head", F.substring("text", 1, 32))
    hashes = [F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(7), "text", "role").alias("t2")]
    cut = scans.in_blocks(rows, ["conv_id"], ["known", "turn", "role", "head"], "turns", ties=["text"], kept=["conv_id", *hashes, F.octet_length("text").cast("long").alias("bytes")], store=stored)
    return scans.numbered(cut, ["conv_id"]).drop(scans.BLOCK, scans.PLACE)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id, last: their depth) and their turns (conv_id, last, depth, t1, t2, bytes) as rebuilt."""
    lengths = turns.groupBy("conv_id").agg(F.max("n").alias("length"))
    firsts = lengths.where(F.col("conv_id") % SESSION == 0).select(F.col("conv_id").alias("session"), F.col("length").alias("first_length"))
    h = taken_of(F.col("conv_id"))
    convs = lengths.withColumns({"session": session_of(F.col("conv_id")), "h": h}).join(firsts, "session", "left")
    taken = F.least(F.col("h").cast("long"), F.coalesce("first_length", F.lit(0)))
    convs = stored(convs.select("conv_id", "session", "h", taken.alias("taken"), (taken + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("last")), "conversations")

    turn = ["t1", "t2", "bytes"]
    begin = turns.where((F.col("conv_id") % SESSION == 0) & (F.col("n") < HEAD)).select(F.col("conv_id").alias("session"), "n", *turn)
    begin = begin.join(convs, "session").where("n <= taken").select("conv_id", "last", F.col("n").alias("depth"), *turn)
    later = turns.where(F.col("n") > h).join(convs.select("conv_id", "taken", "last"), "conv_id").select("conv_id", "last", (F.col("n") - h + F.col("taken")).alias("depth"), *turn)
    return convs, begin.unionByName(later)


def _by_depth(df: DataFrame, depth: Column) -> DataFrame:
    return df.withColumns({scans.BLOCK: F.shiftright(depth, DEPTH_BITS), scans.PLACE: depth})


def prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each first d turns of a conversation, d = 0 too: conv_id, last, depth, the node and its parent, bytes."""
    own = {"h1": F.xxhash64("depth", "t1", "t2"), "h2": F.xxhash64(F.lit(7), "t2", "t1", "depth")}
    hashed = turns.select("conv_id", "last", "depth", "bytes", *[c.alias(f"own_{n}") for n, c in own.items()])
    run = scans.scan(_by_depth(hashed, F.col("depth")), ["conv_id"], xors={n: F.col(f"own_{n}") for n in own}, own=True, send=False)
    parents = [F.col(h).bitwiseXOR(F.col(f"own_{h}")).alias(p) for h, p in (("h1", "p1"), ("h2", "p2"))]
    none = F.lit(None).cast("long")
    roots = convs.select("conv_id", "last", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), *[F.lit(0).cast("long").alias(h) for h in NODE], none.alias("p1"), none.alias("p2"))
    return stored(run.select("conv_id", "last", "depth", "bytes", *NODE, *parents).unionByName(roots), "prefixes")


def nodes_of(rows: DataFrame) -> DataFrame:
    """Node, parent, depth, bytes of the last text, smallest and number of members, path (its longest member), children."""
    longest = F.min(F.struct((-F.col("last")).alias("down"), "conv_id"))["conv_id"]
    same = [F.max(c).alias(c) for c in ("p1", "p2", "depth", "bytes")]
    nodes = rows.groupBy(*NODE).agg(*same, F.min("conv_id").alias("smallest"), F.count("*").alias("n_convs"), longest.alias("path"))
    nodes = stored(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count("*").alias("n_children"))
    return stored(nodes.join(children, NODE, "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0).cast("long")), "own": (F.col("n_convs") - 1) * F.col("bytes")}), "nodes_with_children")


def peeled(nodes: DataFrame) -> DataFrame:
    """What each node gets from the children that are not on its own path: h1, h2, leaves, saved."""
    top = F.min(F.struct("depth", "p1", "p2"))
    waits = F.sum(F.greatest(F.col("n_children") - 1, F.lit(0)))
    paths = nodes.groupBy("path").agg(top.alias("top"), waits.alias("waits"), F.sum("own").alias("saved"))
    live = stored(paths.select("path", F.col("top.p1").alias("p1"), F.col("top.p2").alias("p2"), "waits", F.lit(1).cast("long").alias("leaves"), "saved"), "paths")
    hung = live.where("p1 is not null").select(F.col("p1").alias("h1"), F.col("p2").alias("h2")).distinct()
    owners = stored(nodes.join(hung, NODE, "left_semi").select(*NODE, F.col("path").alias("owner")), "owners")
    sent: list[DataFrame] = []
    while True:
        ready = live.where("waits = 0 and p1 is not null")
        messages = stored(ready.groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count("*").alias("n"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "messages")
        if messages.isEmpty():
            break
        sent.append(messages)
        got = messages.join(owners, NODE).groupBy("owner").agg(F.sum("n").alias("n"), F.sum("leaves").alias("more"), F.sum("saved").alias("more_saved"))
        rest = live.where("waits > 0 or p1 is null").join(got, F.col("path") == F.col("owner"), "left")
        plus = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0).cast("long"))).alias(c)
        live = stored(rest.select("path", "p1", "p2", plus("waits", -F.col("n")), plus("leaves", "more"), plus("saved", "more_saved")), "paths")
    out = messages
    for m in sent:
        out = out.unionByName(m)
    return out.groupBy(*NODE).agg(F.sum("leaves").alias("got_leaves"), F.sum("saved").alias("got_saved"))


def ends_of(rows: DataFrame) -> DataFrame:
    """h1, h2, ends_sha256 of the ids of the conversations that end in a node, in order and comma-joined."""
    ends = rows.where("depth = last").select(*NODE, F.shiftright("conv_id", ID_BITS).alias("part"), "conv_id")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    parts = ends.groupBy(*NODE, "part").agg(ids.alias("ids")).repartition(*NODE).sortWithinPartitions(*NODE, "part").select(*NODE, "ids")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            done = []
            for h1, h2, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h1, h2) != at:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = (h1, h2), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _digest_batch(done)
        if at is not None:
            yield _digest_batch([(*at, digest.hexdigest())])

    return parts.mapInArrow(digests, "h1 long, h2 long, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], names=[*NODE, "ends_sha256"])


def trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark, zero = conversations.sparkSession, F.lit(0).cast("long")
    with temporary(spark) as keep:
        rows = prefixes(*rebuilt(stored(numbered_turns(conversations), "numbered_turns")))
        nodes = nodes_of(rows)
        full = nodes.join(peeled(nodes), NODE, "left").join(ends_of(rows), NODE, "left")
        deepest_first = _by_depth(full, -F.col("depth"))
        more = {"below_leaves": F.coalesce("got_leaves", zero), "saved_tokens": F.col("own") + F.coalesce("got_saved", zero)}
        full = scans.scan(deepest_first, ["path"], sums=more, own=True, send=False)
        parents = nodes.select(F.col("h1").alias("q1"), F.col("h2").alias("q2"), F.col("smallest").alias("parent_conv_id"))
        out = full.join(parents, (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2")), "left")
        none = hashlib.sha256(b"").hexdigest()
        out = out.select(
            F.col("smallest").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", (F.col("below_leaves") + 1).alias("n_leaves"),
            "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
        return keep(stored(out, "trie"))
