"""Token-id files with directly addressable codes.

Each id is cut into chunks of ``CHUNK`` bits, lowest first. Level 0 holds the first chunk of every id; a continuation
bitmap tells which ids go on, and level n+1 holds the next chunk of those only. A rank directory counts the set bits
before each block of ``RANK_BLOCK`` bits, so any token is read by one chunk a level, without decoding its neighbours.

A file (one row of the written table: Spark's writer commits it whole, so a lost executor leaves no half file, and any
store that Spark writes to will do, and it is stored uncompressed, so that an address leads to its bytes) is laid out as follows, little-endian:

    "DAC1", u32 levels, u64 tokens, u64 documents,
    i64 doc_id of each document, u64 first token of each document and the end,
    for each level: u64 chunks, the chunks (u8), ceil(chunks / 8) bytes of continuation bits,
                    u64 rank before each block of RANK_BLOCK bits

Null text: an empty document, i.e. its end id alone. Repeated doc_ids keep one entry a row, ordered by text. An empty
table gives no files. A row without doc_id can't be addressed and is left out. Other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, scratch_path, stored
from tidemark.llm.words_bpe import word_cache
from tidemark.operators import scans

CHUNK = 8
RANK_BLOCK = 512
#: Tokens after which a file is closed: it bounds a row of the table and a reader's memory.
FILE_TOKENS = 2_000_000

FILE_SCHEMA = "part int, seq int, first_doc long, n_docs long, n_tokens long, before_in_part long, payload binary"


def write_levels(ids: np.ndarray) -> list[bytes]:
    out, rest = [], ids.astype(np.uint32)
    while True:
        more = (rest >> CHUNK) > 0
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BLOCK), dtype=np.int64) if len(more) else np.zeros(0, np.int64)
        out.append(struct.pack("<Q", len(rest)) + rest.astype(np.uint8).tobytes() + bits.tobytes() + (np.cumsum(ones) - ones).astype("<u8").tobytes())
        rest = rest[more] >> CHUNK
        if not len(rest):
            return out


def to_file(doc_ids: list[int], parts: list[np.ndarray]) -> bytes:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    levels = write_levels(np.concatenate(parts) if parts else np.zeros(0, np.uint32))
    head = b"DAC1" + struct.pack("<IQQ", len(levels), int(sizes.sum()), len(parts))
    return head + np.array(doc_ids, "<i8").tobytes() + np.concatenate([[0], np.cumsum(sizes)]).astype("<u8").tobytes() + b"".join(levels)


class TokenFile:
    """Reads one file; nothing is decoded until it is asked for."""

    def __init__(self, payload: bytes):
        if payload[:4] != b"DAC1":
            raise ValueError("not a token file")
        n_levels, self.n_tokens, self.n_docs = struct.unpack_from("<IQQ", payload, 4)
        at = 24
        self.doc_ids = np.frombuffer(payload, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self.starts = np.frombuffer(payload, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", payload, at)
            at += 8
            chunks = np.frombuffer(payload, np.uint8, n, at)
            at += n
            bits = np.frombuffer(payload, np.uint8, -(-n // 8), at)
            at += len(bits)
            ranks = np.frombuffer(payload, "<u8", -(-n // RANK_BLOCK), at)
            at += 8 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def rank(self, level: int, i: int) -> int:
        """Set bits before bit i: one directory entry and at most one block of the bitmap."""
        _, bits, ranks = self.levels[level]
        block = i // RANK_BLOCK
        first = block * RANK_BLOCK
        inside = np.unpackbits(bits[first // 8 : -(-i // 8)], bitorder="little")[: i - first]
        return int(ranks[block]) + int(inside.sum()) if block < len(ranks) else int(ranks[-1]) + int(inside.sum())

    def token(self, i: int) -> int:
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            i = self.rank(level, i)
        return value

    def tokens(self, start: int, stop: int, level: int = 0) -> np.ndarray:
        """Ids start..stop, by one slice of each level."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        chunks, bits, _ = self.levels[level]
        out = chunks[start:stop].astype(np.uint32)
        more = np.unpackbits(bits[start // 8 : -(-stop // 8)], bitorder="little")[start % 8 : start % 8 + stop - start].astype(bool)
        if n := int(more.sum()):
            first = self.rank(level, start)
            out[more] |= self.tokens(first, first + n, level + 1) << CHUNK
        return out

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.starts[k]), int(self.starts[k + 1]))


def write(docs: DataFrame, tokenizer_path: str, end_id: int = 0, partitions: int | None = None, path: str | None = None) -> str:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each, and write files in ascending doc_id order; returns the path."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token_files")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = word_cache(tokenizer_path)
        end = np.array([end_id], np.uint32)
        doc_ids: list[int] = []
        parts: list[np.ndarray] = []
        held = seq = before = 0
        part = TaskContext.get().partitionId()

        def closed() -> pd.DataFrame:
            nonlocal held, seq, before
            row = {"part": part, "seq": seq, "first_doc": doc_ids[0], "n_docs": len(parts), "n_tokens": held, "before_in_part": before, "payload": to_file(doc_ids, parts)}
            seq, before, held = seq + 1, before + held, 0
            doc_ids.clear()
            parts.clear()
            return pd.DataFrame([row])

        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"], strict=True):
                own = cache.encode(text)
                doc_ids.append(doc_id)
                parts.append(np.concatenate([own, end]))
                held += len(own) + 1
                if held >= FILE_TOKENS:
                    yield closed()
        if parts:
            yield closed()

    ordered = id_text(docs).where(F.col("doc_id").isNotNull()).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    # as they are: a compressed page would have to be decoded for one token
    ordered.mapInPandas(files, FILE_SCHEMA).write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
    return path


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The tokens at (doc_id, i), i from 0, of the files at ``path``: doc_id, i, token; null where there is no such place.

    Each pair finds its file as of the last one that begins at or before its doc_id; only files between the first and the last one
    found are read, and of these a chunk a level for each pair. Of a repeated doc_id the first entry of its last file counts."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    none = F.lit(None).cast("long")
    asked = wanted.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("i").cast("long").alias("i"), F.lit(1).alias("kind"), none.cast("int").alias("part"), none.cast("int").alias("seq"))
    begins = files.select(F.col("first_doc").alias("doc_id"), none.alias("i"), F.lit(0).alias("kind"), "part", "seq")
    cut = scans.in_blocks(begins.unionByName(asked), [], ["doc_id", "kind", "part", "seq", "i"], "lookup", store=stored)
    placed = scans.scan(cut, [], lasts={"file": F.when(F.col("kind") == 0, F.struct("part", "seq", F.col("doc_id").alias("first_doc")))}).where("kind = 1")
    placed = stored(placed.select("doc_id", "i", "file.*"), "lookup_placed")
    ends = placed.agg(F.min("first_doc").alias("low"), F.max("first_doc").alias("high")).first()
    deal = F.pmod(F.xxhash64("doc_id", "i"), F.lit(8))  # a file that is asked for much is read by some tasks
    of_file = placed.where("part is not null").groupBy("part", "seq", deal.alias("deal")).agg(F.collect_list(F.struct("doc_id", "i")).alias("places"))
    read_files = files.where(F.col("first_doc").between(ends["low"], ends["high"])) if ends["low"] is not None else files.limit(0)

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for payload, places in zip(pdf["payload"], pdf["places"], strict=True):
                f = TokenFile(payload)
                out = []
                for place in places:
                    doc_id, i = place["doc_id"], None if pd.isna(place["i"]) else int(place["i"])  # a null makes the others floats
                    k = int(np.searchsorted(f.doc_ids, doc_id))
                    there = k < f.n_docs and f.doc_ids[k] == doc_id and i is not None and 0 <= i < f.starts[k + 1] - f.starts[k]
                    out.append((doc_id, i, f.token(int(f.starts[k]) + i) if there else None))
                yield pd.DataFrame(out, columns=["doc_id", "i", "token"]).astype("Int64")

    found = of_file.join(read_files.select("part", "seq", "payload"), ["part", "seq"]).select("payload", "places").mapInPandas(tokens, "doc_id long, i long, token long")
    return found.unionByName(placed.where("part is null").select("doc_id", "i", none.alias("token")))


def read(spark, path: str) -> DataFrame:
    """A row for each document of the files at ``path``: doc_id, start, n_tokens, ids_crc32, ids (u32 little-endian).

    Global starts need one count for each range partition; that table has as many rows as ``write`` had partitions, so it
    is broadcast at any size of the input."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    index = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before_part"))

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for before, payload in zip(pdf["before"], pdf["payload"], strict=True):
                f = TokenFile(payload)
                rows = {"doc_id": f.doc_ids.tolist(), "start": (f.starts[:-1] + int(before)).tolist(), "n_tokens": np.diff(f.starts).tolist()}
                rows["ids"] = [f.document(k).astype("<u4").tobytes() for k in range(f.n_docs)]
                rows["ids_crc32"] = [zlib.crc32(x) for x in rows["ids"]]
                yield pd.DataFrame(rows)

    placed = files.join(F.broadcast(index), "part").select((F.col("before_part") + F.col("before_in_part")).alias("before"), "payload")
    return placed.mapInPandas(documents, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")
