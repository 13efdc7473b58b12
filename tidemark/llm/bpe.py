"""BPE encoding and decoding over a table of distinct words.

1. Every task splits its texts into words once and puts them into blocks of about ``BLOCK_CHARS`` characters. A block keeps
   its distinct words, and its documents as positions in that list. Blocks are written to the shared folder.
2. The words of all blocks are dealt by word and sorted, so equal words meet; each distinct word is encoded once, and its
   ids go back to every (block, position) that holds it, packed by block.
3. A block's ids are joined to it and put at the words' positions, which gives each document's ids.

The rows of step 2 are one for each distinct word of a block: the commonest word has as many as there are blocks, far
fewer than a task can hold, and a task keeps no table of words.

Decoding joins ids to the vocabulary's pieces; that table is bounded by the vocabulary and held by every task.

Null text: the empty text, no ids. A row without doc_id is kept, with a null doc_id; repeated rows give a row each; an
empty table gives no rows; other columns of the input are ignored. A text of any length is one row: its words' positions
and its ids need four bytes each in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, stored_in_buckets, trim
from tidemark.llm.words_bpe import PieceTable, flatten, gather_array, piece_table, pieces_of

#: Characters of a block: the more, the fewer words are sent again by other blocks.
BLOCK_CHARS = 32_000_000
#: A block is numbered by its task and its place in the task (up to 2 ** SEQUENCE_BITS blocks of one task), and a word by its
#: block and its place there, in one number of 63 bits: 2 ** 20 tasks, 2 ** 16 blocks of a task, 2 ** 27 distinct words a block.
SEQUENCE_BITS, PLACE_BITS = 16, 27
#: Words whose ids are packed together.
PACKED_WORDS = 400_000

BLOCK = "block long, n long, doc_ids binary, sizes binary, codes binary, words array<string>"
ENCODED = "doc_id long, ids binary"
Row = Callable[[np.ndarray, PieceTable], tuple]


def squeezed(x: np.ndarray) -> bytes:
    """Numbers under 2 ** 32, small ones mostly: compressed by planes of bytes."""
    planes = np.ascontiguousarray(x.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueezed(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


class Numbers(dict):
    """New words get the next number."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Block:
    """Documents as positions in a list of their distinct words."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.codes: list[np.ndarray] = []
        self.number = Numbers()

    def add(self, doc_id: int | None, words: list[str]) -> None:
        self.ids.append(doc_id)
        self.codes.append(np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words)))

    def row(self, block: int) -> pd.DataFrame:
        if len(self.number) >> PLACE_BITS:
            raise ValueError("too many distinct words in one block")
        # numbered as they come, so common words have small numbers and those met once run on: they take little room
        codes = squeezed(np.concatenate(self.codes))
        ids = np.array([0 if i is None else i for i in self.ids], "<i8").tobytes() + np.array([i is None for i in self.ids], np.uint8).tobytes()
        sizes = np.fromiter(map(len, self.codes), np.uint32, len(self.codes))
        return pd.DataFrame([{"block": block, "n": len(self.ids), "doc_ids": ids, "sizes": squeezed(sizes), "codes": codes, "words": list(self.number)}])


def blocks(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, number = pieces_of(tokenizer_path), TaskContext.get().partitionId() << SEQUENCE_BITS
        block, chars = Block(), 0
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"], strict=True):
                block.add(None if doc_id is pd.NA else int(doc_id), pieces.split(text))
                chars += len(text)
                if chars >= BLOCK_CHARS:
                    yield block.row(number)
                    block, chars, number = Block(), 0, number + 1
        if block.ids:
            yield block.row(number)
        del block
        trim()

    return docs.mapInPandas(rows, BLOCK)


def encode_words(words: DataFrame, tokenizer_path: str) -> DataFrame:
    """words: (word, place: block and position in it), equal words in one partition, one after the other. Gives (block, pos, n,
    ids): positions, numbers of ids and ids of many words."""

    def packed(found: list[tuple[np.ndarray, np.ndarray, list[list[int]], np.ndarray]]) -> Iterator[pd.DataFrame]:
        block, pos = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
        first = np.cumsum([0, *(len(x[2]) for x in found)])
        which = np.concatenate([x[3] + base for x, base in zip(found, first.tolist(), strict=False)])
        size = np.array([len(ids) for x in found for ids in x[2]], np.int64)
        flat = np.array([i for x in found for ids in x[2] for i in ids], np.uint32)
        start = np.cumsum(size) - size
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[order])) + 1
        for own in np.split(order, cuts):
            of = which[own]
            coded = [squeezed(x) for x in (pos[own], size[of], gather_array(flat, start, size, of))]
            yield pd.DataFrame({"block": block[own[:1]], "pos": [coded[0]], "n": [coded[1]], "ids": [coded[2]]})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, found, held, last = pieces_of(tokenizer_path), [], 0, None
        for pdf in batches:
            words = pdf["word"].to_numpy()
            new = np.concatenate([[True], words[1:] != words[:-1]])
            distinct = words[new].tolist()
            known = [last[1]] if last and distinct[0] == last[0] else []  # goes on from the batch before
            ids = known + pieces.encode(distinct[len(known) :])
            last = distinct[-1], ids[-1]
            place = pdf["place"].to_numpy()
            found.append((place >> PLACE_BITS, place & (1 << PLACE_BITS) - 1, ids, np.cumsum(new) - 1))
            held += len(pdf)
            if held >= PACKED_WORDS:
                yield from packed(found)
                found, held = [], 0
        if found:
            yield from packed(found)
        del found
        trim()

    return words.mapInPandas(encode, "block long, pos binary, n binary, ids binary")


def _placed(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The blocks of the documents with the ids of their words. The blocks lie in buckets, so only words and ids are shuffled."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = stored_in_buckets(blocks(id_text(docs), tokenizer_path), "word_blocks", "block", n)
    listed = cut.select("block", F.posexplode("words").alias("pos", "word")).select("word", (F.shiftleft("block", PLACE_BITS) + F.col("pos")).alias("place"))
    coded = encode_words(listed.repartition("word").sortWithinPartitions("word"), tokenizer_path)
    joined = coded.repartition(n, "block").groupBy("block").agg(F.collect_list(F.struct("pos", "n", "ids")).alias("coded"))
    return cut.select("block", "n", "doc_ids", "sizes", "codes").join(joined.hint("merge"), "block", "left")


def _of_documents(docs: DataFrame, tokenizer_path: str, row: Row, schema: str) -> DataFrame:
    """What ``row`` makes of each document's ids, in the task that has put them together."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = piece_table(tokenizer_path)
        for pdf in batches:
            for n, doc_ids, sizes, codes, coded in zip(pdf["n"].tolist(), pdf["doc_ids"], pdf["sizes"], pdf["codes"], pdf["coded"], strict=True):
                numbers, none = np.frombuffer(doc_ids, "<i8", n).tolist(), np.frombuffer(doc_ids, np.uint8, n, 8 * n).tolist()
                parts = [[unsqueezed(x[k]) for k in ("pos", "n", "ids")] for x in ([] if coded is None else coded)]
                pos, count, flat = (np.concatenate([p[k] for p in parts] or [np.zeros(0, np.uint32)]) for k in range(3))
                size, start = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
                size[pos], start[pos] = count, np.cumsum(count, dtype=np.int64) - count
                codes, ends = unsqueezed(codes), np.cumsum(unsqueezed(sizes), dtype=np.int64).tolist()
                starts = [0, *ends[:-1]]
                for at in range(0, n, 2000):
                    some = slice(at, at + 2000)
                    made = [row(gather_array(flat, start, size, codes[a:b]), pieces) for a, b in zip(starts[some], ends[some], strict=True)]
                    yield _frame([None if x else i for i, x in zip(numbers[some], none[some], strict=True)], made, schema)
                del parts, pos, count, flat, codes
        trim()

    return _placed(docs, tokenizer_path).mapInPandas(rows, schema)


def _frame(doc_ids: list, made: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64")} | {c.split()[0]: [m[k] for m in made] for k, c in enumerate(schema.split(", ")[1:])})


def _of_ids(encoded: DataFrame, tokenizer_path: str, row: Row, schema: str) -> DataFrame:
    """What ``row`` makes of the ids of rows (doc_id, ids)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = piece_table(tokenizer_path)
        for pdf in batches:
            yield _frame(pdf["doc_id"].astype("Int64").tolist(), [row(np.frombuffer(x or b"", "<u4"), pieces) for x in pdf["ids"]], schema)

    return encoded.select("doc_id", "ids").mapInPandas(rows, schema)


def _ids(ids: np.ndarray, pieces: PieceTable) -> tuple:
    return (ids.astype("<u4").tobytes(),)


def _text(ids: np.ndarray, pieces: PieceTable) -> tuple:
    return (pieces.decode(ids).decode("utf-8", "replace"),)


def _digest() -> Row:
    decimals: list[tuple] = []

    def row(ids: np.ndarray, pieces: PieceTable) -> tuple:
        if not decimals:
            decimals.append(flatten([b"%d," % i for i in range(len(pieces.pieces))]))
        listed = gather_array(*decimals[0], ids)[:-1].tobytes()
        return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(_text(ids, pieces)[0].encode()).hexdigest()

    return row


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of every row of ``docs`` (doc_id, text)."""
    return _of_documents(docs, tokenizer_path, _ids, ENCODED)


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); bytes that aren't UTF-8 become U+FFFD."""
    return _of_ids(encoded, tokenizer_path, _text, "doc_id long, text string")


def digest(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 of rows (doc_id, ids)."""
    return _of_ids(encoded, tokenizer_path, _digest(), DIGEST)


def encode_and_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The digest of what ``docs`` are encoded to, of every row, without writing the ids down in between."""
    return _of_documents(docs, tokenizer_path, _digest(), DIGEST)
