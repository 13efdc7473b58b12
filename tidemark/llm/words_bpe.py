"""Byte-level BPE by words: the pre-tokenizer's pieces are split off first, and a piece's ids depend on the piece alone."""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
from tokenizers import Tokenizer

# Characters for which the classes below are known to be those of the tokenizer: Latin letters, ASCII, Latin-1 and
# common punctuation. A text with any other character is split by the tokenizer's own pre-tokenizer.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \x85\xa0"
# A space and what follows it are alternatives of their own: the matcher is fastest where each begins with a plain class.
PIECE = re.compile(
    rf" [{LETTERS}]++|[{LETTERS}]++|'(?:s|t|re|ve|m|ll|d)| ?[^{SPACES}{LETTERS}{NUMBERS}]++| ?[{NUMBERS}]++|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
UNUSUAL = re.compile("[^\x00-ɏ‐-‧‰-⁞€]")


def byte_chars() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for characters from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(others)}


class Pieces:
    """Splits a text as the tokenizer does before its merges; special tokens' strings come out as pieces of their own."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens") or []
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer") or any(a.get(k) for a in added for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError("a byte-level BPE tokenizer without normalizer or prefix space is needed")
        self.special = {a["content"]: a["id"] for a in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def plain(self, text: str) -> list[str]:
        if not text.isascii() and UNUSUAL.search(text):
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return PIECE.findall(text)

    def split(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return self.plain(text)
        out: list[str] = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out.extend(self.plain(part))
        return out

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


class PieceTable:
    """Bytes of every id, as one flat array: decoding is a gather."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_chars()
        size = 1 + max([*spec["model"]["vocab"].values(), *(a["id"] for a in spec.get("added_tokens") or [])])
        pieces = [b""] * size
        for token, i in spec["model"]["vocab"].items():
            pieces[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        for a in spec.get("added_tokens") or []:
            pieces[a["id"]] = a["content"].encode()
        self.pieces = pieces
        self.flat, self.start, self.size = flatten(pieces)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.flat, self.start, self.size, ids)


def flatten(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size


def gather_array(flat: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The rows ``which`` of a ragged table, one after the other."""
    n = size[which]
    ends = np.cumsum(n)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(start[which] - (ends - n), n) + np.arange(ends[-1])]


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> bytes:
    return gather_array(flat, start, size, which).tobytes()


class WordCache:
    """Ids of pieces, each encoded when first met. Two generations of ``limit`` entries at most: when the young one is full
    it becomes the old one, and what is met again comes back from there, so memory is bounded and frequent words stay."""

    def __init__(self, pieces: Pieces, limit: int = 800_000):
        self.pieces, self.limit = pieces, limit
        self.codes: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.codes) > self.limit:
            self.old, self.codes = self.codes, {}
        known = words & self.old.keys()
        self.codes.update((w, self.old[w]) for w in known)
        new = list(words - known)
        for w, ids in zip(new, self.pieces.encode(new), strict=True):
            self.codes[w] = np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Little-endian unsigned 32-bit ids."""
        words = self.pieces.split(text)
        try:
            return np.frombuffer(b"".join(map(self.codes.__getitem__, words)), "<u4")
        except KeyError:
            self.learn(set(words).difference(self.codes))
            if not self.codes.keys() >= set(words):  # the generation has changed meanwhile
                self.learn(set(words).difference(self.codes))
            return np.frombuffer(b"".join(map(self.codes.__getitem__, words)), "<u4")


@functools.cache
def word_cache(path: str) -> WordCache:
    """One a Python worker: it outlives a task."""
    return WordCache(pieces_of(path))


@functools.cache
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


@functools.cache
def piece_table(path: str) -> PieceTable:
    return PieceTable(path)
