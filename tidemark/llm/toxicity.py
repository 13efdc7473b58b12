"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes.

``fit`` learns from a bounded sample of labelled documents (``EXAMPLES`` of each class at most, those of the smallest
hashes of doc_id). Features are words and their beginnings of 3 to 6 letters, so a slur is known in its inflected forms;
they are known by 64-bit hashes. Every feature of an example is indexed: the vector space is that of the examples' features. A
feature's weight is its inverse document frequency over all documents times 1 + its chi-square on the examples' labels.

``score`` looks documents up, ``TOGETHER`` at a time. Postings of features that few examples hold are summed one by one.
For the common ones (more than 1 in ``COMMON`` examples) the largest weight in each block of ``BLOCK`` examples bounds what
they can add; a block whose bound can't reach a document's K nearest is skipped, and the others are finished by a product
of the documents' and the block's weights. Cosines are rounded to 6 places: examples at 0 aren't neighbours, and
of equal ones the earlier example goes first. The vote is the similarity-weighted share of toxic neighbours, shrunk by one neighbour at
cosine ``SHRINK`` that votes the base rate; a monotone map, fitted on leave-one-out votes of the examples weighted to the
classes' true shares, makes it a probability. Evidence: the neighbours' doc_ids and cosines.

Null or empty text, or one without a known feature: no neighbours, scored as such examples turned out. Labels that are
null are ignored; a doc_id labelled twice counts as toxic if one label says so. Without labels of both classes every score
is 0 or the one class's label. A null doc_id is scored too, and is not held out. A row a document, repeated rows included;
empty tables give no rows; other columns (also label-like ones) are never read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, sliced, stored, trim

EXAMPLES = 2000
K, BLOCK, COMMON, SHRINK = 5, 64, 20, 0.05
#: Documents, and about how many characters of them, that are looked up together.
TOGETHER, PART_CHARS = 384, 400_000

U = np.uint64
#: An odd number, so it has an inverse modulo 2 ** 64: a word's hash is a polynomial of its letters in it.
RADIX = 0x9E3779B97F4A7C15
BEGINNINGS = (3, 4, 5, 6)
Counts = tuple[np.ndarray, np.ndarray]


@functools.cache
def letter_table() -> np.ndarray:
    """Of every character whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@functools.lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """RADIX ** i and its inverse, for i under n."""
    out = []
    for radix in (RADIX, pow(RADIX, -1, 1 << 64)):
        x = np.full(n, U(radix))
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, as signed numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return (x ^ (x >> U(31))).view(np.int64)


class Words:
    """The words of some texts: which text each is in, and a number of its own for each distinct one."""

    def __init__(self, texts: list[str]):
        lower = [t.lower() for t in texts]
        chars = np.frombuffer(" ".join([*lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.letters = np.concatenate([[False], letter_table()[chars], [False]])
        first = np.flatnonzero(~self.letters[:-1] & self.letters[1:])  # places in chars
        self.size = np.flatnonzero(self.letters[:-1] & ~self.letters[1:]) - first
        room = 1 << max(19, int(len(chars)).bit_length())
        up, self.down = powers(room)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((chars.astype(np.uint64) + U(1)) * up[: len(chars)])])
        self.text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(first, np.cumsum([0, *(len(t) + 1 for t in lower)]))))
        whole = self.hashes(first, self.size, 0)
        self.hash, at, self.number = np.unique(whole, return_index=True, return_inverse=True)
        self.first, self.size = first[at], self.size[at]

    def hashes(self, first: np.ndarray, size: np.ndarray | int, kind: int) -> np.ndarray:
        return mixed((self.sums[first + size] - self.sums[first]) * self.down[first] + U(kind * RADIX & (1 << 64) - 1))

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(number of the distinct word, feature): the word itself and its beginnings."""
        number, found = [np.arange(len(self.hash))], [self.hash]
        for n in BEGINNINGS:
            long = np.flatnonzero(self.size >= n)
            number.append(long)
            found.append(self.hashes(self.first[long], n, n))
        return np.concatenate(number), np.concatenate(found)


def grouped(text: np.ndarray, of: np.ndarray, n: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of n by (text, of), in that order."""
    key = text * width + of
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first] // width, key[first] % width, np.add.reduceat(n[order], first) if len(first) else n[:0]


def expanded(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... of n[i] places for each i."""
    return np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)


def feature_counts(texts: list[str], vocabulary: np.ndarray) -> list[Counts]:
    """Of each text the features that the ascending vocabulary holds, as places in it, ascending, and how often each occurs."""
    none = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(texts)
    words = Words(texts)
    if not len(words.text) or not len(vocabulary):
        return none
    number, feature = words.features()
    order = np.argsort(feature)  # neighbours are looked up near each other
    number, feature = number[order], feature[order]
    place = np.minimum(np.searchsorted(vocabulary, feature), len(vocabulary) - 1)
    known = vocabulary[place] == feature
    number, place = number[known], place[known]
    order = np.argsort(number)
    place, of_word = place[order], np.bincount(number, minlength=len(words.hash))
    start = np.cumsum(of_word) - of_word
    text, word, n = grouped(words.text, words.number, np.ones(len(words.text), np.int64), len(words.hash))
    each = of_word[word]
    text, of, n = grouped(np.repeat(text, each), place[expanded(start[word], each)], np.repeat(n, each), len(vocabulary))
    cuts = np.searchsorted(text, np.arange(1, len(texts)))
    return list(zip(np.split(of, cuts), np.split(n, cuts), strict=True))


@dataclass
class Model:
    """Bounded by the texts of the examples, whatever the corpus."""

    vocabulary: np.ndarray
    weights: np.ndarray
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    base: float = 0.0
    #: Postings by feature: owner and weight from start[f] to start[f + 1].
    start: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    owner: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    #: Numbers of the common features (-1: others), and each one's largest weight in each block.
    common: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    block_max: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    votes: np.ndarray = field(default_factory=lambda: np.zeros(1))
    rates: np.ndarray = field(default_factory=lambda: np.zeros(1))
    none_rate: float = 0.0

    def vector(self, counts: Counts) -> Counts:
        of, n = counts
        w = (1 + np.log(n)) * self.weights[of]
        length = np.sqrt((w * w).sum())
        return (of, w / length) if length else (of[:0], w[:0])

    def index(self, vectors: list[Counts]) -> None:
        owner = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(f) for f, _ in vectors])
        of = np.concatenate([f for f, _ in vectors] or [np.zeros(0, np.int32)])
        w = np.concatenate([w.astype(np.float32) for _, w in vectors] or [np.zeros(0, np.float32)])
        size = np.bincount(of, minlength=len(self.vocabulary))
        common = np.flatnonzero(size * COMMON > len(vectors))
        self.common = np.full(len(self.vocabulary), -1, np.int32)
        self.common[common] = np.arange(len(common))
        self.block_max = np.zeros((len(common), -(-len(vectors) // BLOCK)), np.float32)
        held = self.common[of] >= 0
        np.maximum.at(self.block_max, (self.common[of[held]], owner[held] // BLOCK), w[held])
        order = np.argsort(of, kind="stable")
        self.owner, self.weight = owner[order], w[order]
        self.start = np.concatenate([[0], np.cumsum(size)])

    @functools.cached_property
    def table(self) -> np.ndarray:
        """The common features' weights in every example; made where it is used, it isn't sent."""
        out = np.zeros((len(self.ids), len(self.block_max)), np.float32)
        for f in np.flatnonzero(self.common >= 0):
            at = slice(self.start[f], self.start[f + 1])
            out[self.owner[at], self.common[f]] = self.weight[at]
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "table"}

    def rare_sums(self, of: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Each example's part of the cosine from these features."""
        n = self.start[of + 1] - self.start[of]
        at = expanded(self.start[of], n)
        return np.bincount(self.owner[at], self.weight[at] * np.repeat(w, n), minlength=len(self.ids))

    def nearest(self, vectors: list[Counts], but: np.ndarray | None = None) -> list[Counts]:
        """For each vector the K examples of the largest cosine over 0, ties to the earlier; ``but`` are left out."""
        if not len(vectors) or not len(self.ids):
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(vectors)
        query = np.zeros((len(vectors), len(self.block_max)), np.float32)
        score = np.zeros((len(vectors), len(self.ids)), np.float32)
        for i, (of, w) in enumerate(vectors):
            common = self.common[of]
            held = common >= 0
            query[i, common[held]] = w[held]
            score[i] = self.rare_sums(of[~held], w[~held])
        if but is not None:
            score[np.arange(len(vectors)), but] = -1
        starts = np.arange(0, len(self.ids), BLOCK)
        bound = np.maximum.reduceat(score, starts, axis=1) + query @ self.block_max + np.float32(1e-5)
        k = min(K, len(self.ids))
        kth = lambda: np.partition(score, -k, axis=1)[:, -k]
        # what the common features add is not negative: the K-th sum so far is one that the nearest reach
        least = kth()
        for turn, b in enumerate(np.argsort(-bound.sum(0))):
            if turn == len(starts) // 4:
                least = kth()
            rows = np.flatnonzero(bound[:, b] >= least)
            block = slice(starts[b], starts[b] + BLOCK)
            score[rows, block] += query[rows] @ self.table[block].T
        if but is not None:
            score[np.arange(len(vectors)), but] = -1
        least, out = kth(), []
        for i in range(len(vectors)):
            found = np.flatnonzero(score[i] >= max(least[i] - 1e-6, 5e-7))
            cosine = np.round(np.minimum(score[i, found].astype(float), 1.0), 6)
            best = np.lexsort((found, -cosine))[:K]
            out.append((found[best], cosine[best]))
        return out

    def vote(self, found: np.ndarray, cosine: np.ndarray) -> float:
        return float(((cosine * self.toxic[found]).sum() + SHRINK * self.base) / (cosine.sum() + SHRINK))

    def calibrate(self, vectors: list[Counts], weight: np.ndarray) -> None:
        """Pool adjacent violators on leave-one-out votes."""
        near = [x for at in range(0, len(vectors), TOGETHER) for x in self.nearest(vectors[at : at + TOGETHER], np.arange(at, min(at + TOGETHER, len(vectors))))]
        none = np.array([not len(f) for f, _ in near])
        self.none_rate = float(np.average(self.toxic[none], weights=weight[none])) if none.any() else self.base
        votes = np.array([self.vote(*x) for x in near])[~none]
        y, w = self.toxic[~none], weight[~none]
        pools: list[list[float]] = []
        for i in np.argsort(votes, kind="stable"):
            pools.append([votes[i], votes[i], w[i] * y[i], w[i]])
            while len(pools) > 1 and (pools[-2][1] == pools[-1][0] or pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]):
                last = pools.pop()
                pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
        if pools:
            self.votes = np.array([x for p in pools for x in p[:2]])
            self.rates = np.array([r for p in pools for r in [(p[2] + self.base) / (p[3] + 1)] * 2])

    def scores(self, counts: list[Counts]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Score, neighbours and cosines of each text."""
        out = []
        for at in range(0, len(counts), TOGETHER):
            for found, cosine in self.nearest([self.vector(c) for c in counts[at : at + TOGETHER]]):
                known = float(np.clip(np.interp(self.vote(found, cosine), self.votes, self.rates), 0, 1)) if len(found) else self.none_rate
                out.append((known, found, cosine))
        return out


def parts(texts: pd.Series) -> Iterator[list[str]]:
    """At most TOGETHER texts, or so many that they have PART_CHARS characters."""
    held, chars = [], 0
    for t in texts:
        held.append(t or "")
        chars += len(held[-1])
        if len(held) == TOGETHER or chars >= PART_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled documents: docs (doc_id, text), labels (doc_id, toxic)."""
    texts = id_text(docs)
    marked = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marked = marked.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    marked = stored(marked, "labels")
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().where("toxic in (0, 1)").collect()}
    total = sum(sizes.values())
    base = sizes.get(1, 0) / total if total else 0.0
    if len(sizes) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0), base=base, none_rate=base)
    order = F.xxhash64("doc_id")
    chosen = marked.where("toxic = 1").orderBy(order, "doc_id").limit(EXAMPLES).unionByName(marked.where("toxic = 0").orderBy(order, "doc_id").limit(EXAMPLES))
    examples = stored(texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).repartition(16, "doc_id"), "examples")

    def by_feature(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            toxic = pdf["toxic"].to_numpy()
            words = Words(pdf["text"].tolist())
            number, feature = words.features()
            feature, of = np.unique(feature, return_inverse=True)
            order = np.argsort(number)
            of, each = of[order], np.bincount(number, minlength=len(words.hash))
            text, word, _ = grouped(words.text, words.number, np.ones(len(words.text), np.int64), len(words.hash))
            text, of, _ = grouped(np.repeat(text, each[word]), of[expanded((np.cumsum(each) - each)[word], each[word])], np.repeat(text, each[word]), max(1, len(feature)))
            n, pos = np.bincount(of, minlength=len(feature)), np.bincount(of[toxic[text] == 1], minlength=len(feature))
            yield from sliced(pd.DataFrame({"feature": feature, "n": n, "pos": pos}))

    n = {r["toxic"]: float(r["count"]) for r in examples.groupBy("toxic").count().collect()}
    pos_all, all_ = n.get(1, 0.0), sum(n.values())
    table = examples.mapInPandas(by_feature, "feature long, n long, pos long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).toArrow()
    vocabulary, n_of, a = table["feature"].to_numpy(), table["n"].to_numpy().astype(float), table["pos"].to_numpy().astype(float)
    if not len(vocabulary):
        return Model(np.zeros(0, np.int64), np.zeros(0), base=base, none_rate=base)
    order = np.argsort(vocabulary)
    vocabulary, n_of, a = vocabulary[order], n_of[order], a[order]
    b = n_of - a
    c, d = pos_all - a, (all_ - pos_all) - b
    below = (a + b) * (c + d) * (a + c) * (b + d)
    chi2 = np.divide(all_ * (a * d - b * c) ** 2, below, out=np.zeros(len(below)), where=below > 0)
    names = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, df = 0, np.zeros(len(names.value), np.int64)
        for pdf in batches:
            for part in parts(pdf["text"]):
                np.add.at(df, np.concatenate([f for f, _ in feature_counts(part, names.value)]), 1)
            rows += len(pdf)
        trim()
        met = np.flatnonzero(df)
        yield pd.DataFrame({"feature": [-1], "n": [rows]})
        yield from sliced(pd.DataFrame({"feature": met, "n": df[met]}))

    table = texts.select("text").mapInPandas(frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(vocabulary) + 1)
    df[table["feature"].to_numpy()] = table["n"].to_numpy()  # the last one: all rows
    idf = np.log((1 + df[-1]) / (1 + df[:-1]))

    def example_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            counts = [c for part in parts(pdf["text"]) for c in feature_counts(part, names.value)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"], "feature": [f.astype(np.int32) for f, _ in counts], "n": [n.astype(np.int32) for _, n in counts]})

    rows = examples.mapInPandas(example_counts, "doc_id long, toxic int, feature array<int>, n array<int>").toArrow()
    model = Model(vocabulary, idf * (1 + chi2), base=base)
    vectors = [model.vector((f.values.to_numpy(), n.values.to_numpy())) for f, n in zip(rows["feature"], rows["n"], strict=True)]
    ids, toxic = rows["doc_id"].to_numpy(), rows["toxic"].to_numpy()
    del rows, table
    # examples of like leading feature stand together, so that blocks are tight
    order = sorted(range(len(vectors)), key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]) if len(vectors[i][0]) else -1, ids[i]))
    vectors = [vectors[i] for i in order]
    model.ids, model.toxic = ids[order], toxic[order].astype(float)
    model.index(vectors)
    share = np.where(model.toxic == 1, sizes[1] / pos_all, sizes[0] / (all_ - pos_all))
    model.calibrate(vectors, share / share.mean())
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted, neighbours, cosines of every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = held.value
        for pdf in batches:
            found = [x for part in parts(pdf["text"]) for x in model.scores(feature_counts(part, model.vocabulary))]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"), "score": [s for s, _, _ in found], "predicted": [int(s >= 0.5) for s, _, _ in found],
                "neighbours": [model.ids[f].tolist() for _, f, _ in found], "cosines": [c.tolist() for _, _, c in found],
            })
        trim()

    return id_text(docs).mapInPandas(rows, "doc_id long, score double, predicted int, neighbours array<long>, cosines array<double>")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, their columns untouched."""
    model = fit(docs, labels.where(~held_out()))
    columns = docs.columns
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = held.value
        for texts in batches:
            yield pd.Series([s >= 0.5 for part in parts(texts) for s, _, _ in model.scores(feature_counts(part, model.vocabulary))], dtype=bool)
        trim()

    return docs.where(~toxic(F.col("text"))).select(*[docs[c] for c in columns])
