"""Near-duplicates, repeated strings, top-k and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import near_dups, suffix_dedup, top_k
from tidemark.llm.bwt_merge import merge


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, label long, digest string").repartition(4)


# ---- SuperMinHash


def plain_superminhash(elements, m):
    out = np.full(m, np.inf)
    for e in elements:
        p = list(range(m))
        for j in range(m):
            r = int(near_dups.mix(np.array([(e + (j + 1) * int(near_dups.GOLDEN)) & near_dups.MASK], np.uint64))[0])
            k = j + (((r & 0xFFFFFFFF) * (m - j)) >> 32)
            p[j], p[k] = p[k], p[j]
            out[p[j]] = min(out[p[j]], (r >> 32) / 2**32 + j)
    return out


def test_signatures_are_superminhash():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 30, 400, 0, 1000)]
    for s, found in zip(sets, near_dups.superminhash(sets), strict=True):
        assert (plain_superminhash(s.tolist(), near_dups.REGISTERS) == found).all()


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_groups(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("deal, members, items", [(2048, 512, 200_000), (2048, 4, 200_000), (2048, 512, 600), (2, 3, 200_000)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, deal, members, items):
    monkeypatch.setattr(near_dups, "DEAL_BEYOND", deal)
    monkeypatch.setattr(near_dups, "CHUNK_MEMBERS", members)
    monkeypatch.setattr(near_dups, "CHUNK_ITEMS", items)
    monkeypatch.setattr(near_dups, "CHUNK_PAIRS", 4)
    rng = np.random.default_rng(2)
    vocabulary = [f"t{i}" for i in range(200)]
    rows, i = [], 1
    for _ in range(6):
        base = list(rng.choice(vocabulary, 120))
        for _ in range(int(rng.integers(1, 14))):
            own = list(base)
            for _ in range(int(rng.integers(0, 7))):
                own[rng.integers(0, len(own))] = rng.choice(vocabulary)
            rows.append((i, " ".join(own)))
            i += 1
    common = list(rng.choice(vocabulary, 80))
    for _ in range(25):  # a common passage among other words: many candidates, few links
        rows.append((i, " ".join([*rng.choice(vocabulary, 12), *common, *rng.choice(vocabulary, 12)])))
        i += 1
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "one two"), (904, "ONE  two"), (905, "É é"), (906, "é é"), (907, "a b c d e f"), (908, "w " * 20000), (909, "W " * 9), (910, rows[0][1]), (911, rows[0][1])]
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dups.groups(documents(spark, [*rows, (None, "lost")])).collect()}
    assert out == brute_groups(rows)


def test_long_near_duplicates(spark):
    a = [f"a{i}" for i in range(2804)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:2404] + [f"b{i}" for i in range(400)]))]  # similarity 0.75 exactly
    assert {r["component_id"] for r in near_dups.groups(documents(spark, rows)).collect()} == {1}


@pytest.mark.parametrize("deal", [2048, 0])
def test_recall_of_links_just_over_the_threshold(spark, monkeypatch, deal):
    """Families of pairs around a common passage: pairs at 0.73 to 0.77, other members of a family at about 0.5."""
    monkeypatch.setattr(near_dups, "DEAL_BEYOND", deal)
    rng = np.random.default_rng(5)
    rows, wanted = [], {}
    for family in range(70):
        passage = [f"p{family}x{i}" for i in range(104)]
        for pair in range(10):
            i = len(rows) + 1
            own = [f"q{i}x{k}" for k in range(48)]
            tail = int(rng.integers(19, 24))  # (152 - 4 - tail) / (148 + tail): 0.73 to 0.77
            rows += [(i, " ".join(passage + own)), (i + 1, " ".join((passage + own)[: 152 - tail] + [f"r{i}x{k}" for k in range(tail)]))]
            a, b = (shingle_set(t) for _, t in rows[-2:])
            if 100 * len(a & b) >= 75 * len(a | b):
                wanted[i + 1] = i
    found = {r["doc_id"]: r["component_id"] for r in near_dups.groups(documents(spark, rows)).collect()}
    assert len(wanted) > 300 and sum(found[b] == found[a] for b, a in wanted.items()) >= 0.99 * len(wanted)
    assert {a: c for a, c in found.items() if c != a}.items() <= wanted.items()


def test_near_duplicates_of_odd_tables(spark):
    assert near_dups.groups(documents(spark, [(1, "x")]).limit(0)).count() == 0
    twice = {(r["doc_id"], r["n_shingles"]) for r in near_dups.groups(documents(spark, [(1, "b c"), (1, "a b c d e f"), (2, "b c")])).collect()}
    assert twice == {(1, 2), (2, 1)}
    docs = spark.createDataFrame([(1, "a b", 5, 1.0, "k"), (2, "a b", 6, 2.0, "l")], "doc_id long, text string, n_shingles int, label double, hub string")
    assert sorted(tuple(r) for r in near_dups.groups(docs).select("doc_id", "component_id").collect()) == [(1, 1), (2, 1)]


# ---- repeated strings


def brute_removed(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(b[p : p + length])
        runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("crowd", [2000, 3])
def test_repeats_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3_000)
    rng = np.random.default_rng(7)
    base = ["".join(rng.choice(list("abcdefgh é"), 300)) for _ in range(4)]
    line = "".join(rng.choice(list("pqrstuv"), 97))
    rows = []
    for i in range(50):
        parts = []
        for _ in range(int(rng.integers(1, 4))):
            k = int(rng.integers(0, 7))
            if k == 0:
                parts.append("ab" * int(rng.integers(20, 200)))
            elif k == 1:
                parts.append("".join(rng.choice(list("xyz"), int(rng.integers(10, 200)))))
            elif k == 2:
                parts.append(line)
            else:
                a = int(rng.integers(0, 150))
                parts.append(base[rng.integers(0, 4)][a : a + int(rng.integers(90, 150))])
        rows.append((i, "".join(parts)))
    rows += [(100, None), (101, ""), (102, rows[3][1]), (103, rows[3][1]), (104, "short"), (105, "short"), (106, "q" * 4000), (107, "z" * 100), (108, "z" * 101)]
    out = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove(documents(spark, [*rows, (None, "x")])).collect()}
    assert out == brute_removed(rows)


def test_repeats_of_an_empty_table(spark):
    assert suffix_dedup.remove(documents(spark, [(1, "x")]).limit(0)).count() == 0


def test_merge_is_the_order_of_all_suffixes():
    rng = np.random.default_rng(1)
    for depth in (1, 4, 7, 10, 20):
        shards = [rng.integers(1, 4, int(rng.integers(1, 60))).astype(np.uint8) for _ in range(int(rng.integers(1, 5)))]
        side, position, common = merge(shards, depth)
        found = [bytes(np.resize(np.roll(shards[s], -p), depth)) for s, p in zip(side, position, strict=True)]
        assert found == sorted(found)
        assert sorted(zip(side.tolist(), position.tolist(), strict=True)) == [(s, p) for s, t in enumerate(shards) for p in range(len(t))]
        for a, b, c in zip(found, found[1:], common[1:].tolist(), strict=False):
            shared = next((i for i in range(depth) if a[i] != b[i]), depth)
            assert shared - 4 <= c <= shared and (c == depth) == (shared == depth)


# ---- top-k


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(top_k, "TILE_ROWS", 7)
    monkeypatch.setattr(top_k, "QUERY_ROWS", 2)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=4), 1)]) for i in range(0, 1000, 10)]
    rows += [(5, None), (15, []), (25, [1.0, None, 2.0, 3.0]), (35, [float("nan"), 1.0, 1.0, 1.0]), (45, [float("inf"), 1.0, 1.0, 1.0]), (55, [1.0, 2.0]), (1100, [1.0, 2.0]), (1200, [1e12, 0.0, 0.0, 0.0]), (65, [1e3, 1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    expected = set()
    for q, a in good:
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), c) for c, b in good if c != q and len(b) == len(a))
            expected |= {(q, n, c, -s if -s < 2**63 else None) for n, (s, c) in enumerate(scores[:10], 1)}
    out = {tuple(r) for r in top_k.top_k(df.where("vec_id % 100 = 0"), df, 10, groups=3).select("query_id", "rank", "vec_id", "score").collect()}
    assert out == expected
    assert top_k.top_k(df.limit(0), df.limit(0), 10).count() == 0


def test_top_k_sends_nothing_through_the_driver(spark, monkeypatch, capsys):
    """query blocks, small as a stored file, were broadcast once for each of the groups of tiles."""
    monkeypatch.setattr(top_k, "TILE_ROWS", 16)
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(400, 8)).round(2).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(3)
    out = top_k.top_k(df.where("vec_id % 10 = 0"), df, 5, groups=50)
    assert out.count() == 40 * 5
    out.explain()
    plan = capsys.readouterr().out
    assert "Window" in plan
    assert "Broadcast" not in plan


def test_top_k_of_equal_scores_and_of_all_rows(spark, monkeypatch):
    """Many more ties than places, ids falling from tile to tile, lengths mixed in a pack, every row a query in a grid of several
    groups of blocks and of tiles; scores in single floats and in doubles."""
    monkeypatch.setattr(top_k, "TILE_ROWS", 8)
    monkeypatch.setattr(top_k, "QUERY_ROWS", 8)
    monkeypatch.setattr(top_k, "CHUNK", 3)
    monkeypatch.setattr(top_k, "FIRST", 2)
    monkeypatch.setattr(top_k, "WAITING", 1)
    rng = np.random.default_rng(9)
    made = []
    for i in range(150, 0, -1):
        dim = 3 if i % 3 else 2
        made.append((i, [1.0] * dim if i % 2 else [float(x) for x in rng.choice([0.25, 0.5, 900.5], dim)]))
    made += [(7, [0.25, 0.5, 0.5]), (9, [1.0, 1.0])]  # repeated ids: 7 with another vector of its length, 9 with the same
    df = spark.createDataFrame(made, "vec_id long, embedding array<double>").repartition(2)
    monkeypatch.setattr(top_k, "grid", lambda *_: (3, 4))
    out = {tuple(r) for r in top_k.top_k(df, df, 4).select("query_id", "rank", "vec_id", "score").collect()}
    rows = [(i, [math.floor(1024 * x) for x in v]) for i, v in made]
    expected = set()
    for q in {i for i, _ in rows}:
        a = min(v for i, v in rows if i == q)
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), c) for c, b in rows if c != q and len(b) == len(a))
        expected |= {(q, n, c, -s) for n, (s, c) in enumerate(scores[:4], 1)}
    assert out == expected


def test_top_k_grid_sends_in_proportion():
    """At any size with one query in a hundred rows, what is sent to cells stays within a few times the tiles' bytes, a cell's
    tiles within what a task may hold, and no partition asked for is left out where little is sent."""
    for rows in (50_000, 7_500_000, 22_000_000, 110_000_000, 1_000_000_000):
        queries, parts = rows // 100, max(12, rows * 256 // 10_000_000)
        tiles, blocks, sent = -(-rows // 4096), -(-queries // 2048), queries * (128 + 240)
        down, across = top_k.grid(parts, tiles, rows * 128, blocks, sent)
        assert across <= tiles
        assert down <= blocks
        assert down * across >= min(parts, tiles, 50)
        assert rows * 128 / across <= max(top_k.GROUP_BYTES, 128 * 4096)
        if rows <= 22_000_000:
            assert rows * 128 * down + sent * across <= 4 * rows * 128
    assert top_k.grid(200, 0, 0, 0, 0) == (1, 1)


# ---- the pipeline


def test_pipeline(spark, sf):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, sf)
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert after.keys() <= before.keys()
        if name == "near_dedup":
            assert set(after) == {i for i, g in brute_groups(list(before.items())).items() if g[2]}
        if name == "suffix_dedup":
            gone = brute_removed(list(before.items()))
            assert after.keys() == before.keys()
            assert all((after[i] == before[i]) == (gone[i][1] == 0) for i in before)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    out = pipeline.STAGES[-1][1](spark, docs, sf)
    assert out.count() == docs.count()
