"""The prefix trie, quality rules and hard negatives against plain loops; operators side by side in one driver."""

from __future__ import annotations

import hashlib
import re
import threading
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat_format, hard_negatives, near_dups, prefix_trie, quality
from tidemark.operators import scans

# ---- quality rules


def plain_figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    again = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


PROSE = "The river ran low that summer, and the boats stayed at the quay. Nobody minded much; there was other work to do in town."
TEXTS = [
    None, "", " \n\t ", "one two", "a b c a b c", "a a a a", "\n".join([PROSE] * 3), "x y z\r\nx y z\nx y z", "é ü ß   end. 😀😀 #*$", PROSE * 4,
    "word " * 60, "a#b$ c% d& |e| <f> *g*\n" * 3, "\x1c\x1d a\x0bb\x0cc", "tail\n", "\n\n" + PROSE,
]


def judged(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "kept", 7) for i, t in enumerate(texts)], "doc_id long, text string, kept string, n_words int").repartition(3)
    return {r["doc_id"]: r for r in quality.judge(df, **kw).collect()}


def test_base_figures_equal_plain_loops(spark):
    rng = np.random.default_rng(1)
    long = " ".join(rng.choice(["a", "b", "c", "dd", "e\n", "#", "f."], 40_000))
    texts = [*TEXTS, long, " ".join(f"w{i}" for i in range(60_000))]
    found = judged(spark, texts)
    for i, t in enumerate(texts[:-2]):
        assert tuple(found[i])[1:6] == plain_figures(t), t
    assert tuple(found[len(texts) - 2])[1:6] == (*plain_figures(long)[:3], found[len(texts) - 2]["n_dup_lines"], plain_figures(long)[4])
    assert found[len(texts) - 1]["n_repeat_words"] == 0 and found[len(texts) - 1]["n_words"] == 60_000
    for r in found.values():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


@pytest.mark.parametrize("line, fault", [
    ("Home | About | Contact | Help", "navigation"), ("Home > Shop > Shoes and boots and more", "navigation"), ("Contact us", "navigation"), ("Yes.", None), ("He left.", None),
    ("THIS!! IS!! LOUD!! AND!! LONG!! ENOUGH!! TO!! SEE!!", "punctuation"), ("word%%% other&&& third*** more### again$$$ end", "punctuation"), ("five words without any mark", "punctuation"),
    ("a list of things that someone wrote down without a mark", None), ("Copyright 2020. All rights reserved.", "boilerplate"), ("Click here to read the whole story.", "boilerplate"),
    (PROSE, None), (PROSE + " He would click here and there, " + PROSE, None), ("Wirklich? Ja, so war es.", None), ("他说今天下雨了。", None), ("if a < b || c > d { return; }", None),
])
def test_line_rules(line, fault):
    assert quality.fault(line) == fault


def test_documents_that_lose_too_much_go(spark):
    line = lambda i: " ".join(f"{w}{i}" for w in ("river", "boat", "quay", "town", "summer", "work", "people", "morning")) + f", or so they say{i}."
    prose, more = "\n".join(line(i) for i in range(9)), "\n".join(line(i) for i in range(9, 18))
    bars = "\n".join(f"Home{i} | News{i} | Sport{i} | Shop{i} | Help{i} | About{i}" for i in range(30))
    some = prose + "\nHome | News | Help | About\n" + more
    found = judged(spark, [prose, prose + "\n" + bars, bars, some, None], keep_text=True)
    assert [found[i]["kept"] for i in range(5)] == [True, False, False, True, False]
    assert found[0]["cleaned"] == prose and "Home" not in found[3]["cleaned"] and found[3]["cleaned"].count("\n") == some.count("\n") - 1
    assert found[3]["lost_chars"] == len("Home|News|Help|About")


def test_quality_of_odd_tables(spark):
    df = spark.createDataFrame([(None, PROSE), (1, PROSE), (1, PROSE)], "doc_id long, text string")
    assert [r["doc_id"] for r in quality.judge(df).orderBy("doc_id").collect()] == [None, 1, 1]
    assert quality.judge(df.limit(0)).count() == 0 and quality.clean(df).columns == ["doc_id", "text"]


# ---- prefix trie


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own[c].append((role or "", text or ""))
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, of in members.items():
        under = [x for x in members if x[: len(node)] == node]
        children = [x for x in under if len(x) == len(node) + 1]
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in under) for x in under)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x)
        ends = ",".join(map(str, sorted(c for c in of if len(built[c]) == len(node))))
        out.append((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_of(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, n long").repartition(5)
    return sorted((tuple(r) for r in prefix_trie.trie(df).collect()), key=repr)


def talks(rng, n, first):
    rows = []
    for c in range(first, first + n):
        shared = rng.integers(0, 3)
        for t in range(int(rng.integers(0, 12))):
            common = t < 4 and rng.random() < 0.8
            rows.append((c, None if t == 0 and rng.random() < 0.2 else t, ("user", "assistant", None)[t % 3] if rng.random() < 0.9 else "", f"s{shared}é t{t}" if common else None if rng.random() < 0.1 else f"c{c} t{t}"))
    return rows


@pytest.mark.parametrize("bits", [12, 1])
def test_trie_equals_plain_loops(spark, monkeypatch, bits):
    monkeypatch.setattr(prefix_trie, "DEPTH_BITS", bits)
    monkeypatch.setattr(prefix_trie, "ID_BITS", bits)
    rng = np.random.default_rng(4)
    rows = talks(rng, 60, 0) + talks(rng, 12, -7) + talks(rng, 9, 2**40)
    rows += [(500, t, "user", f"copy {t}") for t in range(9)] + [(c, t, "user", f"copy {t}") for c in range(505, 700, 5) for t in range(9)]  # copies
    rows += [(c, t, "user", f"snap {t}") for c in range(800, 900, 5) for t in range((c - 800) // 5 + 1)]  # each one longer than the last
    rows += [(1000, t, "user", "again") for t in (3, 3, 3, None, None)] + [(1000, 3, "user", "again"), (None, 1, "user", "lost"), (1003, 1, "u", "only")]
    assert trie_of(spark, rows) == plain_trie(rows)


def test_trie_of_a_long_conversation_and_of_none(spark):
    rows = [(5, t, "user", f"{t}") for t in range(700)] + [(10, t, "user", f"{t}" if t < 500 else f"other {t}") for t in range(700)]
    found = trie_of(spark, rows)
    assert len(found) == 701 + 200 and max(r[1] for r in found) == 700
    assert [r for r in found if r[1] == 0][0][:6] == (5, 0, None, 2, 1, 2)
    assert [r[4] for r in found if r[1] == 500] == [2]
    assert prefix_trie.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")).count() == 0


# ---- hard negatives


def plain_negatives(rows, anchors=100):
    use = [(i, la, np.floor(256 * np.array(x, np.float64)).astype(object)) for i, x, la in rows if i is not None and la is not None and x is not None and all(v is not None and np.isfinite(v) for v in x)]
    use = [(i, la, [int(v) for v in x]) for i, la, x in use]
    out = []
    firsts = {}
    for i, la, x in sorted(use, key=lambda r: (r[0], r[1])):
        if i % anchors == 0:
            firsts.setdefault(i, (la, x))
    for a, (la, x) in firsts.items():
        scored = sorted(((-sum(p * q for p, q in zip(x, y, strict=True)), i, lb) for i, lb, y in use if i != a and len(y) == len(x)), key=lambda r: r[:2])
        scored = [(s, i, lb) for s, i, lb in scored if abs(100 * s) < 2**63]
        for ps, p in [(-s, i) for s, i, lb in scored if lb == la][:5]:
            fit = [(-s, i) for s, i, lb in scored if lb != la and 30 * ps <= -100 * s <= 90 * ps][:10]
            out += [(a, p, rank, i, ps, s) for rank, (s, i) in enumerate(fit, 1)]
    return sorted(out)


def negatives_of(spark, rows, anchors=100):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"n": F.lit("x"), "rank": F.lit(1), "items": F.lit(0)}).repartition(5)
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % anchors == 0).collect())


@pytest.mark.parametrize("tile, block, chunk, group", [(2048, 512, 128, 64), (7, 3, 2, 2)])
def test_negatives_equal_plain_loops(spark, monkeypatch, tile, block, chunk, group):
    for name, value in (("TILE_ROWS", tile), ("BLOCK_ROWS", block), ("CHUNK", chunk), ("GROUP_TILES", group)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 0.4, (6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.15, 8)).tolist(), int(rng.integers(0, 4))) for i in range(500)]
    rows += [(i, rows[3][1], 1) for i in range(500, 640)]  # a large group of one vector
    rows += [(i, [float(np.round(v)) for v in rng.normal(0, 0.6, 3)], int(i % 2)) for i in range(640, 760)]  # another length, many ties
    rows += [(900, None, 1), (901, [None] * 8, 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] + [0.0] * 7, 2), (904, [0.1] * 8, None), (None, [0.1] * 8, 1)]
    rows += [(1000, [0.0] * 8, 1), (1001, [0.0] * 8, 2), (1100, [-0.1] * 8, 3), rows[5], rows[100], (100, [0.2] * 8, 0), (1200, [], 1), (1201, [], 1), (1202, [], 2)]
    wanted = plain_negatives(rows, 20)
    assert negatives_of(spark, rows, 20) == wanted and len(wanted) > 500


def test_negatives_of_huge_components_and_empty_tables(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(0, 1, 4) * 10.0 ** (3 * (i % 6))).tolist(), i % 2) for i in range(60)]
    assert negatives_of(spark, rows, 10) == plain_negatives(rows, 10)
    rows = [(i, [1e12 + i, 1e7], i % 2) for i in range(20)]  # no score fits a long
    assert negatives_of(spark, rows, 10) == plain_negatives(rows, 10) == []
    assert negatives_of(spark, [(1, [0.1], 1)], 10) == []
    assert hard_negatives.mine(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), F.col("vec_id") % 100 == 0).count() == 0


def test_pivots_leave_rows_out_and_lose_none():
    """Clustered rows: most are never multiplied, and the lists are those of all products."""
    rng = np.random.default_rng(9)
    centre = rng.normal(0, 200, 16)
    items = np.floor(np.r_[centre + rng.normal(0, 4, (300, 16)), -centre + rng.normal(0, 4, (700, 16))])
    q = np.floor(centre + rng.normal(0, 4, (5, 16)))
    m2 = float((items**2).sum(axis=1).max()) + 1
    pivots = items[[0, 500]]
    rest = lambda x: np.sqrt(np.maximum(m2 - (x**2).sum(axis=1), 0))
    away = lambda x, r: np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] + r[:, None] ** 2 + m2 - 2 * (x @ pivots.T + r[:, None] * rest(pivots)), 0))
    d, dq = away(items, rest(items)), away(q, np.zeros(5))
    tile = {"m2": m2, "ids": np.arange(1000), "items": items, "dists": d, "lo": d.min(axis=0), "hi": d.max(axis=0)}
    block = {"ids": np.full(5, -1), "items": q, "dists": dq, "q2": (q**2).sum(axis=1)}
    bands = np.tile(np.array([[1000, 2**60]]), (5, 1, 1))
    seen, before = [], hard_negatives.exact
    hard_negatives.exact = lambda a, b: (seen.append(len(b)), before(a, b))[1]
    try:
        lists = hard_negatives.Lists(bands, 10)
        hard_negatives.meet(block, tile, lists)
    finally:
        hard_negatives.exact = before
    scores = (q @ items.T).astype(int)
    wanted = [(a, s, i) for a in range(5) for s, i in sorted(((scores[a, i], i) for i in range(1000) if scores[a, i] >= 1000), key=lambda x: (-x[0], x[1]))[:10]]
    assert list(zip(lists.owner, lists.score, lists.id, strict=True)) == wanted
    assert sum(seen) <= 300


# ---- two operators at once


def test_operators_in_two_threads_keep_their_tables(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7} of some words and then {i % 3} more words to tell", 1) for i in range(60)], "doc_id long, text string, label int")
    talk = spark.createDataFrame([(c, t, "user", f"{c % 4} {t}") for c in range(40) for t in range(5)], "conv_id long, turn long, role string, text string")
    wanted = [near_dups.groups(docs).count(), prefix_trie.trie(talk).count(), chat_format.render(talk).count()]
    found, errors = {}, []

    def run(name, f):
        try:
            found[name] = f().count()
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    jobs = [threading.Thread(target=run, args=x) for x in ((0, lambda: near_dups.groups(docs)), (1, lambda: prefix_trie.trie(talk)), (2, lambda: chat_format.render(talk)))]
    for j in jobs:
        j.start()
    for j in jobs:
        j.join()
    assert not errors and [found[i] for i in range(3)] == wanted


def test_hidden_columns_of_scans_are_gone(spark):
    assert scans.BLOCK not in prefix_trie.trie(spark.createDataFrame([(1, 1, "a", "b")], "conv_id long, turn long, role string, text string")).columns
