"""License scans, page text, toxicity, token files, BPE, chat formatting and decontamination on small tables."""

from __future__ import annotations

import hashlib
import os
import re
import textwrap
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, chat_format, decontaminate, html_text, licenses, token_files, toxicity

BPE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    (1, "Hello  world's\n\n\tit's 12,345 ²½ — “quoted” ñandú 'tis <|endoftext|> end"), (2, None), (3, ""), (4, "日本語 текст 🙂 　 x​"), (5, "a" * 3000), (6, " "), (7, "same"), (7, "same"),
    (None, "no id"), (9, "x'll''ll 's 'S" + "\r\n   z"),
]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "zz", "ids") for i, t in rows], "doc_id long, text string, ids string, n_tokens string").repartition(3)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BPE)


# ---- licenses


def test_licenses(spark):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 100)
    rows = [
        (1, "Some prose.\nReleased under the MIT License.\nMore."), (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0."), (4, "Copyright is a word, and so is permission, in prose about the law."), (5, None), (6, ""),
        (7, "Copyright 2020 X\n\n" + mit.replace(", and to permit", ",\nand to permit")), (8, "word " * 5000 + "Released under the MIT License. " + "word " * 5000), (9, mit.replace("free of charge", "for a fee")), (None, "Licensed under the Apache License, Version 2.0."),
    ]
    found = {r["doc_id"]: r for r in licenses.scan(documents(spark, rows)).collect()}
    assert {k: r["licenses"] for k, r in found.items()} == {1: "MIT", 2: "GPL-3.0", 3: "CC-BY-4.0,CC-BY-NC-4.0", 4: "", 5: "", 6: "", 7: "MIT", 8: "MIT", 9: "MIT", None: "Apache-2.0"}
    assert found[7]["n_differences"] == 0 and found[9]["n_differences"] > 0
    assert {"free", "charge"} & set(found[9]["matches"][0]["missing"])
    m = found[1]["matches"][0]
    assert rows[0][1][m["start"] : m["stop"]] == "Released under the MIT License"
    assert licenses.scan(documents(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("length", [60, 92, 132, 232, 352, 399, 401, 2000])
@pytest.mark.parametrize("notice, name", [("Released under the MIT License.", "MIT"), ("Licensed under CC BY 4.0.", "CC-BY-4.0")])
def test_a_short_notice_in_a_line_of_any_length(notice, name, length):
    prose = "The harbour was quiet that morning and nobody had expected the boats to come back before noon, least of all with such a catch. " * 20
    text = prose[: (length - len(notice)) // 2] + " " + notice + " " + prose[: (length - len(notice)) // 2]
    _, found = licenses.scan_text(text)
    assert [m["license"] for m in found] == [name] and text[found[0]["start"] : found[0]["stop"]] == notice[:-1]


def test_license_texts_across_breaks_and_in_long_paragraphs():
    texts = {}
    for n, t in licenses.TEMPLATES:
        texts[n] = max(texts.get(n, ""), t, key=len)
    mit = texts["MIT"].replace(" The above copyright", "\n\nThe above copyright")
    bsd = texts["BSD-3-Clause"].replace(" Redistributions of", "\n\n* Redistributions of").replace(" Redistributions in", "\n\n* Redistributions in").replace(" Neither", "\n\n* Neither")
    gpl = texts["GPL-3.0"].replace(" This program is distributed", "\n\nThis program is distributed")
    for name, text in (("MIT", mit), ("BSD-3-Clause", bsd), ("GPL-3.0", gpl)):
        for filler in ("", "A line of prose.\n" * 300):
            wrapped = "\n\n".join("\n".join(textwrap.wrap(p, 72)) for p in text.split("\n\n"))
            whole = filler + wrapped + "\n" + filler
            _, found = licenses.scan_text(whole)
            assert [(m["license"], m["missing"], m["added"]) for m in found] == [(name, [], [])], (name, len(filler))
            assert whole[found[0]["start"] : found[0]["stop"]] == wrapped.rstrip(".")
            _, found = licenses.scan_text(whole + "\n\n" + whole + " Released under the MIT License. Released under the MIT License.")
            assert [m["license"] for m in found] == [name, name, "MIT", "MIT"]
    hard = "\n".join(["Prose that goes on."] * 200 + textwrap.wrap(texts["Apache-2.0"], 60) + ["More of it."] * 200)
    assert [m["license"] for m in licenses.scan_text(hard)[1]] == ["Apache-2.0"]


# ---- pages


def test_pages(spark):
    side = "Side text, with many words, and commas, which goes on for a long while, longer than others, yes, quite long indeed."
    page = f"""<!doctype html><html><head><title>T</title><style>p{{}}</style><script>var x="</p>";</script></head><body><header>Site <a href=/>home</a></header>
<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="cookie-notice">We use cookies, all of them, always, for everything.</div>
<div id=wrap><div class="post-content"><h2>Head &amp; shoulders</h2><p>Hello &lt;b&gt;,   this is <b>bo</b>ld&nbsp;text, long enough to count, of course.<br>More<p>Second one, also long enough, so it counts, too.
<ul><li>One<li>Two</ul><form><input name=q>Search this</form></div><div class="sidebar"><p>{side}</p></div><section id="comments"><p>{side}</p></section></div><footer>&copy; x</footer></body>"""
    assert html_text.extract(page) == "Head & shoulders\nHello <b>, this is bold text, long enough to count, of course. More\nSecond one, also long enough, so it counts, too.\nOne\nTwo"
    rows = [(1, "u", page), (2, None, None), (None, "u", ""), (4, "u", "plain text only"), (5, "u", "<p>unclosed <a href='x"), (6, "u", "<article><p>Short."), (6, "u", "<article><p>Short.")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    out = sorted(((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html_text.main_text(df).collect()), key=lambda r: r[0])
    assert [r[1] for r in out if r[0] != 1 and r[0] != 5] == ["", "", "plain text only", "Short.", "Short."]
    assert all(r[2] == len(r[1]) for r in out)
    deep = "<div>" * 3000 + "<p>Deep down here is a text, quite long, with commas." + "</div>" * 3000
    assert html_text.extract(deep) == "Deep down here is a text, quite long, with commas."


@pytest.mark.parametrize("wrapper", ["<div class='layout has-sidebar'>", "<div class='page no-header'>", "<div id='related-wrap'>"])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<div>{}</div>"])
@pytest.mark.parametrize("title", ["<div class='entry-header'><h1>Title</h1></div>", ""])
def test_a_wrapper_by_an_unwanted_name_keeps_the_article(wrapper, inner, title):
    text = "The main text, long enough to count, goes on for a while, with commas, and it says what the page is about."
    page = f"<body>{wrapper}{inner.format(title + f'<p>{text}<p>{text}')}<div class=sidebar><p>Side text, which is long enough to count, too.</div></div></body>"
    found = html_text.extract(page).split("\n")
    assert found[-2:] == [text, text] and found[:-2] in ([], ["Title"]) and (found[:-2] or not title)


# ---- toxicity


def example_weights(model):
    out = np.zeros((len(model.ids), len(model.vocabulary)))
    for f, (a, b) in enumerate(zip(model.start[:-1], model.start[1:], strict=True)):
        out[model.owner[a:b], f] = model.weight[a:b]
    return out


def test_toxicity(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(1, 601):
        text = " ".join(rng.choice(words, 40))
        toxic = i % 5 == 0
        if toxic:
            text += " " + rng.choice(["zwinkel", "zwinkels", "Quorfen!", "quorfens"])
        rows.append((i, text))
        labels.append((i, int(toxic), "noise"))
    rows += [(None, "zwinkel"), (700, None), (701, ""), (702, "zwinkel " * 30000), (703, rows[0][1]), (703, rows[0][1])]
    labels += [(5, None, "x"), (None, 1, "x"), (9999, 1, "x")]
    docs = documents(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, marks.where(~toxicity.held_out()))
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    held = [r for r in out if r["doc_id"] and r["doc_id"] <= 600 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 50 and sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held) / len(held) > 0.97
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[None]["predicted"] == by_id[702]["predicted"] == 1 and by_id[700]["predicted"] == by_id[701]["predicted"] == 0
    vectors, weights = [model.vector(c) for c in toxicity.feature_counts([text for _, text in rows[:200]], model.vocabulary)], example_weights(model)
    for (of, w), (_, found) in zip(vectors, model.nearest(vectors), strict=True):
        cosine = np.minimum(weights[:, of] @ w, 1)
        assert np.allclose(found, [c for c in np.sort(cosine)[::-1][: toxicity.K] if c >= 5e-7], atol=2e-6)
    clashing = docs.withColumns({"score": F.lit(5.0), "toxic": F.lit(1), "held_out": F.lit(True), "feature": F.lit("k")})
    left = toxicity.clean(clashing, marks)
    assert left.columns == clashing.columns and 0 < left.count() == sum(not r["predicted"] for r in toxicity.score(clashing, model).collect())
    assert toxicity.clean(docs, marks).columns == docs.columns
    nothing = toxicity.fit(docs, marks.limit(0))
    assert {r["score"] for r in toxicity.score(docs, nothing).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_features_are_words_and_their_beginnings():
    texts = ["Ab abc, ABCD_abcde5abc", "", "éèê 日本語日本語 x", "zz" * 40000, "'a' b"]
    wanted = [Counter(f for w in re.findall(r"[^\W\d_]+", t.lower()) for f in ["=" + w, *("^" + w[:n] for n in (3, 4, 5, 6) if len(w) >= n)]) for t in texts]
    names = sorted({f for c in wanted for f in c})
    one = lambda f: toxicity.Words([f[1:]]).features()[1][0 if f[0] == "=" else len(f) - 3]
    code = {f: one(f) for f in names}
    assert len(set(code.values())) == len(names)
    vocabulary = np.sort(np.array(list(code.values())))
    for counts, expected in zip(toxicity.feature_counts(texts, vocabulary), wanted, strict=True):
        assert dict(zip(vocabulary[counts[0]].tolist(), counts[1].tolist(), strict=True)) == {int(code[f]): n for f, n in expected.items()}
    assert [len(f) for f, _ in toxicity.feature_counts(["a", ""], np.zeros(0, np.int64))] == [0, 0]


def test_toxicity_knows_rare_slurs(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    slurs = ["".join(rng.choice(list("klmnopqrst"), 7)) for _ in range(24)]
    rows = [(i, " ".join(rng.choice(words, 40)) + (" " + slurs[i // 2 % 24] if i % 2 else "")) for i in range(720)]
    docs = documents(spark, rows)
    marks = spark.createDataFrame([(i, i % 2) for i in range(720)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks.where("doc_id < 480"))  # each slur is in ten examples
    known = set(toxicity.Words([t for _, t in rows[:480]]).features()[1].tolist())
    assert set(model.vocabulary.tolist()) == known
    held = [r for r in toxicity.score(docs, model).collect() if r["doc_id"] >= 480]
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in held) / len(held) > 0.97
    same = {i: rows[i][1].split()[-1] for i in range(1, 720, 2)}
    assert all(same.get(r["neighbours"][0]) == same[r["doc_id"]] for r in held if r["doc_id"] % 2)


def test_toxicity_prunes_exactly(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    monkeypatch.setattr(toxicity, "TOGETHER", 7)
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghij"), int(rng.integers(3, 8)))) for _ in range(400)]
    share = 1 / np.arange(1, 401)
    rows = [(i, " ".join(rng.choice(words, 30, p=share / share.sum())) + (" zwinkel" if i % 4 == 0 else "")) for i in range(300)]
    model = toxicity.fit(documents(spark, rows), spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int"))
    assert 20 < len(model.block_max) < len(model.vocabulary)
    weights = example_weights(model)
    vectors = [model.vector(c) for c in toxicity.feature_counts([t for _, t in rows], model.vocabulary)]
    but = np.arange(300) % 7
    for i, (found, near) in enumerate(model.nearest(vectors, but)):
        of, w = vectors[i]
        cosine = np.minimum(weights[:, of] @ w, 1)
        cosine[i % 7] = 0
        assert i % 7 not in found and np.allclose(near, cosine[found], atol=2e-6) and np.allclose(near, [c for c in np.sort(cosine)[::-1][: toxicity.K] if c >= 5e-7], atol=2e-6)
    together = model.nearest(vectors[:40])
    assert all((a[0] == b[0]).all() for v, a in zip(vectors, together, strict=False) for b in model.nearest([v]))


# ---- BPE and token files


@pytest.mark.parametrize("chars, packed", [(8_000_000, 400_000), (50, 3)])
def test_bpe_equals_the_library(spark, tokenizer, monkeypatch, chars, packed):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", chars)
    monkeypatch.setattr(bpe, "PACKED_WORDS", packed)
    docs = documents(spark, TEXTS)
    coded = bpe.encode(docs, BPE)
    found = sorted(((r["doc_id"] or 0), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digest(coded, BPE).collect())
    expected = []
    for i, t in TEXTS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        expected.append((i or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert found == sorted(expected)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in bpe.decode(coded, BPE).collect()) == sorted((i or 0, t or "") for i, t in TEXTS)
    assert sorted(map(repr, bpe.encode_and_digest(docs, BPE).collect())) == sorted(map(repr, bpe.digest(coded, BPE).collect()))
    assert bpe.encode_and_digest(docs.limit(0), BPE).count() == 0


def test_token_files(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_TOKENS", 40)
    docs = documents(spark, TEXTS)
    out = token_files.read(spark, token_files.write(docs, BPE, end_id=0, partitions=3)).orderBy("start").collect()
    start = 0
    for r, (i, t) in zip(out, sorted((x for x in TEXTS if x[0] is not None), key=lambda x: x[0]), strict=True):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.read(spark, token_files.write(docs.limit(0), BPE)).count() == 0


def test_directly_addressable_codes():
    rng = np.random.default_rng(1)
    for n in (1, 7, 511, 512, 513, 3000):
        ids = (rng.integers(0, 2**31, n) >> rng.integers(0, 31, n)).astype(np.uint32)
        cuts = np.array_split(ids, 3)
        f = token_files.TokenFile(token_files.to_file([3, 5, 9], cuts))
        assert (f.tokens(0, n) == ids).all() and all((f.document(k) == cuts[k]).all() for k in range(3))
        assert [f.token(i) for i in range(0, n, max(1, n // 50))] == ids[:: max(1, n // 50)].tolist()
        a, b = sorted(rng.integers(0, n + 1, 2))
        assert (f.tokens(int(a), int(b)) == ids[a:b]).all()


# ---- chat


def test_chat(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (2, 2, "user", "bye"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (3, 2, "user", "bye"),
        (4, 0, "user", "hi"), (4, 1, "assistant", "other"), (5, None, None, None), (None, 0, "user", "x"), (6, 0, "user", "hi"), (6, 0, "user", "hi"), (7, 5, "user", "z" * 50000), (8, 0, "b", "tie"), (8, 0, "a", "tie"),
    ]
    df = spark.createDataFrame([(*r, "n") for r in rows], "conv_id long, turn long, role string, text string, n string").repartition(4)
    out = {r["conv_id"]: r for r in chat_format.render(df).collect()}
    assert {k: (r["n_turns"], r["n_copies"]) for k, r in out.items()} == {2: (3, 2), 4: (2, 1), 5: (1, 1), 7: (1, 1), 8: (2, 1)}
    assert out[4]["text"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nother<|im_end|>\n"
    assert out[8]["text"].index("<|im_start|>a") < out[8]["text"].index("<|im_start|>b")
    assert chat_format.render(df.limit(0)).count() == 0


# ---- decontamination


def words(t):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


@pytest.mark.parametrize("limit", [10**6, 0])
def test_decontamination_equals_brute_force(spark, limit):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "İx", "Σας"]
    items = [(i, " ".join(rng.choice(vocabulary, int(n)))) for i, n in enumerate(rng.integers(10, 30, 12))] + [(50, "Lone"), (51, "two words"), (52, None), (53, ""), (54, items_text := "nine " * 9), (55, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10")]
    docs = []
    for i in range(40):
        parts = [" ".join(rng.choice(vocabulary, 15))]
        if i % 3 == 0:
            own = words(items[rng.integers(0, 12)][1])
            a = int(rng.integers(0, max(1, len(own) - 9)))
            parts.append(", ".join(own[a : a + int(rng.integers(9, 14))]).upper())
        parts.append(" ".join(rng.choice(vocabulary, 5)))
        docs.append((i, "-".join(parts)))
    docs += [(100, None), (101, ""), (102, "lone"), (103, "Two; words two-words"), (104, items_text), (None, items[0][1]), (105, docs[0][1]), (105, docs[0][1]), (106, (items[1][1] + " filler ") * 300)]
    df, bench = documents(spark, docs), spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, w int")
    grams = {}
    for i, t in items:
        w = words(t)
        size = min(10, len(w))
        for s in range(len(w) - size + 1) if w else []:
            grams.setdefault(tuple(w[s : s + size]), set()).add(str(i))
    expected = []
    for i, t in docs:
        w, hit, own = words(t), set(), set()
        for size in {len(g) for g in grams}:
            for s in range(len(w) - size + 1):
                if (g := tuple(w[s : s + size])) in grams:
                    hit.update(range(s, s + size))
                    own |= grams[g]
        expected.append((i or 0, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    found = decontaminate.contamination(df, bench, broadcast_rows=limit, short_in_plan=min(limit, 10_000)).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in found) == sorted(expected)
    clean = decontaminate.clean(df, bench, broadcast_rows=limit)
    assert clean.columns == df.columns and clean.count() == sum(not e[-1] for e in expected)
    assert decontaminate.contamination(df.limit(0), bench).count() == 0
    assert decontaminate.contamination(df, bench.limit(0)).where(F.col("contaminated")).count() == 0


def test_piece_classes_are_the_tokenizers():
    from tidemark.llm.words_bpe import PIECE, UNUSUAL, pieces_of

    split = pieces_of(BPE).tokenizer.pre_tokenizer.pre_tokenize_str
    usual = [chr(c) for c in range(0x2100) if not UNUSUAL.search(chr(c))]
    assert len(usual) > 590
    for c in usual:
        text = f"a{c}1{c} {c}{c} '{c}s{c}'s\n{c}"
        assert PIECE.findall(text) == [text[a:b] for _, (a, b) in split(text)], hex(ord(c))


# ---- pages wrapped as a whole

WRAPPED = "A long enough paragraph of an article, with commas, and more words to count."


@pytest.mark.parametrize("page, whole", [
    ("<body><form><article><h1>Head</h1><p>{t}<p>{t}</article></form>", "Head\n{t}\n{t}"), ("<form><div>{t}</div></form>", "{t}"), ("<aside><article><h1>H</h1><p>{t}</article></aside>", "H\n{t}"),
    ("<dialog open><p>{t}<p>{t}</dialog>", "{t}\n{t}"), ("<div role=form><main><p>{t}</main></div>", "{t}"), ("<div role=status><article><p>{t}</article></div>", "{t}"),
    ("<body style='display: none'><h1>H</h1><p>{t}</body>", "H\n{t}"), ("<article><h1>H</h1><p>{t}<p>{t}</article><aside><p>{t}</aside><div hidden><p>{t}</div><form><p>{t}</form>", "H\n{t}\n{t}"),
    ("<h1>H</h1><div><p>{t}</div><dialog><p>{t}<p>{t}<p>{t}</dialog>", "H\n{t}"), ("<main><p>{t}<p>{t}</main><aside><article><p>{t}</article></aside>", "{t}\n{t}"),
])
def test_what_wraps_the_whole_page_is_not_cut(page, whole):
    assert html_text.extract(page.format(t=WRAPPED)) == whole.format(t=WRAPPED)


def test_a_very_long_page():
    page = "<article>" + "".join(f"<p>{WRAPPED} {i}" for i in range(20_000)) + "</article>"
    assert html_text.extract(page).count("\n") == 19_999


# ---- wording that decides a licence

BSD2 = next(t for n, t in licenses.TEMPLATES if n == "BSD-2-Clause" and len(t) > 100)


@pytest.mark.parametrize("text, names", [
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", []), ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", []),
    ("This work is licensed under a Creative Commons Attribution 3.0 International License.", []), ("This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
    ("This work is licensed under the GNU General Public License, version 5.", []), ("Licensed under the Apache License, Version 3.0.", []), ("This work is not licensed under the GNU General Public License, version 3.", []),
    ("This is NOT released under the MIT License.", []), ("It isn't licensed under CC BY 4.0.", []), ("SPDX-License-Identifier: MIT", ["MIT"]), ("All of it is CC-BY-4.0, mind.", ["CC-BY-4.0"]), ("It is under the GNU GPL v3 or so.", ["GPL-3.0"]),
    (BSD2, ["BSD-2-Clause"]), ("Licensed under CC BY-SA 3.0.", []), ("Released under the MIT License. Released under the MIT License.", ["MIT", "MIT"]),
])
def test_names_versions_clauses_and_negations_decide(text, names):
    assert [m["license"] for m in licenses.scan_text("Prose that goes before. " + text + " And some after it.")[1]] == names


def test_ranking_leaves_out_no_match(monkeypatch):
    """Templates with up to 12 % of their words changed, among prose: the same as if every template were aligned with every block."""
    rng = np.random.default_rng(5)
    prose = "the harbour was quiet that morning and nobody had expected boats to come back before noon software license copyright permission".split()
    texts = []
    for _ in range(80):
        words = licenses.TEMPLATES[rng.integers(len(licenses.TEMPLATES))][1].split()
        for _ in range(int(rng.integers(0, 1 + int(len(words) * 0.12)))):
            words[int(rng.integers(len(words)))] = str(rng.choice(prose))
        texts.append(" ".join([*rng.choice(prose, int(rng.integers(0, 300))), *words]) + ". " + " ".join(rng.choice(prose, int(rng.integers(0, 300)))))
    found = [licenses.scan_text(t)[1] for t in texts]
    monkeypatch.setattr(licenses, "LEAST_SAVED", -(10.0**9))
    assert found == [licenses.scan_text(t)[1] for t in texts] and sum(map(len, found)) > 50


def test_many_licence_words_take_time_in_proportion():
    rng = np.random.default_rng(3)
    words = sorted({w for _, _, ws, _ in licenses.compressors()[1] for w in ws})
    began = time.time()
    licenses.scan_text(" ".join(rng.choice(words, 20_000)))
    assert time.time() - began < 30


def test_licenses_of_odd_tables(spark):
    rows = [(1, "Released under the MIT License.", "x", 3), (1, "Released under the MIT License.", "x", 3), (2, "Licensed under CC BY 4.0. Licensed under CC BY 4.0.", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, licenses string, matches int")
    found = licenses.scan(df).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["licenses"], r["n_matches"]) for r in found] == [(1, "MIT", 1), (1, "MIT", 1), (2, "CC-BY-4.0", 2)]


def test_held_out_toxicity_of_the_given_tables(spark):
    where = "/root/testdata/sf0.1"
    if not os.path.isdir(where):
        pytest.skip("no test tables")
    docs, labels = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    marked = labels.where(toxicity.held_out() & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    rows = toxicity.score(docs.join(marked.select("doc_id"), "doc_id", "left_semi"), model).join(marked, "doc_id").select("predicted", "toxic").collect()
    found = sum(r["predicted"] and r["toxic"] for r in rows)
    assert found >= 0.9 * sum(r["toxic"] for r in rows) > 80 and found >= 0.9 * sum(r["predicted"] for r in rows)


def test_token_lookup(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_TOKENS", 60)
    texts = {i * 3: f"text {i} " + "with words " * (i % 9) + "é" * (i % 4) for i in range(60)} | {700: "", 701: None}
    path = token_files.write(documents(spark, list(texts.items())), BPE, end_id=0, partitions=4)
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for d, t in texts.items()}
    wanted = [(d, i) for d in (0, 3, 90, 177, 700, 701) for i in range(-1, 9)] + [(1, 0), (-5, 0), (999, 0), (3, None)]
    found = {(r["doc_id"], r["i"]): r["token"] for r in token_files.lookup(spark, path, spark.createDataFrame(wanted, "doc_id long, i long")).collect()}
    assert found == {(d, i): ids[d][i] if d in ids and i is not None and 0 <= i < len(ids[d]) else None for d, i in wanted}
    assert token_files.lookup(spark, path, spark.createDataFrame([], "doc_id long, i long")).count() == 0
