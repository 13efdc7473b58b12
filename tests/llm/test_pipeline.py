"""The whole pipeline against plain stages, on odd tables."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.test_group_operators import brute_groups
from tests.llm.test_text_operators import words
from tidemark.llm import toxicity

pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, n_chars long, document string, cut int, label long, hub long, size int, kept boolean"


def without_repeats(rows, length=100):
    """Texts without each byte of a string of ``length`` that starts earlier too, and without halves of characters."""
    seen, out = set(), []
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s in seen:
                gone[p : p + length] = True
            seen.add(s)
        out.append((i, np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore") if gone.any() else t))
    return out + [r for r in rows if r[0] is None]


def contaminated(text, items):
    w = words(text)
    for item in items:
        own = words(item)
        size = min(10, len(own))
        grams = {tuple(own[s : s + size]) for s in range(len(own) - size + 1)} if own else set()
        if any(tuple(w[s : s + size]) in grams for s in range(len(w) - size + 1)) and grams:
            return True
    return False


def stored_tables(spark, folder, docs, labels, items):
    spark.createDataFrame([(i, t, "en", len(t or ""), "d", 1, 2, 3, 4, True) for i, t in docs], SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, text string").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_run_equals_plain_stages(spark, tmp_path):
    rng = np.random.default_rng(8)
    vocabulary = ["".join(rng.choice(list("abcdefghijé"), int(n))) for n in rng.integers(2, 9, 400)]
    prose = lambda n: " ".join(rng.choice(vocabulary, n))
    passage, item = prose(40), prose(14)
    docs = [(i, prose(int(rng.integers(1, 80))) + (" zwinkels" if i % 6 == 0 else "")) for i in range(1, 121)]
    docs += [(130 + i, f"{prose(9)} {passage} {prose(9)}") for i in range(5)]  # a passage that repeats
    docs += [(140 + i, docs[40][1] + (" x" * i)) for i in range(3)]  # near copies
    docs += [(150, f"{prose(5)} {item.upper()} {prose(5)}"), (151, "Lone"), (160, None), (161, ""), (162, " \n"), (163, prose(30000)), (None, "no id here"), (None, None), (164, "日本語 🙂 text <|endoftext|>")]
    labels = [(i, int(i % 6 == 0), "x") for i in range(1, 121)] + [(None, 1, "y"), (130, None, "z")]
    items = [(1, item), (2, "lone"), (3, None), (4, "")]
    stored_tables(spark, f"file://{tmp_path}", docs, labels, items)
    table = lambda name: spark.read.parquet(f"file://{tmp_path}/{name}.parquet")

    model = toxicity.fit(table("documents"), table("labels").where(~toxicity.held_out()))
    clean = sorted((r["doc_id"] or -1) for r in toxicity.score(table("documents"), model).collect() if not r["predicted"])
    rows = [r for r in docs if (r[0] or -1) in clean]
    assert not any("zwinkels" in (t or "") for _, t in rows) and len(rows) > 100
    groups = brute_groups([r for r in rows if r[0] is not None])
    rows = [r for r in rows if r[0] is None or groups[r[0]][2]]
    rows = [r for r in without_repeats(rows) if not contaminated(r[1], [t for _, t in items])]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    coded = [(i or -1, tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    expected = sorted((i, len(ids), sha(",".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))) for i, ids in coded)

    first, second = pipeline.run(spark, f"file://{tmp_path}"), pipeline.run(spark, f"file://{tmp_path}")
    for out in (first, second):  # both are read after both were made
        assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out.collect()) == expected


def test_run_on_empty_tables(spark, tmp_path):
    stored_tables(spark, f"file://{tmp_path}", [], [], [])
    assert pipeline.run(spark, f"file://{tmp_path}").count() == 0
