"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, repeated strings are cut,
contaminated documents go, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs. Rows without doc_id can't be grouped or ordered:
they pass the near-duplicate and repeated-string stages as they are. Rows that share a doc_id are one document to the
near-duplicate stage: it is judged by its smallest text, and all its rows stay or go. Repeated rows stay repeated. Removing
repeated bytes may cut a character; what is
left of it goes too. Documents of which nothing is left stay, with an empty text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, near_dups, suffix_dedup, toxicity
from tidemark.llm.common import discard, recorded, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = near_dups.groups(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove(docs, keep_text=True).where("n_removed > 0").select(F.struct("doc_id", "d1").alias("document"), F.struct("kept").alias("cut")).distinct()

    same_text = F.xxhash64(F.coalesce("text", F.lit(""))).alias("d1")
    rows = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), same_text).alias("document"), F.struct(*docs.columns).alias("row"))
    rows = rows.join(cut, "document", "left")  # in structs, so that no column of docs clashes
    text = F.when(F.col("cut").isNotNull(), F.col("cut.kept")).otherwise(F.col("row.text"))
    rows = rows.select("row", F.col("cut").isNotNull().alias("changed"), text.alias("left"))
    new = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("changed"), F.char_length("left").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_and_digest(docs, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Toxicity and encoding can't be written in SQL; tests hold run() against brute-force stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage stored goes once the next one's result is written; what this result reads stays."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, step in STAGES[:-1]:
        with recorded() as own:
            docs = stored(step(spark, docs, sf_dir), f"pipeline_{name}")
        discard(spark, [p for p in [*before, *own] if p != docs._tidemark_path])
        before = [docs._tidemark_path]
    return STAGES[-1][1](spark, docs, sf_dir)
