"""op3: toxicity by nearest labelled examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import toxicity
from tidemark.llm.common import table


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "neighbours", "cosines")


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLES: dict[str, str] = {}
