"""op7: repeated byte strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import suffix_dedup
from tidemark.llm.common import table


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {"op7_suffix_dedup": op7_suffix_dedup}
ORACLES: dict[str, str] = {}
