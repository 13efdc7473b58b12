"""op5: MinHash near-duplicate groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import near_dups
from tidemark.llm.common import table


def op5_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


QUERIES = {"op5_near_dups": op5_near_dups}
ORACLES: dict[str, str] = {}
