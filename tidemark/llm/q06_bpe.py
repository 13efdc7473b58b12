"""op6: BPE encoding and decoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe
from tidemark.llm.common import table


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_and_digest(table(spark, sf_dir, "documents"), path)


QUERIES = {"op6_bpe": op6_bpe}
ORACLES: dict[str, str] = {}
