"""op4: token-id files with directly addressable codes."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import token_files
from tidemark.llm.common import table


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {"op4_token_files": op4_token_files}
ORACLES: dict[str, str] = {}
