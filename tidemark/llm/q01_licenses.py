"""op1: license scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import licenses
from tidemark.llm.common import table


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


QUERIES = {"op1_licenses": op1_licenses}
ORACLES: dict[str, str] = {}
