"""op2: main text of web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import html_text
from tidemark.llm.common import table


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


QUERIES = {"op2_html_text": op2_html_text}
ORACLES: dict[str, str] = {}
