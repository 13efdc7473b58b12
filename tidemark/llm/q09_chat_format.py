"""op9: chat formatting of maximal conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import chat_format
from tidemark.llm.common import table


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.render(table(spark, sf_dir, "conversations"))


SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM t),
c AS (
  SELECT conv_id, count(*) AS n_turns, list(role || chr(0) || text ORDER BY n) AS turns,
         string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY n) AS text
  FROM o GROUP BY conv_id),
d AS (SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_copies, turns, text FROM c GROUP BY n_turns, turns, text)
SELECT conv_id, n_turns, n_copies, text FROM d
WHERE NOT EXISTS (SELECT 1 FROM d AS longer WHERE longer.n_turns > d.n_turns AND longer.turns[1] = d.turns[1]
                  AND longer.turns[1:d.n_turns] = d.turns)
"""

QUERIES = {"op9_chat_format": op9_chat_format}
ORACLES = {"op9_chat_format": SQL}
