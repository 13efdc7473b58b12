"""op11: the trie of conversation prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import prefix_trie
from tidemark.llm.common import table


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


#: DuckDB has no CRC-32: bit by bit, of the bytes of a decimal number.
CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST({} AS VARCHAR), ''), lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295)"""

SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, CAST({CRC.format("conv_id")} % 9 AS INTEGER) AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, t.n, 0 AS part, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.n <= h
  UNION ALL SELECT c.conv_id, t.n, 1 AS part, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.n > h),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, n) AS depth, role, text FROM r),
m AS (
  SELECT conv_id, depth, list(role || chr(0) || text) OVER (PARTITION BY conv_id ORDER BY depth) AS node, strlen(text) AS bytes FROM o
  UNION ALL SELECT conv_id, 0, CAST([] AS VARCHAR[]), 0 FROM c),
node AS (SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM m GROUP BY depth, node),
child AS (SELECT depth - 1 AS depth, node[1:depth - 1] AS node, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (depth, node)),
sub AS (
  SELECT m.depth, m.node, sum((u.n_convs - 1) * u.bytes) AS saved_tokens, count(*) FILTER (u.n_children = 0) AS n_leaves
  FROM full_node AS u JOIN m ON m.conv_id = u.conv_id AND m.depth <= u.depth GROUP BY m.depth, m.node),
ends AS (
  SELECT depth, node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM m JOIN (SELECT conv_id, max(depth) AS depth FROM m GROUP BY conv_id) USING (conv_id, depth) GROUP BY depth, node)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM full_node AS v JOIN sub USING (depth, node) LEFT JOIN ends USING (depth, node)
LEFT JOIN node AS p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.node = v.node[1:v.depth - 1]
"""

QUERIES = {"op11_prefix_trie": op11_prefix_trie}
ORACLES = {"op11_prefix_trie": SQL}
