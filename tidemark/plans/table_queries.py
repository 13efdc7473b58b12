"""Queries of tables with versions, of segmented scans, dense orders and divisions, each with the SQL that it must equal."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import scans, tables
from tidemark.plans.queries import RUNS, query, r6, read
from tidemark.plans.runs import ORDER, runs
from tidemark.sources import ordered, typed
from tidemark.sources.scratch import shared_dir
from tidemark.sources.versioned import Versioned


def scratch_table(spark: SparkSession, key: str, buckets: int = 32) -> Versioned:
    """A table of this application's own, which goes when it ends."""
    path = f"{shared_dir(spark)}/tidemark/versioned-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return Versioned(spark, path, key, buckets)


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


# ---- tables with versions


@query("upsert_versioned", """WITH n AS (SELECT c_custkey + 5 AS c_custkey, CASE WHEN c_custkey % 20 = 0 THEN '  ' ELSE 'N' || c_custkey END AS c_name, CASE WHEN c_custkey % 30 = 0 THEN NULL ELSE 'MERGED' END AS c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 10 = 0)
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
       CASE WHEN (o.c_custkey IS NULL OR n.c_acctbal > 0) AND trim(n.c_name) <> '' THEN n.c_name ELSE o.c_name END AS c_name,
       CASE WHEN (o.c_custkey IS NULL OR n.c_acctbal > 0) AND trim(n.c_mktsegment) <> '' THEN n.c_mktsegment ELSE o.c_mktsegment END AS c_mktsegment,
       CASE WHEN o.c_custkey IS NULL OR n.c_acctbal > 0 THEN n.c_acctbal ELSE o.c_acctbal END AS c_acctbal
FROM (SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer) o FULL JOIN n ON n.c_custkey = o.c_custkey""")
def _(spark, d):
    customers, key = _customers(spark, d), F.col("c_custkey")
    new = customers.where(key % 10 == 0).select((key + 5).cast("bigint").alias("c_custkey"), F.when(key % 20 == 0, "  ").otherwise(F.concat(F.lit("N"), key)).alias("c_name"), F.when(key % 30 != 0, "MERGED").alias("c_mktsegment"), "c_acctbal")
    table = scratch_table(spark, "c_custkey")
    table.replace(customers)
    table.merge(new, always=["c_acctbal"], accept=F.col("c_acctbal") > 0)
    return table.read()


@query("replace_keys_versioned", """WITH n AS (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity FROM lineitem WHERE l_linenumber > 3 GROUP BY l_orderkey)
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM n) UNION ALL SELECT l_orderkey, -1, quantity / n_lines FROM n""")
def _(spark, d):
    lines = read(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), F.col("l_quantity").cast("double").alias("l_quantity"))
    new = lines.where("l_linenumber > 3").groupBy("l_orderkey").agg((F.sum("l_quantity") / F.count("*")).alias("l_quantity")).select("l_orderkey", F.lit(-1).alias("l_linenumber"), "l_quantity")
    table = scratch_table(spark, "l_orderkey")
    table.replace(lines)
    table.replace_keys(new)
    return table.read()


@query("append_new_versioned", """SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 2 = 0 THEN 2 ELSE 3 END AS batch FROM events""")
def _(spark, d):
    events, n = read(spark, d, "events").select("event_id", "user_id"), F.col("event_id")
    table = scratch_table(spark, "event_id")
    table.replace(events.where(n % 3 == 0).withColumn("batch", F.lit(1)))
    second = events.where((n % 2 == 0) | (n % 3 == 0)).withColumn("batch", F.lit(2))
    table.append_new(second.unionByName(second))  # the same rows twice come once
    table.append_new(events.withColumn("batch", F.lit(3)))
    return table.read()


@query("versions_pinned", """SELECT 1 AS version, c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY c_mktsegment
UNION ALL SELECT 2, c_mktsegment, count(*), round(sum(c_acctbal * 2), 2) FROM customer WHERE c_nationkey < 15 GROUP BY c_mktsegment
UNION ALL SELECT 3, lower(c_mktsegment), count(*), round(sum(c_acctbal * 2), 2) FROM customer WHERE c_nationkey < 15 GROUP BY c_mktsegment""")
def _(spark, d):
    table = scratch_table(spark, "c_custkey")
    table.replace(read(spark, d, "customer"))
    for change in (lambda df: df.where("c_nationkey < 15").withColumn("c_acctbal", F.col("c_acctbal") * 2), lambda df: df.withColumn("c_mktsegment", F.lower("c_mktsegment"))):
        table.replace(change(table.read()))  # reads what it replaces
    counts = [table.read(v).groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total")).select(F.lit(v).alias("version"), "*") for v in (1, 2, 3)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# ---- scans of keys that may hold any share of the rows

HOT = "CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 3 = 1 THEN 'hot' ELSE 'k' || user_id END"


def _with_hot_keys(spark: SparkSession, d: str) -> DataFrame:
    user = F.col("user_id")
    key = F.when(user % 3 == 1, "hot").when(user % 3 == 2, F.concat(F.lit("k"), user))
    return read(spark, d, "events").select("event_id", "ts", "value", "event_type", key.alias("key"))


@query("hot_key_running_totals", f"WITH e AS (SELECT *, {HOT} AS key FROM events) SELECT event_id, row_number() OVER w AS n, coalesce(round(sum(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 4), 0) AS before, CAST(coalesce(count(CASE WHEN event_type = 'error' THEN 1 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS errors_before FROM e WINDOW w AS (PARTITION BY key ORDER BY ts, event_id)")
def _(spark, d):
    cut = scans.in_blocks(_with_hot_keys(spark, d), ["key"], ["ts", "event_id"])
    cut = scans.scan(scans.numbered(cut, ["key"]), ["key"], {"before": F.col("value"), "errors_before": (F.col("event_type") == "error").cast("long")})
    return cut.select("event_id", "n", F.coalesce(F.round("before", 4), F.lit(0.0)).alias("before"), F.coalesce("errors_before", F.lit(0)).alias("errors_before"))


@query("hot_key_asof", f"WITH e AS (SELECT *, {HOT} AS key FROM events), p AS (SELECT *, count(CASE WHEN event_type = 'error' THEN 1 END) OVER (PARTITION BY key ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS g, count(CASE WHEN event_type = 'error' THEN 1 END) OVER (PARTITION BY key ORDER BY ts, event_id) AS own FROM e), s AS (SELECT key, own, event_id, value FROM p WHERE event_type = 'error' AND key IS NOT NULL) SELECT p.event_id, s.event_id AS error_id, s.value AS error_value FROM p LEFT JOIN s ON s.key = p.key AND s.own = p.g")
def _(spark, d):
    df = scans.asof_before(_with_hot_keys(spark, d), ["key"], ["ts", "event_id"], F.col("event_type") == "error", {"error_id": F.col("event_id"), "error_value": F.col("value")})
    return df.select("event_id", "error_id", "error_value")


@query("hot_context_history", f"WITH {RUNS}, h AS (SELECT *, CASE WHEN horse_id % 4 = 0 THEN NULL ELSE horse_id END AS horse FROM runs) SELECT result_id, CAST(coalesce(sum(CASE WHEN finishing_position IS NOT NULL THEN 1 END) OVER w, 0) AS BIGINT) AS starts, CAST(coalesce(sum(CASE WHEN finishing_position = 1 THEN 1 END) OVER w, 0) AS BIGINT) AS wins, round(avg(odds) OVER w, 6) AS mean_odds FROM h WINDOW w AS (PARTITION BY horse, surface ORDER BY race_date, race_number, race_id, result_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def _(spark, d):
    df = runs(spark, d).withColumn("horse", F.when(F.col("horse_id") % 4 != 0, F.col("horse_id")))
    keys = ["horse", "surface"]
    one = lambda c: F.when(c, 1).cast("long")
    sums = {"starts": one(F.col("finishing_position").isNotNull()), "wins": one(F.col("finishing_position") == 1), "odds_sum": F.col("odds"), "odds_n": one(F.col("odds").isNotNull())}
    df = scans.scan(scans.in_blocks(df, keys, ORDER), keys, sums)
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return df.select("result_id", none("starts"), none("wins"), r6(F.col("odds_sum") / F.col("odds_n")).alias("mean_odds"))


@query("dense_global_order", f"WITH {RUNS} SELECT result_id, row_number() OVER (ORDER BY race_date, race_number, race_id, result_id) - 1 AS ordinal FROM runs")
def _(spark, d):
    return scans.in_order(runs(spark, d).select("result_id", *[c for c in ORDER if c != "result_id"]), ORDER).select("result_id", "ordinal")


@query("source_order", "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS place FROM events")
def _(spark, d):
    return ordered.with_source_order(read(spark, d, "events"), "place").select("event_id", "place")  # the file is sorted by event_id


@query("written_order", f"WITH {RUNS} SELECT result_id, horse_id, row_number() OVER (ORDER BY horse_id % 17, draw, result_id DESC) - 1 AS position FROM runs")
def _(spark, d):
    path = f"{shared_dir(spark)}/tidemark/ordered-{uuid.uuid4().hex}"
    df = runs(spark, d).select("result_id", "horse_id", "draw", (F.col("horse_id") % 17).alias("_group"), (-F.col("result_id")).alias("_down"))
    ordered.write_in_order(df, ["_group", "draw", "_down"], path)
    return ordered.with_positions(spark, path, ["result_id", "horse_id"], "position")


# ---- relational division

CACHED = "CASE WHEN result_id % 5 = 0 THEN '  ' WHEN result_id % 7 = 0 THEN NULL ELSE 'C4' END"


@query("form_complete", f"""WITH {RUNS}, cache AS (SELECT horse_id, race_date, race_index, {CACHED} AS race_class, result_id FROM runs WHERE result_id % 3 <> 0),
last AS (SELECT horse_id, race_date, race_index, max_by(coalesce(race_class, ''), result_id) AS race_class FROM cache GROUP BY ALL),
need AS (SELECT DISTINCT horse_id, race_date, race_index FROM runs WHERE race_index > 2)
SELECT h.horse_id, count(n.horse_id) AS n_needed, count(CASE WHEN trim(l.race_class) <> '' THEN 1 END) AS n_present,
       count(n.horse_id) > 0 AND count(n.horse_id) = count(CASE WHEN trim(l.race_class) <> '' THEN 1 END) AS complete
FROM (SELECT DISTINCT horse_id FROM runs WHERE horse_id IS NOT NULL) h LEFT JOIN need n ON n.horse_id = h.horse_id
LEFT JOIN last l ON l.horse_id = n.horse_id AND l.race_date = n.race_date AND l.race_index = n.race_index GROUP BY h.horse_id""")
def _(spark, d):
    df, n = runs(spark, d), F.col("result_id")
    cache = df.where(n % 3 != 0).select("horse_id", "race_date", "race_index", F.when(n % 5 == 0, "  ").when(n % 7 != 0, "C4").alias("race_class"), "result_id")
    return tables.for_all(df, cache, "horse_id", ["race_date", "race_index"], F.col("race_index") > 2, F.trim(F.coalesce("race_class", F.lit(""))) != "", ["result_id"])


# ---- types of whole columns

CELLS = """SELECT event_id, CASE event_id % 4 WHEN 0 THEN ' ' || event_id || ' ' WHEN 1 THEN 'NA' WHEN 2 THEN NULL ELSE CAST(-event_id AS VARCHAR) END AS whole,
CASE event_id % 3 WHEN 0 THEN '1.5' WHEN 1 THEN 'nan' ELSE CAST(event_id AS VARCHAR) END AS real, CASE event_id % 50 WHEN 7 THEN 'n.a.' ELSE CAST(event_id % 9 AS VARCHAR) END AS mixed,
CASE event_id % 2 WHEN 0 THEN 'True' ELSE 'false' END AS flag, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, '' AS nothing FROM events"""


def _cells(spark: SparkSession, d: str) -> DataFrame:
    """A table of text as a CSV scan gives it."""
    n, text = F.col("event_id"), lambda c: c.cast("string")
    return read(spark, d, "events").select(
        "event_id", F.when(n % 4 == 0, F.concat(F.lit(" "), n, F.lit(" "))).when(n % 4 == 1, "NA").when(n % 4 == 3, text(-n)).alias("whole"), F.when(n % 3 == 0, "1.5").when(n % 3 == 1, "nan").otherwise(text(n)).alias("real"),
        F.when(n % 50 == 7, "n.a.").otherwise(text(n % 9)).alias("mixed"), F.when(n % 2 == 0, "True").otherwise("false").alias("flag"), text(F.col("ts").cast("date")).alias("day"), F.lit("").alias("nothing"),
    )


@query("column_types", f"""WITH c AS ({CELLS}), k AS (SELECT count(*) AS n, count(*) FILTER (event_id % 4 IN (1, 2)) AS m1, count(*) FILTER (event_id % 3 = 1) AS m2 FROM c)
SELECT unnest(['whole', 'real', 'mixed', 'flag', 'day', 'nothing']) AS name, unnest(['bigint', 'double', 'string', 'boolean', 'date', 'string']) AS type, n, unnest([m1, m2, 0, 0, 0, n]) AS missing FROM k""")
def _(spark, d):
    found = typed.column_types(_cells(spark, d).drop("event_id"))
    return spark.createDataFrame([(t.name, t.type, t.n, t.missing) for t in found], "name string, type string, n long, missing long")


@query("typed_cells", f"""SELECT event_id, TRY_CAST(trim(whole) AS BIGINT) AS whole, CASE WHEN real <> 'nan' THEN TRY_CAST(real AS DOUBLE) END AS real, mixed, flag = 'True' AS flag, CAST(day AS DATE) AS day, CAST(NULL AS VARCHAR) AS nothing FROM ({CELLS})""")
def _(spark, d):
    return typed.typed(_cells(spark, d), "event_id")[0]


@query("rejected_cells", f"SELECT event_id, 'mixed' AS \"column\", mixed AS cell FROM ({CELLS}) WHERE mixed = 'n.a.' UNION ALL SELECT event_id, 'real', real FROM ({CELLS}) WHERE real = '1.5'")
def _(spark, d):
    return typed.rejected(_cells(spark, d), {"whole": "bigint", "real": "bigint", "mixed": "double", "nothing": "double"}, "event_id")
