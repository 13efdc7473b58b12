"""Queries of the page operators, on pages that are made of the runs so that SQL knows what they must give, and of the
contracts and careers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import tables
from tidemark.plans import careers, cleaning, contracts
from tidemark.plans.queries import RUNS, H, query, read
from tidemark.plans.runs import ORDER, runs
from tidemark.sources import extraction as X
from tidemark.sources import generators
from tidemark.sources import race_pages as P
from tidemark.sources.scratch import settled, shared_dir
from tidemark.streaming import discovery

SITE = "https://races.example"


def _td(*cells) -> list:
    return [x for c in cells for x in (F.lit("<td>"), F.coalesce(c.cast("string"), F.lit("")), F.lit("</td>"))]


def _lots(spark, d) -> int:
    """How many tasks pages of all runs are dealt to: few runs in each, since a page is long where a race has many."""
    return max(16, read(spark, d, "events").count() // 16_000)


def _page(df, key: str, head: list[str], cells: list, before, lots: int, marks: str = "", also: tuple[str, ...] = ()):
    """(key, also, html): a table row a row of ``df``, in the order of result_id; ``also``: columns that a page's rows agree in. The
    rows are dealt by page, and a page is put together where it is parsed."""
    row = F.concat(F.lit("<tr>"), *_td(*cells), F.lit("</tr>"))
    top = "".join(f"<th> {h} </th>" for h in head)
    rows = df.select(key, *also, "result_id", row.alias("row"), before.alias("before")).repartition(lots, key)
    pages = rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("result_id", "row"))), lambda r: r["row"]), "\n").alias("rows"), F.first("before").alias("before"), *[F.first(c).alias(c) for c in also])
    return pages.select(key, *also, F.concat(F.lit("<html><head><script>var a = '<td>';</script></head><body><table><tr><td>menu</td></tr></table>"), "before", F.lit(f"<div{marks}><table><thead><tr>{top}</tr></thead>"), "rows", F.lit("</table></div></body></html>")).alias("html"))


def _horse():
    return F.concat(F.lit('<a href="/jockey?id=1"></a><a href="/Horse?Option=2&HorseId=HK_'), F.col("horse_id"), F.lit('">Horse&nbsp; '), F.col("horse_id"), F.lit("</a> (A12)"))


@query("result_pages", f"""WITH {RUNS} SELECT race_id || '_HK_' || horse_id AS result_id, race_id, (count(*) OVER (PARTITION BY race_id))::INT AS field_size, 'HK_' || horse_id AS horse_id, draw AS horse_number, 'Horse ' || horse_id AS horse_name, finishing_position,
coalesce(finishing_position = 1, false) AS is_winner, coalesce(finishing_position <= 3, false) AS is_top_three, jockey, trainer, actual_weight, declared_horse_weight, draw, coalesce(margin, '') AS margin, finish_time, odds, '{SITE}/Horse?HorseId=HK_' || horse_id || '&Option=1' AS horse_profile_url FROM runs""")
def _(spark, d):
    df = runs(spark, d)
    head = ["Pla.", "Horse No.", "Horse", "Jockey", "Trainer", "Act. Wt.", "Declar. Horse Wt.", "Dr.", "LBW", "Running<br>Position", "Finish Time", "Win Odds"]
    c = F.col
    cells = [c("finishing_position"), c("draw"), _horse(), c("jockey"), c("trainer"), c("actual_weight"), c("declared_horse_weight"), c("draw"), c("margin"), F.lit("1 2 3"), c("finish_time"), F.coalesce(c("odds").cast("string"), F.lit("---"))]
    pages = _page(df, "race_id", head, cells, F.lit('<table class="race_tab"><tr><td>RACE 1 (7)</td></tr></table>'), _lots(spark, d), ' class="inner performance"')
    return P.results(P.page_parts(pages, "html", ["rows"]), SITE).drop("row_no")


@query("race_header_pages", f"""WITH {RUNS} SELECT race_id, race_number, (100 + race_number)::INT AS race_index, 'Class ' || (1 + race_number % 5) AS race_class, (1000 + 50 * race_number)::INT AS distance_m, '60-40' AS rating_band, (1000000 + race_number)::BIGINT AS prize_money_hkd,
CASE WHEN race_number % 3 = 0 THEN '' ELSE 'GOOD TO FIRM' END AS going, CASE WHEN race_number % 2 = 0 THEN 'TURF - "A" Course' ELSE 'ALL WEATHER TRACK' END AS course, 'CUP ' || race_id AS race_name, CASE WHEN race_number % 2 = 0 THEN 'TURF' ELSE 'ALL WEATHER TRACK' END AS surface
FROM runs GROUP BY ALL""")
def _(spark, d):
    races, n = runs(spark, d).select("race_id", "race_number").distinct(), F.col("race_number")
    going = F.when(n % 3 == 0, "").otherwise("<td>Going :</td><td>GOOD TO FIRM</td>")
    course = F.when(n % 2 == 0, 'TURF - "A" Course').otherwise("ALL WEATHER TRACK")
    html = F.concat(F.lit('<table class="x race_tab"><tr><td>RACE '), n, F.lit(" ("), 100 + n, F.lit(")</td></tr><tr><td>class "), 1 + n % 5, F.lit(" - "), 1000 + 50 * n, F.lit("M - (60 - 40)</td>"), going, F.lit("</tr><tr><td>CUP "), F.col("race_id"),
                    F.lit("</td><td>Course :</td><td>"), course, F.lit("</td></tr><tr><td>HK$ "), F.format_number(1000000 + n, 0), F.lit("</td></tr></table>"))
    return P.race_header(P.page_parts(races.select("race_id", html.alias("html")), "html")).drop("strings", "hrefs", "rows")


@query("rating_history_pages", f"""WITH {RUNS} SELECT horse_id, race_date, race_number AS race_index, 'C' || race_class AS race_class, horse_rating_before::INT AS horse_rating_before,
CASE WHEN lead(1) OVER w IS NULL THEN (50 + horse_id % 40)::INT ELSE lead(horse_rating_before::INT) OVER w END AS horse_rating_after FROM runs WINDOW w AS (PARTITION BY horse_id ORDER BY race_date, race_number)""")
def _(spark, d):
    df, c = runs(spark, d), F.col
    cells = [c("race_number"), c("draw"), F.date_format("race_date", "dd/MM/yyyy"), c("distance_m"), F.concat(F.lit("C"), "race_class"), c("horse_rating_before").cast("int")]
    rating = F.concat(F.lit("<p>Current Rating : 1</p><p>Last Rating : "), 50 + c("horse_id") % 40, F.lit("</p>"))
    return P.rating_history(P.page_parts(_page(df, "horse_id", ["Race<br>Index", "Pla.", "Date", "Dist.", "Race Class", "Rtg."], cells, rating, _lots(spark, d)), "html"))


@query("profile_pages", """SELECT c_custkey AS horse_id, 'STAR ' || c_custkey AS horse_name, 'A' || lpad((c_custkey % 1000)::VARCHAR, 3, '0') AS brand_number, CASE c_nationkey % 4 WHEN 0 THEN 'NZ' WHEN 1 THEN 'IRE' WHEN 2 THEN 'KOR' ELSE '' END AS country_of_origin,
CASE WHEN c_nationkey % 4 < 3 THEN (2 + c_custkey % 9)::INT END AS horse_age, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'Bay / Brown' END AS horse_colour, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'Gelding' END AS horse_sex, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'Sire Of ' || c_mktsegment END AS sire,
CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'Dam''s Joy' END AS dam, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'Old (GB)' END AS dam_sire, CASE c_nationkey % 4 WHEN 0 THEN 'Southern' WHEN 1 THEN 'Northern' WHEN 2 THEN 'Other' ELSE '' END AS hemisphere_of_origin, c_custkey % 7 <> 0 OR c_nationkey % 4 < 3 AS profile_scraped FROM customer""")
def _(spark, d):
    k, n = F.col("c_custkey"), F.col("c_nationkey") % 4
    origin = F.when(n == 0, "NZ").when(n == 1, "IRE").when(n == 2, "KOR")
    rest = F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("<p>Colour / Sex : Bay / Brown / Gelding</p><p>Import Type : PP</p><p>Sire : Sire Of "), "c_mktsegment", F.lit("</p><td>Dam : Dam's Joy</td> <td>Dam's Sire</td><td>:</td><td>Old (GB)</td>")))
    html = F.concat(F.lit("<h1>1. STAR "), k, F.lit(" (A"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(")</h1>"), F.coalesce(F.concat(F.lit("<p>Country of Origin / Age : "), origin, F.lit(" / "), 2 + k % 9, F.lit("</p>")), F.lit("")), rest, F.lit("<p>Last Rating : 9</p>"))
    return P.profiles(P.page_parts(read(spark, d, "customer").select(k.alias("horse_id"), html.alias("html")), "html"))


@query("race_number_pages", f"WITH {RUNS}, n AS (SELECT DISTINCT race_date, race_number FROM runs) SELECT race_date, string_agg(race_number::VARCHAR, ',' ORDER BY race_number) AS race_numbers FROM n GROUP BY race_date")
def _(spark, d):
    n = F.col("race_number")
    shown = F.when(n % 2 == 0, F.concat(F.lit("<b>race "), n, F.lit(" of 12</b>"))).otherwise(F.concat(F.lit('<a href="?Racecourse=ST&raceno='), n, F.lit('">next</a>')))
    pages = runs(spark, d).groupBy("race_date").agg(F.array_join(F.collect_list(shown), " ").alias("html"))
    return P.race_numbers(P.page_parts(pages, "html")).select("race_date", F.array_join(F.transform("race_numbers", lambda x: x.cast("string")), ",").alias("race_numbers"))


@query("race_card_pages", f"""WITH {RUNS}, n AS (SELECT *, (row_number() OVER (PARTITION BY race_id ORDER BY result_id))::INT AS no FROM runs)
SELECT race_id, no AS horse_number, 'Horse ' || horse_id AS horse_name, jockey, trainer, 'HK_' || horse_id AS horse_id, '{SITE}/Horse?Option=2&HorseId=HK_' || horse_id AS horse_profile_url, actual_weight AS handicap_weight, draw, horse_rating_before::INT AS horse_rating, declared_horse_weight,
(race_number * 100 + 1000)::INT AS days_since_last_run, race_id || '_' || lpad(no::VARCHAR, 2, '0') AS runner_id FROM n WHERE no <= 30""")
def _(spark, d):
    from pyspark.sql import Window

    df = runs(spark, d).withColumn("no", F.row_number().over(Window.partitionBy("race_id").orderBy("result_id")))
    df = df.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")).withColumn("jockey", F.when(F.col("copy") == 1, F.col("jockey")))  # the copy that says less comes first
    head = ["Horse No.", "Last 6 Runs", "Colour", "Brand No.", "Horse", "Wt.", "Jockey", "Draw", "Trainer", "Rtg.", "Rtg.+/-", "Horse Wt. (Declaration)", "Days since Last Run"]
    c = F.col
    cells = [c("no"), F.lit("1/2"), F.lit(""), F.lit("A12"), _horse(), c("actual_weight"), c("jockey"), c("draw"), c("trainer"), c("horse_rating_before").cast("int"), F.lit("-"), c("declared_horse_weight"), F.format_number(c("race_number") * 100 + 1000, 0)]
    return P.starters(P.page_parts(_page(df, "race_id", head, cells, F.lit(""), _lots(spark, d)), "html", ["rows"]), SITE)


@query("best_records_two_passes", f"""WITH {RUNS}, s AS (SELECT result_id, race_id, draw, trainer, (odds IS NOT NULL)::INT + (going IS NOT NULL)::INT + (coalesce(margin, '') <> '')::INT AS score FROM runs),
a AS (SELECT * FROM s QUALIFY draw % 7 = 0 OR row_number() OVER (PARTITION BY race_id, CASE WHEN draw % 7 <> 0 THEN draw END ORDER BY score DESC, result_id) = 1)
SELECT result_id, race_id FROM a QUALIFY row_number() OVER (PARTITION BY race_id, trainer ORDER BY score DESC, result_id) = 1""")
def _(spark, d):
    df = runs(spark, d).select("result_id", "race_id", F.when(F.col("draw") % 7 != 0, F.col("draw")).alias("draw"), "trainer", "odds", "going", "margin")
    return P.best_records(df, ["race_id"], "draw", "trainer", ["odds", "going", "margin"], "result_id").select("result_id", "race_id")


@query("running_prize_money", f"""WITH {RUNS}, m AS (SELECT *, round_even(prize_money_hkd / 3, 2)::DOUBLE AS won FROM runs), s AS (SELECT result_id, won, coalesce(sum((finishing_position = 2)::INT) OVER b, 0)::BIGINT AS career_seconds_before, coalesce(sum((finishing_position = 3)::INT) OVER b, 0)::BIGINT AS career_thirds_before,
sum(won) OVER ({H} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after FROM m WINDOW b AS ({H} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT result_id, career_seconds_before, career_thirds_before, round(after * 100)::BIGINT AS cents_after, round((after - won) * 100)::BIGINT AS cents_before FROM s""")
def _(spark, d):
    df = careers.career(runs(spark, d), ORDER, F.bround(F.col("prize_money_hkd") / 3, 2))
    return df.select("result_id", "career_seconds_before", "career_thirds_before", *[F.round(F.col(f"career_prize_money_{w}") * 100).cast("bigint").alias(f"cents_{w}") for w in ("after", "before")])


@query("input_contracts", """WITH h AS (SELECT o_orderkey AS result_id FROM orders WHERE o_orderkey % 10 <> 3 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 50 = 0), r AS (SELECT o_orderkey AS result_id FROM orders WHERE o_orderkey % 2 = 1)
SELECT 'history_ids_repeated' AS contract, (SELECT count(*) FROM (SELECT result_id FROM h GROUP BY result_id HAVING count(*) > 1)) AS n UNION ALL SELECT 'row_ids_repeated', (SELECT count(*) FROM (SELECT result_id FROM r GROUP BY result_id HAVING count(*) > 1)) UNION ALL SELECT 'rows_not_in_history', (SELECT count(*) FROM r WHERE result_id NOT IN (SELECT result_id FROM h))""")
def _(spark, d):
    ids = read(spark, d, "orders").select(F.col("o_orderkey").alias("result_id"))
    history = ids.where("result_id % 10 <> 3").unionByName(ids.where("result_id % 50 = 0"))
    return contracts.input_violations(history, ids.where("result_id % 2 = 1"))


@query("output_contracts", """WITH b AS (SELECT o_orderkey AS result_id, (o_orderkey % 20 = 0)::INT * 2 AS t FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, 2 FROM orders WHERE o_orderkey % 9 = 0 AND o_orderkey % 5 <> 0), r AS (SELECT o_orderkey AS result_id FROM orders WHERE o_orderkey % 7 <> 0)
SELECT 'output_ids_repeated' AS contract, (SELECT count(*) FROM (SELECT result_id FROM b GROUP BY result_id HAVING count(*) > 1)) AS n UNION ALL SELECT 'rows_missing', (SELECT count(*) FROM r WHERE result_id NOT IN (SELECT result_id FROM b))
UNION ALL SELECT 'rows_too_many', (SELECT count(*) FROM b) - (SELECT count(*) FROM r WHERE result_id IN (SELECT result_id FROM b)) UNION ALL SELECT 'target_not_0_or_1', (SELECT count(*) FROM b WHERE t NOT IN (0, 1))""")
def _(spark, d):
    ids = read(spark, d, "orders").select(F.col("o_orderkey").alias("result_id"))
    built = ids.where("result_id % 5 <> 0").withColumn("is_winner", F.when(F.col("result_id") % 20 == 0, 2).otherwise(0))
    built = built.unionByName(ids.where("result_id % 9 = 0 and result_id % 5 <> 0").withColumn("is_winner", F.lit(2)))
    return contracts.output_violations(built, ids.where("result_id % 7 <> 0"))


@query("clean_contracts", f"""WITH {RUNS}, s AS (SELECT *, CASE WHEN race_number % 5 = 0 THEN 'DISQUALIFIED' ELSE 'FINISHED' END AS st, coalesce(margin = 'DH', false) AS dh FROM runs)
SELECT unnest(['finished_without_position', 'disqualified_with_position', 'disqualified_without_time', 'warning_dead_heat_not_finished']) AS contract, unnest([count(*) FILTER (st = 'FINISHED' AND finishing_position IS NULL), count(*) FILTER (st <> 'FINISHED' AND finishing_position IS NOT NULL), count(*) FILTER (st <> 'FINISHED' AND finish_time = '---'), count(*) FILTER (st <> 'FINISHED' AND dh)]) AS n FROM s""")
def _(spark, d):
    df = runs(spark, d).withColumns({"result_status": F.when(F.col("race_number") % 5 == 0, "DISQUALIFIED").otherwise("FINISHED"), "is_dead_heat": F.coalesce(F.col("margin") == "DH", F.lit(False))})
    return contracts.clean_violations(df)


@query("status_counters", f"WITH {RUNS}, r AS (SELECT race_id, max(prize_money_hkd) AS p, count(finishing_position) AS n, min(race_number) AS k FROM runs GROUP BY race_id), s AS (SELECT CASE WHEN k = 4 THEN 'REQUEST_FAILED' WHEN p <= 100000 THEN 'SKIP_ZERO_PRIZE' WHEN n <= 3 THEN 'SKIP_NO_RESULTS' ELSE 'OK' END AS status FROM r) SELECT status AS value, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 3) AS percent FROM s GROUP BY status")
def _(spark, d):
    races = runs(spark, d).groupBy("race_id").agg(F.max("prize_money_hkd").alias("p"), F.count("finishing_position").alias("n"), F.min("race_number").alias("k"))
    return tables.value_counts(P.race_status(races, F.col("k") != 4, F.when(F.col("p") > 100000, F.col("p")).otherwise(0), F.when(F.col("n") > 3, F.col("n")).otherwise(0)), "status")


@query("hemispheres_of_table", "WITH c AS (SELECT c_custkey, CASE c_nationkey WHEN 0 THEN 'NZ' WHEN 1 THEN 'IRE' WHEN 2 THEN 'KOR' WHEN 3 THEN 'ZIM' WHEN 4 THEN 'URU' WHEN 5 THEN ' ita ' WHEN 6 THEN 'ity' WHEN 7 THEN 'PER' WHEN 8 THEN '' END AS c FROM customer) SELECT c_custkey, CASE WHEN c IN ('NZ', 'ZIM') THEN 'Southern' WHEN c = 'IRE' THEN 'Northern' ELSE 'Other' END AS hemisphere, CASE WHEN c IN ('NZ', 'URU') THEN 'Southern' WHEN c IN ('IRE', 'ity') THEN 'Northern' END AS derived, coalesce((CASE WHEN c IN ('NZ', 'URU') THEN 1 WHEN c IN ('IRE', 'ity') THEN 0 END), 0)::INT AS conflict FROM c")
def _(spark, d):
    from tidemark.functions import dates

    names = ("NZ", "IRE", "KOR", "ZIM", "URU", " ita ", "ity", "PER", "")
    c = F.element_at(F.create_map(*[F.lit(x) for kv in enumerate(names) for x in kv]), F.col("c_nationkey").cast("int"))
    df = read(spark, d, "customer").select("c_custkey", F.when(F.col("c_nationkey") < len(names), c).alias("c"))
    derived = dates.derived_hemisphere(F.col("c"))
    return df.select("c_custkey", dates.hemisphere(F.col("c")).alias("hemisphere"), derived.alias("derived"), numbers.conflict(derived, F.lit("Northern")).alias("conflict"))


@query("race_card_headers", f"""WITH {RUNS} SELECT race_id, race_number, 'CUP - ' || race_id AS race_name, '12:' || lpad(race_number::VARCHAR, 2, '0') AS race_time, CASE WHEN race_number % 2 = 0 THEN 'Sha Tin' ELSE 'Happy Valley' END AS racecourse_name, CASE WHEN race_number % 3 = 0 THEN 'All Weather Track' ELSE 'Turf' END AS surface,
CASE WHEN race_number % 3 = 0 THEN '' ELSE 'C+3' END AS course, (1000 + 50 * race_number)::INT AS distance_m, 'Good To Firm' AS going, (875000 + race_number)::BIGINT AS prize_money_hkd, CASE WHEN race_number % 5 = 0 THEN '' ELSE '40-0' END AS rating_band, CASE WHEN race_number % 5 = 0 THEN 'G3' ELSE 'C5' END AS race_class FROM runs GROUP BY ALL""")
def _(spark, d):
    races, n = runs(spark, d).select("race_id", "race_number").distinct(), F.col("race_number")
    lit = F.lit
    html = F.concat(lit("<p>menu, 1000M Turf, Wet</p><h1>Race "), n, lit(" - CUP - "), F.col("race_id"), lit("</h1><p>Saturday, "), F.when(n % 2 == 0, "Sha Tin").otherwise("Happy Valley"), lit(", 12:"), F.lpad(n.cast("string"), 2, "0"), lit("</p><p>"),
                    F.when(n % 3 == 0, "All Weather Track, ").otherwise('Turf, "C+3" Course, '), 1000 + 50 * n, lit("M, Good To Firm</p><p>Prize Money: $"), F.format_number(875000 + n, 0), F.when(n % 5 == 0, ", -, Group Three").otherwise(", Rating: 40 - 0, Class 5"), lit("</p>"))
    return P.card_race(P.page_parts(races.select("race_id", html.alias("html")), "html")).drop("strings", "hrefs", "rows")


@query("runner_profile_pages", """SELECT c_custkey AS horse_id, (2 + c_custkey % 9)::INT AS horse_age, CASE WHEN c_custkey % 4 = 0 THEN 'Mare' ELSE 'Gelding' END AS horse_sex, CASE WHEN c_custkey % 3 <> 0 THEN (1000 * c_custkey)::BIGINT END AS season_stakes_hkd, (5000 * c_custkey)::BIGINT AS total_stakes_hkd, 'Sire Of ' || c_mktsegment AS sire, 'Dam''s Joy' AS dam FROM customer""")
def _(spark, d):
    k, lit = F.col("c_custkey"), F.lit
    season = F.when(k % 3 != 0, F.concat(lit("<p>Season Stakes* : HK$ "), F.format_number(1000 * k, 0), lit("</p>"))).otherwise("<p>Season Stakes : -</p>")
    html = F.concat(lit("<p>Country of Origin / Age : NZ / "), 2 + k % 9, lit("</p><p>Colour / Sex : "), F.when(k % 4 == 0, "Mare").otherwise("Bay / Brown / Gelding"), lit("</p><p>Import Type : PP</p>"), season, lit("<p>Total Stakes* : $"), F.format_number(5000 * k, 0),
                    lit("</p><p>Sire : Sire Of "), F.col("c_mktsegment"), lit("</p><p>Dam : Dam's Joy</p><p>Dam's Sire : Old</p>"))
    return P.runner_profiles(P.page_parts(read(spark, d, "customer").select(k.alias("horse_id"), html.alias("html")), "html"))


@query("names_urls_and_splits", f"""SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'a' ELSE 'a / b' END AS before_last, CASE WHEN s_suppkey % 5 = 0 THEN 'a' ELSE s_suppkey::VARCHAR END AS after_last, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_suppkey || '|x|' || s_nationkey END AS rating_key, s_suppkey % 2 = 0 AS scraped,
'{SITE}/r?RaceDate=2024/03/01&Racecourse=ST&RaceNo=' || s_suppkey AS race_url, '{SITE}/h?HorseId=H' || s_suppkey || '&Option=1' AS horse_url, 'STAR ' || s_suppkey AS horse, 'B' || lpad((s_suppkey % 1000)::VARCHAR, 3, '0') AS brand FROM supplier""")
def _(spark, d):
    from tidemark.functions import text

    k = F.col("s_suppkey")
    both = F.when(k % 5 == 0, " a ").otherwise(F.concat(F.lit("a / b / "), k))
    name, brand = text.name_and_brand(F.concat(F.lit("STAR "), k, F.lit(" (B"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(")")))
    return read(spark, d, "supplier").select(
        "s_suppkey", text.split_last(both, "/", 0).alias("before_last"), text.split_last(both, "/", 1).alias("after_last"), text.rating_key(k, F.when(k % 3 != 0, " x ").otherwise(" "), F.col("s_nationkey")).alias("rating_key"),
        text.is_scraped(F.when(k % 2 == 0, " True").otherwise("no")).alias("scraped"), text.race_url(f"{SITE}/r", F.lit("2024-03-01").cast("date"), F.lit("ST"), k).alias("race_url"), text.horse_url(f"{SITE}/h", F.concat(F.lit("H"), k)).alias("horse_url"), name.alias("horse"), brand.alias("brand"),
    )


@query("lookup_last_wins", f"""WITH {RUNS}, c AS (SELECT horse_id AS h, race_date AS rd, race_number AS rn, 'R' || max(result_id) AS cls, max(result_id)::DOUBLE AS r FROM runs WHERE result_id % 3 = 0 GROUP BY ALL) SELECT result_id, coalesce(cls, race_class) AS race_class, CASE WHEN cls IS NOT NULL THEN r ELSE horse_rating_before END AS horse_rating_before FROM runs LEFT JOIN c ON h = horse_id AND rd = race_date AND rn = race_number""")
def _(spark, d):
    df = runs(spark, d)
    found = df.where("result_id % 3 = 0").select("horse_id", "race_date", "race_number", F.col("result_id").cast("double").alias("r"), F.concat(F.lit("R"), "result_id").alias("cls"), F.col("result_id").alias("seq"))
    cache = found.unionByName(found.withColumns({"cls": F.lit("old"), "r": F.lit(-1.0), "seq": F.col("seq") - 1}))
    out = tables.lookup(df, cache, ["horse_id", "race_date", "race_number"], {"race_class": "cls", "horse_rating_before": "r"}, keep_last_by=F.col("seq"))
    return out.select("result_id", "race_class", "horse_rating_before")


@query("html_table_rows", """SELECT n_regionkey AS page_id, 1 AS table_no, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey)::INT AS row_no, n_name || '|' || n_nationkey || '|' AS cells, '/n?id=' || n_nationkey AS link FROM nation
UNION ALL SELECT DISTINCT n_regionkey, 1, 0, 'Name|Key|', '' FROM nation UNION ALL SELECT DISTINCT n_regionkey, 0, 0, 'menu', '' FROM nation""")
def _(spark, d):
    from tidemark.sources.html_rows import table_rows

    row = F.concat(F.lit('<tr><td><a href="/n?id='), "n_nationkey", F.lit('">'), "n_name", F.lit("</a><td> "), "n_nationkey", F.lit(" &nbsp;<td></tr>"))  # end tags of cells left out
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("row")))), lambda r: r["row"]), "")
    html = F.concat(F.lit("<table><tr><td>menu</table><p>x</p><table><tr><th>Name<th>Key<th></tr>"), rows, F.lit("</table>"))
    found = table_rows(read(spark, d, "nation").groupBy(F.col("n_regionkey").alias("page_id")).agg(html.alias("html")), "page_id", "html")
    return found.select("page_id", "table_no", "row_no", F.array_join("cells", "|").alias("cells"), F.array_max("links").alias("link"))


# ---- contracts collected while rows are written


@query("first_pass_contracts", f"""WITH {RUNS}, r AS (SELECT *, CASE WHEN result_id % 11 = 0 THEN field_size + 1 ELSE field_size END AS size,
  CASE WHEN max(CASE WHEN finishing_position IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY race_id) = 0 THEN 'NO_RESULT' WHEN finishing_position IS NOT NULL THEN 'FINISHED'
       WHEN upper(trim(coalesce(finish_time, ''))) IN ('', '---', '-', 'NAN', 'NONE') THEN 'WITHDRAWN' ELSE 'DISQUALIFIED' END AS status FROM runs),
t AS (SELECT * FROM r UNION ALL SELECT * FROM r WHERE result_id % 100 = 0),
g AS (SELECT race_id, count(*) AS n, count(CASE WHEN finishing_position = 1 THEN 1 END) AS winners, min(size) AS low, max(size) AS high FROM t GROUP BY race_id),
c AS (SELECT count(*) FILTER (status <> 'FINISHED') AS a, count(*) FILTER (finishing_position IS NULL) AS b, count(*) FILTER (status IN ('DISQUALIFIED', 'NO_RESULT', 'WITHDRAWN')) AS c,
  count(*) - count(DISTINCT result_id) AS d, count(*) - count(DISTINCT (race_id, horse_id)) AS e FROM t), k AS (SELECT count(*) FILTER (n < 2) AS f, count(*) FILTER (winners <> 1) AS g, count(*) FILTER (low <> n OR high <> n) AS h FROM g)
SELECT unnest(['only_finished', 'position_known', 'no_bad_status', 'result_id_unique', 'race_horse_unique', 'two_runners', 'one_winner', 'field_size_is_count']) AS contract, unnest([a, b, c, d, e, f, g, h]) AS n FROM c, k""")
def _(spark, d):
    n = F.col("result_id")
    df = cleaning.add_result_status(runs(spark, d)).withColumn("actual_field_size", F.when(n % 11 == 0, F.col("field_size") + 1).otherwise(F.col("field_size")))
    watched, seen = contracts.watched_first_pass(df.unionByName(df.where(n % 100 == 0)))
    watched.write.parquet(f"{shared_dir(spark)}/tidemark/watched-{uuid.uuid4().hex}")
    return spark.createDataFrame(list(seen.get.items()), "contract string, n long")


# ---- extraction that keeps its failures

#: By race_number: no page, a broken page, no prize, no page of results, a table of another kind, rows that are no runners.
OUTCOME = """CASE race_number % 8 WHEN 1 THEN 'REQUEST_FAILED' WHEN 2 THEN 'PARSE_FAILED' WHEN 3 THEN 'SKIP_ZERO_PRIZE' WHEN 4 THEN 'SKIP_NO_RESULTS' WHEN 5 THEN 'SKIP_NO_RESULTS' WHEN 6 THEN 'SKIP_NO_RESULTS' ELSE 'OK' END"""


def _mixed_pages(spark, d):
    """race_id, race_number, html of all races: a third of the kinds of pages has results."""
    df, c = runs(spark, d), F.col
    head = ["Pla.", "Horse No.", "Horse", "Jockey", "Trainer", "Act. Wt.", "Declar. Horse Wt.", "Dr.", "LBW", "Finish Time", "Win Odds"]
    cells = [c("finishing_position"), c("draw"), _horse(), c("jockey"), c("trainer"), c("actual_weight"), c("declared_horse_weight"), c("draw"), c("margin"), c("finish_time"), c("odds")]
    kind = c("race_number") % 8
    before = F.concat(F.lit('<table class="race_tab"><tr><td>RACE '), c("race_number"), F.lit(" (7)</td><td>HK$ "), F.when(kind == 3, "0").otherwise("1,000"), F.lit("</td></tr></table>"))
    pages = _page(df, "race_id", head, cells, before, _lots(spark, d), ' class="performance"', ("race_number",))
    html = (
        F.when(kind == 2, F.concat(F.lit("<p>before</p><![bad["), "html")).when(kind == 4, "<html><body><p>No information.</p></body></html>").when(kind == 5, F.replace("html", F.lit("<th> Jockey </th>"), F.lit("<th> Rider </th>")))
        .when(kind == 6, F.regexp_replace("html", "(?s)</thead>.*</table></div>", "</thead><tr><td>Void</td></tr></table></div>")).when(kind != 1, F.col("html"))
    )
    return pages.select("race_id", "race_number", html.alias("html"))


@query("extraction_outcomes", f"""WITH {RUNS} SELECT race_id, {OUTCOME} AS status, CASE WHEN race_number % 8 = 2 THEN 'AssertionError: unknown status keyword ''bad'' in marked section' END AS message,
CASE WHEN race_number % 8 IN (0, 3, 7) THEN count(*) WHEN race_number % 8 = 6 THEN 0 END::INT AS n_runners FROM runs GROUP BY race_id, race_number""")
def _(spark, d):
    return X.outcomes(_mixed_pages(spark, d)).select("race_id", "status", "message", F.when(F.col("runners").isNotNull(), F.size("runners")).alias("n_runners"))


@query("extraction_counters", f"""WITH {RUNS}, o AS (SELECT {OUTCOME} AS status, count(*) AS n FROM runs GROUP BY race_id, race_number)
SELECT status AS counter, count(*) AS n FROM o GROUP BY status UNION ALL SELECT 'pages', count(*) FROM o UNION ALL SELECT 'runners', sum(n)::BIGINT FROM o WHERE status = 'OK'""")
def _(spark, d):
    counts = X.extract(_mixed_pages(spark, d), f"{shared_dir(spark)}/tidemark/outcomes-{uuid.uuid4().hex}")
    return spark.createDataFrame(list(counts.items()), "counter string, n long")


@query("extracted_runners", f"""WITH {RUNS} SELECT race_id || '_HK_' || horse_id AS result_id, (count(*) OVER (PARTITION BY race_id))::INT AS field_size, draw AS horse_number, finishing_position, odds FROM runs WHERE race_number % 8 IN (0, 7)""")
def _(spark, d):
    return X.runner_rows(X.outcomes(_mixed_pages(spark, d)), SITE).select("result_id", "field_size", "horse_number", "finishing_position", "odds")


# ---- discovery, and cards with profiles


def day_pages(spark, d):
    """(day, code, html) of the days and courses with races; a page in seven is broken."""
    shown = F.concat(F.lit("<b>race "), F.col("race_number"), F.lit(" of 12</b>"))
    pages = runs(spark, d).groupBy(F.col("race_date").alias("day"), F.col("racecourse_code").alias("code")).agg(F.array_join(F.collect_list(shown), " ").alias("html"))
    return pages.withColumn("html", F.when(F.dayofyear("day") % 7 == 3, F.concat(F.lit("<![bad["), "html")).otherwise(F.col("html")))


@query("meeting_discovery", f"""WITH {RUNS} SELECT DISTINCT race_date AS day, racecourse_code AS code, race_number AS number, racecourse_code || '_' || strftime(race_date, '%Y%m%d') || '_R' || lpad(CAST(race_number AS VARCHAR), 2, '0') AS race_id FROM runs WHERE dayofyear(race_date) % 7 <> 3""")
def _(spark, d):
    place = f"{shared_dir(spark)}/tidemark/discovery-{uuid.uuid4().hex}"
    days = generators.days_of(read(spark, d, "events"), "ts", 5, 5).select("day", F.explode(F.array(F.lit("ST"), F.lit("HV"))).alias("code"))
    pages = settled(day_pages(spark, d), "day_pages")
    for part in (0, 1):  # tasks come up in two lots; each run does what is new, and a third one nothing
        days.where(F.dayofmonth("day") % 2 == part).write.mode("append").parquet(f"{place}/tasks")
        discovery.discover(spark, f"{place}/tasks", pages, f"{place}/races", f"{place}/checkpoint")
    discovery.discover(spark, f"{place}/tasks", pages, f"{place}/races", f"{place}/checkpoint")
    return spark.read.parquet(f"{place}/races")


@query("cards_with_profiles", f"""WITH {RUNS}, p AS (SELECT DISTINCT horse_id, 'Sire ' || horse_id AS sire FROM runs WHERE horse_id % 3 <> 0)
SELECT result_id, CASE WHEN race_number % 3 = 0 THEN 'HV' WHEN race_number % 3 = 1 THEN 'ST' END AS racecourse_code, coalesce(p.sire, 'unknown') AS sire,
       row_number() OVER (ORDER BY CASE WHEN race_number % 3 = 0 THEN 'HV' WHEN race_number % 3 = 1 THEN 'ST' END NULLS FIRST, coalesce(nullif(race_number, 0), 999), coalesce(nullif(draw - 1, 0), 999), result_id) - 1 AS place
FROM runs LEFT JOIN p ON p.horse_id = runs.horse_id""")
def _(spark, d):
    df, n = runs(spark, d), F.col("race_number")
    link = F.when(n % 3 == 0, "/card?x=1&Racecourse=HV").otherwise("/card")
    df = df.select("result_id", "race_number", "horse_id", (F.col("draw") - 1).alias("horse_number"), P.venue(link, F.when(n % 3 == 1, "Sha Tin, 12:30").otherwise("Elsewhere")).alias("racecourse_code"), F.lit("unknown").alias("sire"))
    known = df.where("horse_id % 3 <> 0").select("horse_id", F.concat(F.lit("Sire "), "horse_id").alias("sire")).distinct()
    cards = P.with_profiles(df, known, ["sire"])
    return P.card_places(cards, ["result_id"]).select("result_id", "racecourse_code", "sire", "place")
