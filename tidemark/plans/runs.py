"""Runs and fields over the events table: an hour is a race, a user a horse, so every operator meets real groups and ties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Portable between Spark and DuckDB; {events} is the table.
RUNS_SQL = """
SELECT event_id AS result_id, race_id, race_date, race_number, race_number AS race_index, horse_id, trainer, jockey,
       CASE WHEN race_number % 2 = 0 THEN 'ST' ELSE 'HV' END AS racecourse_code, event_type AS surface,
       concat('C', cast(event_id % 3 AS varchar(9))) AS course,
       CASE event_id % 6 WHEN 0 THEN 'GOOD' WHEN 1 THEN 'GOOD TO FIRM' WHEN 2 THEN 'GOOD TO YIELDING' WHEN 3 THEN 'SOFT' WHEN 4 THEN 'WET FAST' ELSE NULL END AS going,
       cast(1000 + 200 * (event_id % 8) AS int) AS distance_m, cast(1 + event_id % 6 AS varchar(9)) AS race_class,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE cast(40 + event_id % 60 AS double) END AS horse_rating_before,
       cast(41 + event_id % 61 AS double) AS horse_rating_after, cast(113 + event_id % 20 AS int) AS actual_weight,
       cast(1000 + event_id % 200 AS int) AS declared_horse_weight, cast(1 + event_id % 14 AS int) AS draw,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE 1.5 + (event_id % 97) / 4.0E0 END AS odds,
       CASE WHEN event_type = 'error' THEN NULL ELSE cast(rank() OVER (PARTITION BY race_id, event_type = 'error' ORDER BY floor(value / 5) DESC) AS int) END AS finishing_position,
       CASE event_id % 9 WHEN 0 THEN 'DH' WHEN 1 THEN '1-1/2' WHEN 2 THEN '3/4' WHEN 3 THEN '2' WHEN 4 THEN 'NK' WHEN 5 THEN '---' WHEN 6 THEN 'SH' WHEN 7 THEN '' ELSE NULL END AS margin,
       CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '---' ELSE concat('1:', lpad(cast(event_id % 60 AS varchar(9)), 2, '0'), '.', lpad(cast(event_id % 100 AS varchar(9)), 2, '0')) END AS finish_time,
       cast(count(*) OVER (PARTITION BY race_id) AS int) AS field_size, cast(event_id % 40 AS int) AS career_starts_before,
       cast(1000 * (event_id % 500) AS double) AS prize_money_hkd, value
FROM (
  SELECT *, row_number() OVER (PARTITION BY race_id, horse_id ORDER BY event_id DESC) AS n
  FROM (SELECT event_id, event_type, value, user_id AS horse_id, concat('T', cast(user_id % 7 AS varchar(9))) AS trainer,
               concat('J', cast(event_id % 11 AS varchar(9))) AS jockey, cast(ts AS date) AS race_date,
               cast(extract(hour FROM ts) AS int) AS race_number,
               concat(substr(cast(cast(ts AS date) AS varchar(10)), 1, 10), '_', lpad(cast(extract(hour FROM ts) AS varchar(9)), 2, '0')) AS race_id
        FROM {events}) AS e) AS d
WHERE n = 1
"""

ORDER = ["race_date", "race_number", "race_id", "result_id"]


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RUNS_SQL, events=spark.read.parquet(f"{sf_dir}/events.parquet"))
