"""Scalar rules, stateful operators and properties on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import numbers, text
from tidemark.operators import elo, tables
from tidemark.operators import windows as W
from tidemark.plans import cleaning, features, manifest, queries
from tidemark.plans.runs import ORDER, runs
from tidemark.sources import html_rows, sinks


def one(spark, column, *values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_margins_times_classes(spark):
    assert one(spark, text.margin_lengths, "1-1/2", "3/4", "2", "+NK", "DH", "N", "SH", "HD", "---", "ML", "", "1/0", "-1", None) == [1.5, 0.75, 2.0, 0.25, 0.0, 0.05, 0.1, 0.2, None, None, None, None, None, None]
    assert one(spark, text.finish_seconds, "1:09.50", "57.3", "1.09.50", "---", None) == [69.5, 57.3, None, None, None]
    assert one(spark, text.class_number, "4", "Class 4", "G1", "4.0") == [4.0, None, None, None]


def test_integers(spark):
    assert one(spark, text.parse_integer, "1,067", "3 DH", "-5", "x") == [1, 3, -5, None]
    assert one(spark, text.parse_int, "1,067", "3 DH", "-5", "x") == [1067, 3, -5, None]


def test_text(spark):
    assert one(spark, text.clean_text, None, " a 　b\n", "") == ["", "a b", ""]
    assert one(spark, text.with_query_option, "http://x/h?option=0&HorseId=A1#top", "http://x/h") == ["http://x/h?HorseId=A1&Option=1#top", "http://x/h?Option=1"]
    assert one(spark, lambda c: text.id_from_url(c), "http://x?HORSEID=A%20B&x=1", "http://x") == ["A B", None]
    assert one(spark, text.text_flag, "True", "0", "maybe", None) == [1, 0, None, None]
    assert one(spark, lambda c: text.label_value(c, "Sire", ("Sire", "Dam")), "Sire: A B Dam: C", "Dam: C") == ["A B", None]


def test_buckets(spark):
    assert one(spark, numbers.going_bucket, "GOOD TO FIRM", "GOOD", "GOOD TO YIELDING", "SOFT", "WET FAST", "FAST", "GOOD TO SLOW", None) == ["firm", "good", "yielding", "soft", "wet", "fast", "other", "other"]
    assert one(spark, numbers.distance_bucket, 1200, 1400, 1650, 1800, 2200, None, kind="int") == ["sprint_1200_or_less", "1400", "mile_1600_1650", "middle_1800_2000", "staying_over_2000", None]


def test_payout(spark):
    from tidemark.operators.aggregates import payout_shares

    rows = [("a", dt.date(2023, 9, 9), p) for p in (1, 1, 3, None)] + [("b", dt.date(2023, 9, 10), p) for p in (5, 6)]
    df = payout_shares(spark.createDataFrame(rows, "race string, day date, pos int"), "race", "pos", "day")
    found = sorted((r["race"], r["pos"] or 0, round(r["share"], 6)) for r in df.collect())
    assert found == [("a", 0, 0.0), ("a", 1, 0.385), ("a", 1, 0.385), ("a", 3, 0.115), ("b", 5, 0.035), ("b", 6, 0.02)]


def test_rolling_frame(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    df = spark.createDataFrame([("x", d, 1) for d in days], "k string, d date, n int").withColumn("day", W.day_number(F.col("d")))
    assert [r[0] for r in df.select(F.sum("n").over(W.days_before(["k"], "day", 30)).alias("n"), "d").orderBy("d").collect()] == [None, 1, 1]


def test_ranks_and_lead(spark):
    df = spark.createDataFrame([("r", 1, 10.0), ("r", 2, 20.0), ("r", 3, 20.0), ("r", 4, None)], "k string, i int, x double")
    out = df.select("i", W.rank_min(F.col("x"), ["k"]).alias("m"), W.rank_pct(F.col("x"), ["k"]).alias("p"), W.lead_or(F.col("x"), F.lit(65.0), ["k"], ["i"]).alias("n")).orderBy("i").collect()
    assert [r["m"] for r in out] == [3, 1, 1, None]
    assert [None if r["p"] is None else round(r["p"], 4) for r in out] == [0.3333, 0.8333, 0.8333, None]
    assert [r["n"] for r in out] == [20.0, 20.0, None, 65.0]


def test_lookup_keeps_the_last_duplicate_and_unmatched_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    dim = spark.createDataFrame([(1, "x", 1), (1, None, 2)], "k int, w string, seq int")
    out = tables.lookup(df, dim, ["k"], {"v": "w"}, keep_last_by=F.col("seq"))
    assert sorted(((r["k"] or 0), r["v"]) for r in out.collect()) == [(0, "c"), (1, None), (2, "b")]


def test_group_exclusion_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 9), ("b", 1), (None, 9)], "k string, v int")
    assert sorted(str(r["k"]) for r in tables.without_groups(df, "k", F.col("v") == 9).collect()) == ["None", "b"]


def test_elo_conserves_and_matches_a_plain_fold(spark, sf):
    df = runs(spark, sf)
    found = {r["result_id"]: r["horse_elo_before"] for r in elo.add_elo(df).collect()}
    ratings: dict = {}
    races: dict = {}
    for r in df.orderBy(*ORDER).collect():
        races.setdefault((r["race_date"], r["race_number"], r["race_id"]), []).append(r)
    for key in sorted(races):
        own = races[key]
        before = [ratings.get(r["horse_id"], 1500.0) for r in own]
        for r, b in zip(own, before, strict=True):
            assert found[r["result_id"]] == pytest.approx(b, abs=1e-9)
        placed = [i for i, r in enumerate(own) if r["finishing_position"] is not None]
        if len(placed) < 2:
            continue
        total = sum(before)
        new = list(before)
        for i in placed:
            diff = 0.0
            for j in placed:
                if i != j:
                    a, b = own[i]["finishing_position"], own[j]["finishing_position"]
                    diff += (1.0 if a < b else 0.5 if a == b else 0.0) - 1 / (1 + 10 ** ((before[j] - before[i]) / 400))
            new[i] += 16 * diff / (len(placed) - 1)
        assert sum(new) == pytest.approx(total)
        for r, x in zip(own, new, strict=True):
            ratings[r["horse_id"]] = x


def test_no_leakage(spark, sf):
    """Other outcomes from a day on change no feature of that day or before."""
    day = dt.date(2024, 1, 15)
    df = runs(spark, sf)
    other = df.withColumn("finishing_position", F.when(F.col("race_date") >= F.lit(day), 15 - F.col("finishing_position")).otherwise(F.col("finishing_position")))

    def built(x):
        x = features.base_helpers(x)
        x = features.context_history(features.entity_form(x, "trainer", "trainer"), {"surface": ["surface"]})
        return sorted(tuple(map(str, r)) for r in x.where(F.col("race_date") <= F.lit(day)).where("race_number = 0 or race_date < date '2024-01-15'").select("result_id", "trainer_career_win_rate_before", "trainer_win_rate_30d", "horse_surface_wins_before").collect())

    assert built(df) == built(other)


def test_cleaning_and_contracts(spark):
    rows = [("a", "h1", 1, "1:00.0", None), ("a", "h2", 2, "1:01.0", None), ("b", "h1", None, "---", None), ("b", "h2", None, "", None), ("c", "h1", 1, "1:0", None), ("c", "h2", None, "1:00.1", None),
            ("d", "h1", 1, "1:0", "DH"), ("d", "h2", 1, "1:0", "DH"), ("e", "h1", 1, "1:0", None), ("e", "h2", None, "---", None), ("e", "h3", 3, "1:0", None)]
    df = spark.createDataFrame([(f"{r}_{h}", r, h, p, t, m) for r, h, p, t, m in rows], "result_id string, race_id string, horse_id string, finishing_position int, finish_time string, margin string")
    done = cleaning.add_result_status(df)
    status = {(r["race_id"], r["horse_id"]): r["result_status"] for r in done.collect()}
    assert status[("b", "h1")] == "NO_RESULT" and status[("c", "h2")] == "DISQUALIFIED" and status[("e", "h2")] == "WITHDRAWN" and status[("a", "h1")] == "FINISHED"
    left = cleaning.first_pass(done)
    assert sorted((r["race_id"], r["horse_id"], r["actual_field_size"]) for r in left.collect()) == [("a", "h1", 2), ("a", "h2", 2), ("e", "h1", 2), ("e", "h3", 2)]
    assert {r["contract"]: r["n"] for r in cleaning.violations(left).collect()} == dict.fromkeys(("only_finished", "position_known", "result_id_unique", "race_horse_unique", "two_runners", "one_winner", "field_size_is_count"), 0)


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("v", F.lit("x"))
    for codec in ("zstd", "snappy", "gzip"):
        assert sinks.write_checked(df, f"file://{tmp_path}/t", codec).count() == 10
    with pytest.raises(ValueError):
        sinks.write_checked(df, f"file://{tmp_path}/t", "lzo")
    sinks.append_new(df, f"file://{tmp_path}/a", "id")
    sinks.append_new(spark.range(5, 15).withColumn("v", F.lit("y")), f"file://{tmp_path}/a", "id")
    assert spark.read.parquet(f"file://{tmp_path}/a").groupBy("v").count().orderBy("v").collect() == [("x", 10), ("y", 5)]
    (tmp_path / "x.csv").write_text("a,b\nNA,\n1,2\n")
    assert [tuple(r) for r in sinks.csv_text(spark, f"file://{tmp_path}/x.csv", ["a", "b"]).collect()] == [("NA", ""), ("1", "2")]


def test_html_rows():
    page = "<table><tr><th>Pla.<th>Horse<tr><td>1<td><a href='?horseid=A1'>X  Y</a></table><p>no</p>"
    assert html_rows.page_rows(page) == [(0, 0, ["Pla.", "Horse"], ["", ""]), (0, 1, ["1", "X Y"], ["", "?horseid=A1"])]
    assert html_rows.page_rows(None) == []


def test_feature_columns(spark, sf):
    df = runs(spark, sf).withColumns({"country_of_origin": F.lit("NZ"), "hemisphere_of_origin": F.lit("Northern"), "career_win_rate_before": F.lit(0.1)})
    built = features.build_features(df)
    assert built.columns[: len(df.columns)] == df.columns
    known = {*queries._built_names(), "country_of_origin", "hemisphere_of_origin", "hemisphere_of_origin_derived", "hemisphere_mapping_conflict", "career_win_rate_before", "career_win_rate_vs_field_mean", "career_win_rate_rank_in_field"}
    assert set(built.columns) == known and len(built.columns) == len(known)
    assert len(known - set(df.columns)) == 569
    used, categorical = manifest.predictors([*built.columns, "is_winner", "result_status", "horse_name", "is_dead_heat", "brand_number", "career_prize_money_before", "actually_started"])
    assert not {"odds", "finishing_position", "is_winner", "result_status", "horse_name", "is_dead_heat", "brand_number", "career_prize_money_before", "actually_started", "race_date"} & set(used)
    assert "last3_jockey" in categorical and categorical == sorted(categorical)


def test_build_job(spark, sf, tmp_path):
    import json

    from tidemark.plans import build, contracts

    df = runs(spark, sf).where("race_date < date '2024-01-06'").withColumns({"horse_name": F.lit("X"), "is_winner": F.coalesce(F.col("finishing_position") == 1, F.lit(False)).cast("int"), "is_top_three": F.coalesce(F.col("finishing_position") <= 3, F.lit(False)).cast("int")})
    history, rows, output = (f"file://{tmp_path}/{n}" for n in ("history", "rows", "output"))
    df.write.parquet(history)
    df.where("race_date >= date '2024-01-04'").write.parquet(rows)
    config = build.Config.from_args(["--history", history, "--rows", rows, "--output", output, "--history-lags", "1"])
    built = build.run(spark, config)
    assert built.count() == spark.read.parquet(rows).count() > 0
    made = json.loads((tmp_path / "output.features.json").read_text())
    assert made["generated_feature_count"] == len(built.columns) - len(df.columns) and "is_winner" not in made["recommended_predictor_columns"]
    back = contracts.in_emit_order(built, spark.read.parquet(rows).withColumn("place", -F.col("result_id")), "place").select("result_id").collect()
    assert [r[0] for r in back] == sorted((r[0] for r in back), reverse=True)
    with pytest.raises(ValueError, match="lacks"):
        contracts.validate_emit(spark.read.parquet(rows), df)
    with pytest.raises(ValueError, match="history_ids_repeated"):
        contracts.validate_emit(df.union(df), df)
    report = sinks.size_report(spark, history, output)
    assert report["source_mb"] > 0 and report["reduction_percent"] == pytest.approx(100 * (1 - report["made_mb"] / report["source_mb"]))


def test_date_range_errors(spark):
    from tidemark.plans import contracts

    df = spark.createDataFrame([("2024-01-01",), ("2024-01-05 10:00:00",)], "day string")
    assert contracts.date_range(df, "day", "2024-01-01", "2024-01-04").count() == 1
    for bad, start, end in ((df, "2024-02-01", "2024-01-01"), (df, "2025-01-01", "2025-01-02"), (df.union(spark.createDataFrame([("x",)], "day string")), "2024-01-01", "2024-01-02")):
        with pytest.raises(ValueError):
            contracts.date_range(bad, "day", start, end)


def test_countries(spark):
    from tidemark.functions import dates

    df = spark.createDataFrame([("NZ",), (" gb ",), ("KOR",), ("ZIM",), ("URU",), ("ITY",), ("PER",), ("",), (None,)], "c string")
    rows = df.select(dates.hemisphere(F.col("c")), dates.derived_hemisphere(F.col("c")), numbers.conflict(dates.derived_hemisphere(F.col("c")), F.lit("Northern"))).collect()
    assert [tuple(r) for r in rows] == [
        ("Southern", "Southern", 1), ("Northern", "Northern", 0), ("Other", None, 0), ("Southern", None, 0), ("Other", "Southern", 1), ("Other", "Northern", 0), ("Other", None, 0), ("Other", None, 0), ("Other", None, 0),
    ]


def test_small_rules(spark):
    df = spark.createDataFrame([(2.5, None, 3.0, None), (1.0, 12.0, None, "1.0"), (None, None, None, "Y")], "a double, b double, c double, flag string")
    rows = df.select(text.form_string([F.col(c) for c in "abc"]), text.text_flag(F.col("flag")), numbers.time_split(F.lit(None).cast("date"), "2024-01-01", "2025-01-01")).collect()
    assert [tuple(r) for r in rows] == [("2.5-3", None, "test"), ("1-12", None, "test"), ("", 1, "test")]


def test_stream_appends_once(spark, sf, tmp_path):
    from tidemark.streaming.append import append_once, read_stream

    source = spark.read.parquet(f"{sf}/events.parquet")
    source.union(source).write.parquet(f"file://{tmp_path}/in")
    stream = read_stream(spark, f"file://{tmp_path}/in", source.schema)
    append_once(stream, "event_id", "ts", "60 days", f"file://{tmp_path}/out", f"file://{tmp_path}/ck").awaitTermination()
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == source.count()


def test_manifest_of_the_whole_build(spark, sf):
    rows = {r["column"]: (r["predictor"], r["categorical"]) for r in queries.QUERIES["manifest_predictors"](spark, sf).collect()}
    assert rows["form_last5_latest_first"] == (True, True)
    assert any(c.startswith("last10_") for c in rows) and any("elo" in c for c in rows)
