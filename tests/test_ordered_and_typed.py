"""Orders of files, types of columns, division, pairs, and contracts that are counted while rows are written."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.operators import tables
from tidemark.plans import build, contracts
from tidemark.plans.runs import runs
from tidemark.sources import ordered, sinks, typed

# ---- orders


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_source_order_is_that_of_the_files(spark, tmp_path, fmt):
    for part in range(3):
        df = spark.range(part * 1000, part * 1000 + 1000).select((F.col("id") * 7919 % 3001).alias("v"))
        df.coalesce(1).write.option("header", True).format(fmt).save(str(tmp_path / f"p{part}"))
        next((tmp_path / f"p{part}").glob(f"part-*.{fmt}*")).rename(tmp_path / f"f{part}.{fmt}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        scan = spark.read.option("header", True).format(fmt).load([str(tmp_path / f"f{i}.{fmt}") for i in (2, 0, 1)])
        found = {r["_row_id"]: int(r["v"]) for r in ordered.with_source_order(scan, blocks=7).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [found[i] for i in range(3000)] == [i * 7919 % 3001 for i in range(3000)]


def test_written_order_is_kept_and_faults_are_found(spark, tmp_path):
    df = spark.range(5000).select(F.col("id"), F.xxhash64("id").alias("_place"))
    ordered.write_in_order(df, ["_place"], str(tmp_path / "t"), files=5)
    wanted = sorted((r["_place"], r["id"]) for r in df.collect())
    found = sorted((r["_position"], r["id"]) for r in ordered.with_positions(spark, str(tmp_path / "t")).collect())
    assert [i for _, i in found] == [i for _, i in wanted] and spark.read.parquet(str(tmp_path / "t")).columns == ["id"]
    places = spark.createDataFrame([(i, n) for n, (_, i) in enumerate(wanted)], "id long, place long")
    assert ordered.misplaced(spark, str(tmp_path / "t"), places, "id", "place").first()["n"] == 0
    swapped = places.withColumn("place", F.when(F.col("place") == 10, 20).when(F.col("place") == 20, 10).otherwise(F.col("place")))
    assert ordered.misplaced(spark, str(tmp_path / "t"), swapped, "id", "place").first()["n"] == 2
    assert ordered.misplaced(spark, str(tmp_path / "t"), places.where("place < 4999"), "id", "place").first()["n"] == 1


# ---- types


def test_types_of_columns(spark):
    rows = [("1", "1", "1", "true", "2024-01-01", "", "x", "1"), (" 7 ", "2.5", "NA", "FALSE", "2024-02-29", "NA", "1", "2024-01-01"), ("-3", "1e3", "x", "nan", None, None, None, "2"), ("NA", "inf", "2", None, "NaN", "null", "2.5", "3")]
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], "k string, a string, b string, c string, d string, e string, f string, g string, `h.x` string").repartition(3)
    found = {t.name: t for t in typed.column_types(df.drop("k"))}
    assert {n: t.type for n, t in found.items()} == {"a": "bigint", "b": "double", "c": "string", "d": "boolean", "e": "date", "f": "string", "g": "string", "h.x": "string"}
    assert (found["a"].n, found["a"].missing, found["f"].missing) == (4, 1, 4)
    table, types = typed.typed(df, "k")
    assert table.schema["a"].dataType.simpleString() == "bigint" and [r["a"] for r in table.orderBy("k").collect()] == [1, 7, -3, None]
    assert [r["c"] for r in table.orderBy("k").collect()] == ["1", None, "x", "2"] and types["h.x"] == "string"
    refused = typed.rejected(df, {"a": "bigint", "c": "double", "e": "bigint"}, "k")
    assert sorted(map(tuple, refused.collect())) == [("0", "e", "2024-01-01"), ("1", "e", "2024-02-29"), ("2", "c", "x")]
    assert typed.column_types(df.limit(0).select("a"))[0].type == "string" and typed.rejected(df, {"c": "string"}, "k").count() == 0


def test_parts_of_a_table_can_be_typed_apart(spark):
    df = spark.createDataFrame([(str(i), str(i) if i < 50 else f"{i}.5") for i in range(100)], "a string, b string")
    halves = [typed.column_types(df.where(c)) for c in ("a < 50", "a >= 50")]
    joined = [x.joined(y) for x, y in zip(*halves, strict=True)]
    assert joined == typed.column_types(df) and [t.type for t in joined] == ["bigint", "double"] and halves[0][1].type == "bigint"


def test_numbers_too_long_and_bad_dates_are_no_integers_or_dates(spark):
    df = spark.createDataFrame([("99999999999999999999", "2024-02-30"), ("1", "2024-02-28")], "a string, b string")
    assert [t.type for t in typed.column_types(df)] == ["double", "string"]


def test_csv_is_typed_by_all_its_cells(spark, tmp_path):
    (tmp_path / "x.csv").write_text("result_id,n,m,t\n" + "".join(f"{i},{i}, {i} ,{'NA' if i % 2 else i / 4}\n" for i in range(500)) + "500,,x,\n")
    df = sinks.csv_inferred(spark, str(tmp_path / "x.csv"), "result_id")
    assert df.dtypes == [("result_id", "string"), ("n", "bigint"), ("m", "string"), ("t", "double")] and df.count() == 501


# ---- division and pairs


def test_division(spark):
    need = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 1), ("c", None), ("d", -1), ("d", 5), (None, 1), ("e", 1)], "g string, k int")
    have = spark.createDataFrame([("a", 1, "x", 1), ("a", 2, "", 1), ("a", 2, "y", 2), ("b", 1, "z", 1), ("b", 1, " ", 2), ("d", 5, "v", 1), (None, 1, "w", 1), ("f", 1, "u", 1), ("c", None, "t", 1), ("e", 1, None, 1)], "g string, k int, v string, at int")
    found = tables.for_all(need, have, "g", ["k"], F.col("k") > 0, F.trim("v") != "", ["at"])
    assert {r["g"]: tuple(r)[1:] for r in found.collect()} == {"a": (2, 2, True), "b": (1, 0, False), "c": (0, 0, False), "d": (1, 1, True), "e": (1, 0, False)}
    assert tables.for_all(need.limit(0), have, "g", ["k"], F.lit(True), F.lit(True)).count() == 0
    assert {r["complete"] for r in tables.for_all(need, have.limit(0), "g", ["k"], F.lit(True), F.lit(True)).collect()} == {False}


def test_pairs_of_groups(spark):
    rows = [("a", i, i * i) for i in range(5)] + [("b", 1, 1), (None, 1, 2), (None, 2, 3)]
    found = tables.pairs_in_group(spark.createDataFrame(rows, "g string, i int, x int").repartition(3), ["g"], "i", ["x"]).collect()
    wanted = [(g, (i, x), (j, y)) for (g, i, x), (h, j, y) in itertools.combinations(rows, 2) if g == h]
    assert sorted(((r["g"], tuple(r["a"]), tuple(r["b"])) for r in found), key=repr) == sorted(wanted, key=repr)


# ---- contracts while writing


def test_output_contracts_are_counted_while_it_is_written(spark, tmp_path):
    rows = spark.createDataFrame([(i, 9 - i) for i in range(10)], "result_id long, _row_id long")
    built = spark.createDataFrame([(i, 2.0 if i == 4 else 1.0) for i in range(12) if i != 3] + [(5, 0.0)], "result_id long, is_winner double")
    joined, watch, seen = contracts.watched_output(built, rows, "_row_id")
    back = sinks.write_checked(joined, str(tmp_path / "out"), order=["_row_id"], watch=watch)
    assert seen.get == {"target_not_0_or_1": 1, "rows_missing": 1, "output_ids_repeated": 1, "rows_too_many": 3}
    assert back.columns == ["result_id", "is_winner"] and back.count() == 10
    with pytest.raises(ValueError, match="output_ids_repeated"):
        contracts.require(seen.get, "the output")


def test_a_refused_output_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_checked(spark.range(3), path)

    def refuse(staged):
        assert spark.read.parquet(staged).count() == 5
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        sinks.write_checked(spark.range(5), path, accept=refuse)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_the_build_writes_rows_in_the_order_asked_for(spark, sf, tmp_path):
    flags = {"horse_name": F.lit("X"), "is_winner": F.coalesce(F.col("finishing_position") == 1, F.lit(False)).cast("int"), "is_top_three": F.lit(0)}
    df = runs(spark, sf).where("race_date < date '2024-01-04'").withColumns(flags)
    history, rows, output = (str(tmp_path / n) for n in ("history", "rows.csv", "output"))
    df.write.parquet(history)
    some = df.where("race_date >= date '2024-01-03'").orderBy(F.xxhash64("result_id"))
    some.coalesce(1).write.option("header", True).csv(str(tmp_path / "csv"))
    next((tmp_path / "csv").glob("part-*.csv")).rename(rows)
    wanted = [int(x.split(",")[0]) for x in (tmp_path / "rows.csv").read_text().splitlines()[1:]]
    build.run(spark, build.Config.from_args(["--history", history, "--rows", rows, "--output", output, "--history-lags", "1"]))
    found = sorted((r["_position"], r["result_id"]) for r in ordered.with_positions(spark, output, ["result_id"]).collect())
    assert [i for _, i in found] == wanted and len(wanted) > 20
