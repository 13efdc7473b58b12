"""Meetings found day by day: runs do what is new, days without a meeting add nothing."""

from __future__ import annotations

import datetime

from tidemark.sources.generators import days_of
from tidemark.streaming import discovery

PAGE = "<b>race {} of 9</b>"


def day(n):
    return datetime.date(2024, 1, n)


def test_runs_resume_and_drop_days_without_a_meeting(spark, tmp_path):
    tasks, out, checkpoint = (str(tmp_path / n) for n in ("tasks", "races", "checkpoint"))
    pages = [(day(1), "ST", "".join(PAGE.format(i) for i in (2, 1))), (day(2), "ST", "<p>No meeting.</p>"), (day(3), "HV", PAGE.format(7)), (day(4), "ST", "<![bad[" + PAGE.format(1)), (day(5), "ST", None), (day(9), "ST", PAGE.format(1))]
    known = spark.createDataFrame(pages, "day date, code string, html string")

    def add(*rows):
        spark.createDataFrame(list(rows), discovery.TASKS).coalesce(1).write.mode("append").parquet(tasks)

    def run():
        discovery.discover(spark, tasks, known, out, checkpoint, files_per_batch=1)
        return sorted((r["day"].day, r["code"], r["number"], r["race_id"]) for r in spark.read.parquet(out).collect())

    first = [(1, "ST", 1, "ST_20240101_R01"), (1, "ST", 2, "ST_20240101_R02")]
    add((day(1), "ST"), (day(2), "ST"), (day(6), "ST"))
    assert run() == first == run()
    add((day(3), "HV"), (day(3), "ST"))
    add((day(4), "ST"), (day(5), "ST"))
    assert run() == [*first, (3, "HV", 7, "HV_20240103_R07")] == run()


def test_days_of_a_table(spark):
    df = spark.createDataFrame([(day(3),), (day(5),), (None,)], "d date")
    assert [r["day"].day for r in days_of(df, "d", 1, 2).orderBy("day").collect()] == [2, 3, 4, 5, 6, 7]
    assert days_of(df.where("d is null"), "d").count() == 0
