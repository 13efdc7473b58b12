"""Discovery of meetings, day by day: a stream over a table of day tasks that keeps what it has done.

Tasks are appended to a folder as they come up; a run takes those that no earlier run has finished (``availableNow``), looks
at the day's page of each, and appends the races of days that have a meeting. Days without one, or whose page can't be read, add
nothing. The checkpoint makes runs resume: a second run over the same tasks adds nothing, and a run that was killed is
taken up where its last batch was committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import race_key
from tidemark.sources import extraction, race_pages
from tidemark.streaming.append import read_stream

TASKS = "day date, code string"


def races_of_days(tasks: DataFrame, pages: DataFrame) -> DataFrame:
    """day, code, number, race_id of the races that the pages (day, code, html) of the tasks name."""
    known = pages.select(F.col("day").alias("_day"), F.col("code").alias("_code"), "html")
    with_page = tasks.join(known, (F.col("day") == F.col("_day")) & (F.col("code") == F.col("_code"))).select("day", "code", "html")
    found = race_pages.race_numbers(extraction.captured_parts(with_page, "html").where("failure is null"))
    races = found.select("day", "code", F.explode("race_numbers").alias("number")).where("number is not null")
    return races.withColumn("race_id", race_key(F.col("code"), F.col("day"), F.col("number")))


def discover(spark: SparkSession, tasks: str, pages: DataFrame, out: str, checkpoint: str, files_per_batch: int = 16) -> None:
    """Do the tasks in the folder ``tasks`` that haven't been done, and append their races to ``out``."""
    races = races_of_days(read_stream(spark, tasks, TASKS, files_per_batch), pages)
    run = races.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
