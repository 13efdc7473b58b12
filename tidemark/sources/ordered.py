"""Order of rows in files: numbered as they stand in a source, written in an order, and checked when read back.

No step sorts the table in one task: rows are numbered by ``operators.scans.in_order`` (range partitions, their counts, a
running total of a row a partition), and an ordered table is a folder of files, each sorted, whose names follow the order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import scans
from tidemark.operators import windows as W


def with_source_order(df: DataFrame, name: str = "_row_id", blocks: int | None = None) -> DataFrame:
    """A scan of files with a dense number from 0: by file name, then by place in the file. ``df`` must be a plain scan, whose
    tasks read a file's blocks from front to back."""
    placed = df.select("*", F.input_file_name().alias("_source_file"), F.input_file_block_start().alias("_source_start"), F.monotonically_increasing_id().alias("_source_row"))
    source = ["_source_file", "_source_start", "_source_row"]
    return scans.in_order(placed, source, name, blocks).drop(*source)


def write_in_order(df: DataFrame, order: Sequence[str], path: str, files: int | None = None, codec: str = "zstd", watch: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Parquet files that hold the rows in the order given: within each file, and from file to file by name. One range exchange;
    the columns of ``order`` that start with an underscore are left out. ``watch`` is put on the sorted rows, which go by once:
    what is observed before a range exchange is counted again as it is sampled."""
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_last() for c in order]
    sorted_rows = df.repartitionByRange(files, *by).sortWithinPartitions(*by)
    sorted_rows = sorted_rows if watch is None else watch(sorted_rows)
    sorted_rows.drop(*[c for c in order if c.startswith("_")]).write.option("compression", codec).parquet(path)


def with_positions(spark: SparkSession, path: str, columns: Sequence[str] | None = None, name: str = "_position") -> DataFrame:
    """A Parquet table with each row's position from 0, by file name and row of the file; nothing is moved but a count a file."""
    table = spark.read.parquet(path)
    columns = list(columns or table.columns)
    rows = table.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    starts = counts.select("_file", (F.sum("_n").over(W._spec([], ["_file"])) - F.col("_n")).alias("_start"))  # a row a file
    return rows.join(F.broadcast(starts), "_file").select(*columns, (F.col("_start") + F.col("_row")).alias(name))


def misplaced(spark: SparkSession, path: str, places: DataFrame, key: str, place: str) -> DataFrame:
    """(contract, n): rows of the table at ``path`` that don't stand where ``places`` (key, place) says."""
    found = with_positions(spark, path, [key])
    both = found.join(places.select(key, F.col(place).alias("_wanted")), key, "full")
    return both.agg(F.count_if(~F.col("_position").eqNullSafe(F.col("_wanted"))).alias("n")).select(F.lit("rows_out_of_order").alias("contract"), "n")
