"""Sources and sinks of files: text-typed CSV scans, checked writes, incremental appends."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import ordered, typed

CODECS = ("zstd", "snappy", "gzip", "brotli", "none")


def csv_text(spark: SparkSession, path: str, columns: Sequence[str], blank: str | None = "") -> DataFrame:
    """A CSV with header, all columns text. Missing values become ``blank``, or stay null for None."""
    df = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).option("header", True).option("enforceSchema", False).csv(path)
    return df if blank is None else df.na.fill(blank)


def csv_inferred(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A CSV with header, each column of the type that all its cells have (``sources.typed``); mixed columns and ``key`` are text."""
    return typed.typed(spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(path), key)[0]


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """A small text file in any store that Spark writes to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()


def size_report(spark: SparkSession, source: str, made: str) -> dict[str, float]:
    """MB of two tables or files, and by how many percent the second is smaller."""
    def mb(path: str) -> float:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength() / 1e6

    a, b = mb(source), mb(made)
    return {"source_mb": a, "made_mb": b, "reduction_percent": 100 * (1 - b / a) if a else 0.0}


def known_ids(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The distinct non-null keys of a table; only that column is read."""
    return spark.read.parquet(path).select(key).where(F.col(key).isNotNull()).distinct()


def write_checked(
    df: DataFrame, path: str, codec: str = "zstd", order: Sequence[str] = (), watch: Callable[[DataFrame], DataFrame] | None = None, accept: Callable[[str], None] | None = None,
) -> DataFrame:
    """Write to a folder beside ``path``, check what can be read back against what was written, then put it in place. The old
    table is moved aside first and comes back if that fails, so there is one whole table at every time. ``order``: the files hold
    the rows in this order (see ``ordered.write_in_order``). ``watch`` observes the rows as they are written. ``accept`` looks at the folder before it is put in place, and
    raises if it finds fault."""
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec}")
    spark = df.sparkSession
    hadoop, mark = spark._jvm.org.apache.hadoop.fs.Path, uuid.uuid4().hex
    target, staged, aside = hadoop(path), hadoop(f"{path}.{mark}.tmp"), hadoop(f"{path}.{mark}.old")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    written = Observation()
    try:
        made: list[DataFrame] = []

        def watched(rows: DataFrame) -> DataFrame:
            made.append(rows if watch is None else watch(rows))
            return made[0].observe(written, F.count(F.lit(1)).alias("n"))

        if order:
            ordered.write_in_order(df, order, staged.toString(), codec=codec, watch=watched)
        else:
            watched(df).write.option("compression", codec).parquet(staged.toString())
        columns = [c for c in made[0].columns if c not in order or not c.startswith("_")]
        back = spark.read.parquet(staged.toString())
        found = back.count()
        expected = written.get["n"] if found or not df.isEmpty() else 0  # an empty plan observes nothing
        if back.columns != columns or found != expected:
            raise ValueError(f"what was written to {path} differs from the table")
        if accept is not None:
            accept(staged.toString())
        was_there = fs.exists(target)
        if was_there and not fs.rename(target, aside):
            raise OSError(f"{path} could not be moved aside")
        if not fs.rename(staged, target):
            if was_there:
                fs.rename(aside, target)
            raise OSError(f"the new table could not be moved to {path}")
        fs.delete(aside, True)
    finally:
        fs.delete(staged, True)
    return spark.read.parquet(path)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the table at ``path`` doesn't hold; the same rows twice are appended once."""
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        df = df.join(known_ids(spark, path, key), key, "left_anti").select(*df.columns)
    df.dropDuplicates([key]).write.mode("append").parquet(path)
