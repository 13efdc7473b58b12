"""Shared plumbing of the training-data operators: inputs, shared scratch tables, blocks of text."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one of our own where it is unset."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _OWN[app], True)
    return "file://" + _OWN[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


#: Paths of the tables written inside the open ``recorded`` blocks, innermost last. Each thread has its own: operators that
#: run side by side in one driver don't see each other's tables.
_RECORDS: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("tidemark_records", default=())


def _note(paths: list[str]) -> None:
    """Tell the innermost open block of tables that were written."""
    for own in _RECORDS.get()[-1:]:
        own.extend(paths)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    _note([path])
    _forget_at_exit(df.sparkSession, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def stored_in_buckets(df: DataFrame, name: str, column: str, n: int) -> DataFrame:
    """As ``stored``, dealt into n buckets by a column, so that a join on it moves only the other side. The catalog knows the
    table only until the frame is made: it is an external one, whose files stay."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    table = f"tidemark_{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, column).saveAsTable(table)
    _note([path])
    _forget_at_exit(spark, path)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    out._tidemark_path = path
    return out


def _forget_at_exit(spark: SparkSession, path: str) -> None:
    """What isn't deleted before goes when the application's JVM ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``stored`` wrote; nothing that is still to run may read them."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    for p in paths:
        hadoop(p).getFileSystem(conf).delete(hadoop(p), True)


@contextlib.contextmanager
def recorded() -> Iterator[list[str]]:
    """Collects the paths of the tables stored in the block."""
    own: list[str] = []
    opened = _RECORDS.set((*_RECORDS.get(), own))
    try:
        yield own
    finally:
        _RECORDS.reset(opened)
        _note(own)


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables stored in the block go at its end, but for those given to what it yields; so do finished shuffle files, which
    Spark's cleaner drops when the driver's heap is collected."""
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._tidemark_path)
        return df

    own: list[str] = []
    opened = _RECORDS.set((*_RECORDS.get(), own))
    try:
        yield keep
    finally:
        _RECORDS.reset(opened)
        discard(spark, [p for p in own if p not in kept])
        _note([p for p in own if p in kept])
        spark._jvm.System.gc()


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """A stored table of numbers, sent to every task if it has so few rows, and left to a shuffle if it has more."""
    return F.broadcast(df) if df.count() <= rows else df


def trim() -> None:
    """Give memory that a task has freed back to the system: Python workers live on for other tasks."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def sliced(pdf: pd.DataFrame, rows: int = 50_000) -> Iterator[pd.DataFrame]:
    """A long frame in short ones: Arrow cuts a long column of texts into chunks, which Spark doesn't take."""
    for at in range(0, len(pdf), rows):
        yield pdf.iloc[at : at + rows]


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, the text null-free."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
