"""Tables of an application's own in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or on one machine a folder of our own where that
    is unset."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("a cluster needs spark.checkpoint.dir, a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _OWN[app], True)
    return "file://" + _OWN[app]


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: several branches of a plan then scan its columns instead of making it again, and a
    lost executor costs no more than its tasks. The table goes when the application ends."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path.toString())
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(path.toString())
