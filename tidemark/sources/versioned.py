"""Tables of immutable files, dealt into buckets by key, with a log of versions.

A table is a folder. Rows lie in ``data/<version>/_bucket=<n>``; ``_log/<version>.json`` names, for each bucket, the versions
whose files make it up. A change reads only the buckets that its keys fall into, writes these anew under its own version,
checks what was written, and is committed by the rename of one small log file, which fails if another change was first. So

* files of other buckets stay as they are, under their names;
* a job may read a table and replace it: what it reads isn't touched;
* a job that dies before the rename leaves the table as it was, and its files are never seen;
* a reader keeps the version it opened, until ``forget`` drops the files of versions that no one needs.

The log holds a line a bucket, and the number of buckets is fixed when the table is made; only bucket numbers are collected.
A bucket is read and written by as many tasks as its size asks for.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import tables

BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another change of the table was committed first."""


class Versioned:
    """The table at ``path``, by its column ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64) -> None:
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)
        if version := self.version():
            self.buckets = self._log(version)["n_buckets"]

    def _at(self, rest: str):  # noqa: ANN202
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{rest}" if rest else self.path)

    def versions(self) -> list[int]:
        log = self._at("_log")
        if not self._fs.exists(log):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int:
        """The latest one; 0 before the table is made."""
        return max(self.versions(), default=0)

    def _log(self, version: int) -> dict:
        stream = self._fs.open(self._at(f"_log/{version:09d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    # ---- reading

    def read(self, version: int | None = None, among: Sequence[int] | None = None) -> DataFrame:
        """The table as of a version, the latest if none is given; ``among``: only these buckets."""
        version = self.version() if version is None else version
        if not version:
            raise ValueError(f"no table at {self.path}")
        log = self._log(version)
        schema = StructType.fromJson(log["schema"])
        wanted = None if among is None else {str(b) for b in among}
        folders = [f"{self.path}/data/{v}/{BUCKET}={b}" for b, of in log["buckets"].items() if wanted is None or b in wanted for v in of]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    # ---- changes; each returns the version it made

    def replace(self, df: DataFrame) -> int:
        """The rows of ``df`` in place of all there are; ``df`` may read this table."""
        return self._commit(df, {}, self.version(), df.schema)

    def merge(self, new: DataFrame, always: Sequence[str] = (), accept: Column | None = None) -> int:
        """Upsert: non-blank values of a known key's new row win, and the columns ``always`` are replaced by it, unless
        ``accept`` refuses the row; an unknown key's row is added. Blank values count as missing. Keys of ``new`` must be distinct."""
        self._distinct(new)
        return self._rewrite(new, lambda old, rows: tables.merge_records(old, rows, self.key, always, accept))

    def replace_keys(self, new: DataFrame) -> int:
        """All rows of the new keys go, the new rows come."""
        return self._rewrite(new, lambda old, rows: tables.replace_by_key(old, rows, self.key))

    def append_new(self, new: DataFrame) -> int:
        """The rows whose key the table lacks, one a key, as new files beside those of their buckets."""
        rows, before = self._dealt(new), self.version()
        fresh = rows.join(self.read(before, self._touched(rows)).select(self.key), self.key, "left_anti").dropDuplicates([self.key])
        return self._commit(fresh.select(*new.columns), self._log(before)["buckets"], before, new.schema, beside=True)

    def forget(self, keep: int = 1) -> list[int]:
        """Delete the versions before the last ``keep`` and the files that only these have."""
        known = self.versions()
        gone, kept = known[:-keep], known[-keep:]
        used = {(v, b) for k in kept for b, of in self._log(k)["buckets"].items() for v in of}
        mine = {(v, b) for k in gone for b, of in self._log(k)["buckets"].items() for v in of}
        for k in gone:
            self._fs.delete(self._at(f"_log/{k:09d}.json"), False)
        for v, b in mine - used:
            self._fs.delete(self._at(f"data/{v}/{BUCKET}={b}"), True)
        return gone

    # ---- how

    def _dealt(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int"))

    def _touched(self, dealt: DataFrame) -> list[int]:
        return sorted(r[0] for r in dealt.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers

    def _distinct(self, new: DataFrame) -> None:
        twice = tables.duplicate_keys(new.where(F.col(self.key).isNotNull()), [self.key]).limit(10).collect()
        if twice:
            raise ValueError(f"keys that occur twice, such as {', '.join(str(r[0]) for r in twice)}")

    def _rewrite(self, new: DataFrame, change) -> int:  # noqa: ANN001
        before = self.version()
        touched = self._touched(self._dealt(new))
        old = self.read(before, touched)
        log = self._log(before)
        rest = {b: of for b, of in log["buckets"].items() if int(b) not in set(touched)}
        return self._commit(change(old, new.select(*old.columns)), rest, before, old.schema)

    def _commit(self, df: DataFrame, rest: dict[str, list[str]], before: int, schema: StructType, beside: bool = False) -> int:
        name, counted = f"{before + 1:09d}-{uuid.uuid4().hex[:8]}", Observation()
        data = self._at(f"data/{name}")
        try:
            rows = self._dealt(df).observe(counted, F.count(F.lit(1)).alias("n"))
            rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).option("compression", "zstd").parquet(data.toString())
            folders = [s.getPath().getName() for s in self._fs.listStatus(data)]
            written = sorted(int(f.split("=")[1]) for f in folders if f.startswith(f"{BUCKET}="))
            found = self.spark.read.schema(schema).parquet(*[f"{data.toString()}/{BUCKET}={b}" for b in written]).count() if written else 0
            expected = counted.get["n"] if found or not df.isEmpty() else 0  # an empty plan observes nothing
            if found != expected:
                raise ValueError(f"{expected} rows were to be written to {self.path}, {found} can be read")
            log = {"version": before + 1, "key": self.key, "n_buckets": self.buckets, "schema": schema.jsonValue(), "buckets": dict(rest)}
            for b in written:
                log["buckets"][str(b)] = [*(rest.get(str(b), []) if beside else []), name]
            self._swap(log, before + 1)
        except BaseException:
            self._fs.delete(data, True)
            raise
        return before + 1

    def _swap(self, log: dict, version: int) -> None:
        """One rename that doesn't overwrite."""
        from tidemark.sources.sinks import write_text

        jvm, staged, target = self.spark._jvm, self._at(f"_log/.{uuid.uuid4().hex}"), self._at(f"_log/{version:09d}.json")
        write_text(self.spark, staged.toString(), json.dumps(log))
        kinds = jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(kinds, 1)
        none[0] = kinds.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(staged, target, none)
        except Exception as e:
            self._fs.delete(staged, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {version} of {self.path} was made by another job") from e
            raise
