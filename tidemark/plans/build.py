"""The whole build as a job: ``spark-submit tidemark/plans/build.py --history H --rows R --output O``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import contracts, features
from tidemark.plans.manifest import manifest
from tidemark.sources import ordered, sinks


@dataclass
class Config:
    history: str
    rows: str
    output: str
    manifest: str | None = None
    include_market_features: bool = False
    keep_helper_columns: bool = False
    history_lags: int = 10
    compression: str = "zstd"
    train_until: str = "2024-07-31"
    validate_until: str = "2025-07-31"

    @classmethod
    def from_args(cls, argv: Sequence[str] | None = None) -> Config:
        p = argparse.ArgumentParser(description=__doc__)
        for name in ("history", "rows", "output"):
            p.add_argument(f"--{name}", required=True)
        p.add_argument("--manifest")
        p.add_argument("--include-market-features", action="store_true")
        p.add_argument("--keep-helper-columns", action="store_true")
        p.add_argument("--history-lags", type=int, default=10)
        p.add_argument("--compression", choices=sinks.CODECS, default="zstd")
        return cls(**vars(p.parse_args(argv)))


def read(spark: SparkSession, path: str) -> DataFrame:
    return sinks.csv_inferred(spark, path, "result_id") if path.endswith(".csv") else spark.read.parquet(path)


def in_order_of_source(spark: SparkSession, path: str) -> DataFrame:
    """result_id and ``_row_id``, the place of each row of the source."""
    rows = spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path)
    return ordered.with_source_order(rows.select("result_id"))


def run(spark: SparkSession, config: Config) -> DataFrame:
    """Checks the inputs, builds, and writes the features as Parquet in the order of the rows to emit, with the manifest beside
    them. The output's contracts are counted while it is written; its order is checked on what was written, before that takes
    the place of an earlier output."""
    history, rows, places = read(spark, config.history), read(spark, config.rows), in_order_of_source(spark, config.rows)
    contracts.validate_emit(history, rows)
    built = features.build_features(history, rows, max(1, config.history_lags), config.include_market_features, config.keep_helper_columns)
    built, watch, seen = contracts.watched_output(built, places, "_row_id")

    def accept(staged: str) -> None:
        contracts.require(seen.get, "the output")
        contracts.require(ordered.misplaced(spark, staged, places, "result_id", "_row_id"), "the output")

    built = sinks.write_checked(built, config.output, config.compression, ["_row_id"], watch, accept)
    generated = [c for c in built.columns if c not in history.columns]
    sources = {"history_source": config.history, "emitted_rows_source": config.rows, "output": config.output}
    sinks.write_text(spark, config.manifest or f"{config.output}.features.json", manifest(built, generated, config.train_until, config.validate_until, config.include_market_features, sources))
    return built


if __name__ == "__main__":
    run(SparkSession.builder.appName("tidemark-build").getOrCreate(), Config.from_args())
