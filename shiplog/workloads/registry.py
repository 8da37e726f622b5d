"""Registered queries and the SQL that gives the same result straight from the base tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shiplog.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        ORACLES[name] = oracle
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A base table; with `columns`, only these."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows as a feed lands them: those of a key together, dealt over as many tasks as a shuffle
    has. The texts of the feed are made of them afterwards, and so do not travel."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, *keys)
