"""Registry of named queries and their SQL twins.

``@query(key, sql=...)`` registers a callable ``(spark, sf_dir) -> DataFrame``.
The SQL twin is an independent statement over the same tables, run by an
outside engine to check our result; queries that SQL cannot express (stateful
streams, model fits) register without one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def query(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import every plan module so that their queries register."""
    from tablekit.plans import (  # noqa: F401
        trips, shaping, aggregates, evaluation, series, scalars, splits, ml, streams, text,
    )


def scratch_dir_for(spark: SparkSession, name: str) -> str:
    """Fresh path in the shared folder for data a query derives and reads back."""
    from tablekit.session import scratch_path
    return scratch_path(spark, name)
