"""Registry of the named queries: one Spark callable (and, when the operator can be
written in SQL, an equivalent DuckDB/ANSI query) per operator."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its SQL oracle."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def tb(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
