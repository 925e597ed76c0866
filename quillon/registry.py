"""Registered queries by name, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.plans import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(F.col(f"`{n}`").cast("double"), digits).alias(n) if t in ("double", "float") else F.col(f"`{n}`") for n, t in df.dtypes))


def query(sql: str | None = None, *, scores: bool = False):
    """Register the function under its name; scores: the SQL uses the shared score tables."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql:
            ORACLE_SQL[fn.__name__] = (f"WITH {fx.SQL}" + ("," if sql.lstrip().startswith(",") else "\n") + sql.lstrip().removeprefix(",")) if scores else sql
        return fn

    return add
