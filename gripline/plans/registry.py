"""Named queries and, where SQL can say the same, the SQL to compare them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(fn(spark, folder))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def comparable(rows: DataFrame) -> DataFrame:
    """Doubles to six places without a negative zero, whole numbers as bigint."""
    out = []
    for name, kind in rows.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        out.append(c.alias(name))
    return rows.select(*out)


def six(*columns: str) -> str:
    """SQL list of columns rounded to six places."""
    return ", ".join(f"round(cast({c} as double), 6) + 0.0 as {c}" for c in columns)
