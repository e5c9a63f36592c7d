"""Registered queries, each with the equivalent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, StringType, TimestampType

from tidegate.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Comparable output: doubles to 6 places, dates and times as text, text lists joined.

    Doubles are rounded by plain arithmetic: ``round`` breaks ties differently
    from engine to engine.
    """
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            shifted = column * 1e6 + 0.5
            column = (shifted - F.pmod(shifted, F.lit(1.0))) / 1e6
        elif isinstance(field.dataType, DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, ArrayType) and isinstance(field.dataType.elementType, StringType):
            column = F.array_join(column, ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _plain_rounding(sql: str) -> str:
    """``round(x, 6)`` in SQL as the arithmetic that :func:`present` uses."""
    while (start := sql.find("round(")) >= 0:
        depth, end = 1, start + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[start + len("round(") : end - 1]
        if inner.endswith(", 6"):
            plain = f"floor(({inner.removesuffix(', 6')}) * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE"
        else:
            plain = f"ROUND({inner})"
        sql = f"{sql[:start]}{plain}{sql[end:]}"
    return sql


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: present(function(use_utc(spark), sf_dir))
        QUERIES[name].__doc__ = function.__doc__
        if sql is not None:
            ORACLES[name] = _plain_rounding(sql)
        return function

    return add


def register_all() -> None:
    from tidegate.plans.catalog import charges, datasets, incremental, monitoring, pages, streams  # noqa: F401


register_all()
