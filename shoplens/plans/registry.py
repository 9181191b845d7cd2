"""Named queries over the given tables, each with SQL giving the same result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFunction = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFunction] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    def register(fn: QueryFunction) -> QueryFunction:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def rounded(column: Column | str, places: int = 6) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, places)


def flat(df: DataFrame, separator: str = "|") -> DataFrame:
    """Array<string> columns as text, double columns rounded: values both engines print alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), separator)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)
