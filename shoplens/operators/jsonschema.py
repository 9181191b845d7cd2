"""Schema inference over JSON text with Spark's variant type: texts are parsed once, and what is merged are kinds of values by path."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators.scale import materialise

INT_MAX, LONG_MAX = 2**31 - 1, 2**63 - 1
# Of two unlike types the first one present wins, else string.
PRECEDENCE = (T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType())
KINDS = {"double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType()}
ELEMENT = "e"  # step into an array; steps into objects are "k" and the key


def parsed_objects(df: DataFrame, column: str) -> DataFrame:
    """Column ``value`` (variant) of the rows whose text is one JSON object; all others are left out."""
    text = F.trim(F.col(column))
    rows = df.filter(text.startswith("{") & text.endswith("}")).select(F.try_parse_json(text).alias("value"))
    return rows.filter(F.col("value").isNotNull())


def _kind(value: Column) -> Column:
    """Kind of a variant: struct, array or the name of a simple type. Nulls are strings, and so are whole numbers beyond a long."""
    shape = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "decimal(38,0)")
    return (
        F.when(shape.startswith("OBJECT"), "struct")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "BIGINT", F.when(number.between(-INT_MAX - 1, INT_MAX), "int").otherwise("bigint"))
        .when(shape.rlike(r"^DECIMAL\(\d+,0\)$") & ~F.coalesce(number.between(-LONG_MAX - 1, LONG_MAX), F.lit(False)), "string")
        .when(shape.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "double")
        .otherwise("string")
    )


def value_kinds(df: DataFrame, column: str) -> DataFrame:
    """Distinct (path, kind) of all values inside the JSON objects, one level of nesting a round.

    A round keeps the objects and arrays of the level, explodes them and merges their kinds in the JVM; an empty array has a string as
    its element. As many rows remain as the merged schema has fields, whatever the number of texts.
    """
    spark = df.sparkSession
    level = parsed_objects(df, column).select(F.array().cast("array<string>").alias("path"), "value")
    kinds = None
    while True:
        level = materialise(level.withColumn("kind", _kind(F.col("value"))), "json-level")
        empty = level.filter((F.col("kind") == "array") & (F.schema_of_variant("value") == "ARRAY<VOID>"))
        found = level.select("path", "kind").unionByName(empty.select(F.concat("path", F.array(F.lit(ELEMENT))).alias("path"), F.lit("string").alias("kind"))).distinct()
        kinds = found if kinds is None else kinds.unionByName(found)
        nested = level.filter(F.col("kind").isin("struct", "array"))
        if nested.isEmpty():
            return kinds.distinct()
        level = spark.sql("SELECT path, kind, e.key, e.value FROM {nested}, LATERAL variant_explode(value) e", nested=nested).select(
            F.concat("path", F.array(F.when(F.col("kind") == "struct", F.concat(F.lit("k"), "key")).otherwise(ELEMENT))).alias("path"), "value"
        )


def merged_type(kinds: dict[tuple[str, ...], set[str]], path: tuple[str, ...] = ()) -> T.DataType:
    """Type of a path: structs by field, arrays by element, otherwise by PRECEDENCE: int and string give int."""
    own = kinds[path]
    below = sorted(p for p in kinds if len(p) == len(path) + 1 and p[:-1] == path)
    if own == {"struct"}:
        return T.StructType([T.StructField(p[-1][1:], merged_type(kinds, p)) for p in below if p[-1] != ELEMENT])
    if own == {"array"}:
        return T.ArrayType(merged_type(kinds, (*path, ELEMENT)))
    present = [KINDS[k] for k in own if k in KINDS]
    return next((t for t in PRECEDENCE if t in present), T.StringType())


def reader_type(shape: str) -> T.DataType:
    """The type Spark's JSON reader gives a merged variant schema: unlike types and nulls are strings, decimals doubles."""
    parts = re.compile(r"`(?:[^`]|``)*`|(?<![^<\s])(?:OBJECT(?=<)|VARIANT|VOID|DECIMAL\(\d+,\s*\d+\))(?=[<,>]|$)")
    named = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}
    return T.DataType.fromDDL(parts.sub(lambda m: m[0] if m[0][0] == "`" else named.get(m[0], "DOUBLE"), shape))


def infer_schema(df: DataFrame, column: str, mode: str = "precedence") -> T.StructType:
    """Merged schema of a JSON text column; texts that are no JSON object are passed over. Without any the schema is empty.

    mode "precedence" uses the rules above, "spark" those of Spark's own JSON reader. Only the merged schema reaches the driver.
    """
    if mode == "spark":
        shape = parsed_objects(df, column).agg(F.schema_of_variant_agg("value").alias("shape")).first()["shape"]
        return reader_type(shape) if shape and shape.startswith("OBJECT") else T.StructType([])
    kinds: dict[tuple[str, ...], set[str]] = {}
    for row in value_kinds(df, column).collect():  # a row for each field and kind
        kinds.setdefault(tuple(row.path), set()).add(row.kind)
    return merged_type(kinds) if kinds else T.StructType([])


def parse_json(df: DataFrame, column: str, schema: T.StructType | None = None) -> DataFrame:
    return df.withColumn(column, F.from_json(column, schema if schema is not None else infer_schema(df, column)))
