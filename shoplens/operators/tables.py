"""Combining tables of similar shape."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators.scale import lookup_join


def union_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """By position, as the two projections list them."""
    return first.union(second)


def concat_rows(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_common_columns(
    tables: Sequence[DataFrame], primary: Sequence[str], handling: str = "intersect", reference: DataFrame | None = None
) -> DataFrame:
    """Union on common columns, one row per primary key: the first non-null value by table order.

    ``handling`` is "intersect" (columns present in all) or "reference" (the columns of ``reference``,
    missing ones null).
    """
    if handling == "reference":
        wanted = list((reference if reference is not None else tables[0]).columns)
    elif handling == "intersect":
        wanted = [c for c in tables[0].columns if all(c in t.columns for t in tables)]
    else:
        raise ValueError(f"unknown column handling: {handling}")
    parts = [
        t.select(*[c for c in wanted if c in t.columns]).withColumn("_source", F.lit(i)) for i, t in enumerate(tables)
    ]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rest = [c for c in wanted if c not in primary]
    picked = [
        # null values sort out; equal sources settle by value, so the result does not depend on row order
        F.min(F.when(F.col(c).isNotNull(), F.struct("_source", F.col(c).alias("v"))))["v"].alias(c)
        for c in rest
    ]
    return united.groupBy(*primary).agg(*picked).select(*wanted)


def merge_phrase_keys(phrases: DataFrame, lists: Sequence[str], numbers: Sequence[str], key: str = "phrase_key") -> DataFrame:
    """One row per phrase key: distinct list items, largest numbers. List items are a bounded domain
    (categories, entities); open lists belong in long form."""
    def tag(name: str):
        return F.transform(name, lambda v: F.struct(F.lit(name).alias("list"), v.alias("item")))

    tagged = F.concat(*[tag(c) for c in lists])
    items = phrases.withColumns({c: F.coalesce(F.col(c), F.array().cast("array<string>")) for c in lists}).select(
        key, *numbers, F.explode_outer(tagged).alias("_i")
    )
    sets = [F.array_sort(F.collect_set(F.when(F.col("_i.list") == c, F.col("_i.item")))).alias(c) for c in lists]
    return items.groupBy(key).agg(*sets, *[F.max(c).alias(c) for c in numbers])


def combine_properties(tokens: DataFrame, properties: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Tokens with the list of every property table (token and a list column of the table's name),
    and the property tokens missing from ``tokens``."""
    base = tokens.select("token").distinct()
    joined = base
    for name, table in properties.items():
        joined = joined.join(table.select("token", name), "token", "left")
    filled = {name: F.coalesce(F.col(name), F.array().cast("array<string>")) for name in properties}
    named = reduce(lambda a, b: a.unionByName(b), [t.select("token") for t in properties.values()]).distinct()
    return joined.withColumns(filled), named.join(base, "token", "left_anti")


def combine_variants(variants: DataFrame, properties: DataFrame, extras: DataFrame) -> DataFrame:
    """Variants with the properties of their right word, and the extra property rows beneath."""
    with_properties = lookup_join(variants, properties.withColumnRenamed("token", "rightword"), ["rightword"])
    return with_properties.unionByName(extras, allowMissingColumns=True)
