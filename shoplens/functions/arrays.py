"""Array and vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def wrap_scalar(value: Column) -> Column:
    """A string becomes a one-element list, null an empty list."""
    return F.when(value.isNotNull(), F.array(value)).otherwise(empty_strings())


def clean_list(values: Column) -> Column:
    """Null becomes an empty list, quote and bracket edges go, duplicates go."""
    stripped = F.transform(values, lambda v: F.regexp_replace(v, r"^[\['\]]+|[\['\]]+$", ""))
    return F.coalesce(F.array_distinct(F.filter(stripped, lambda v: v.isNotNull())), empty_strings())


def parse_list_text(text: Column) -> Column:
    """Text such as ``['a', 'b']`` to an array; null or unreadable text to null."""
    return F.from_json(F.replace(text, F.lit("'"), F.lit('"')), "array<string>")


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    squares = F.transform(vector, lambda a: a.cast("double") * a.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity, 0 when either vector has no length."""
    size = norm(left) * norm(right)
    return F.when(size == 0, F.lit(0.0)).otherwise(F.try_divide(dot(left, right), size))


def cosine_strict(left: Column, right: Column) -> Column:
    """Cosine similarity without the guard: a vector without length gives NaN."""
    size = norm(left) * norm(right)
    return F.when(size == 0, F.lit(float("nan"))).otherwise(F.try_divide(dot(left, right), size))


def value_for_entity(query: Column, template: Column, entity: str) -> Column:
    """Query token standing where the template names ``entity``; null when it does not."""
    place = F.array_position(template, F.lit(entity)).cast("int")
    return F.when(place > 0, F.try_element_at(query, F.when(place > 0, place).otherwise(F.lit(1))))
