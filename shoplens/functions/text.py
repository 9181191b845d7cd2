"""Text expressions. All run inside the JVM."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Our choice for "the whole query is a number".
FLOAT_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
ENTITY_PIECES = r"(&#?[A-Za-z0-9]+;|[^&]+|&)"


def _character(digits: Column, base: int, piece: Column) -> Column:
    """Character of a number reference; references beyond Unicode and to surrogates stay as they are."""
    number = F.conv(digits, base, 10).cast("bigint")
    character = F.decode(F.unhex(F.lpad(F.conv(digits, base, 16), 8, "0")), "UTF-32")
    return F.when((number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF), character).otherwise(piece)


def unescape_html(text: Column) -> Column:
    """Decode the HTML 4 named entities and numeric references that end in a semicolon, in one pass."""
    named = F.create_map(
        *[F.lit(x) for name, point in sorted(name2codepoint.items()) for x in (name, chr(point))]
    )

    def decode(piece: Column) -> Column:
        body = F.substring(piece, 2, F.length(piece) - 2)
        return (
            F.when(~piece.rlike("^&.+;$"), piece)
            .when(body.rlike("^#[xX]0*[0-9A-Fa-f]{1,6}$"), _character(F.regexp_extract(body, "^#[xX]0*([0-9A-Fa-f]{1,6})$", 1), 16, piece))
            .when(body.rlike("^#0*[0-9]{1,7}$"), _character(F.regexp_extract(body, "^#0*([0-9]{1,7})$", 1), 10, piece))
            .otherwise(F.coalesce(F.try_element_at(named, body), piece))
        )

    pieces = F.regexp_extract_all(text, F.lit(ENTITY_PIECES), F.lit(1))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, decode), "")).otherwise(text)


def clean_query(text: Column) -> Column:
    """Entity decoding, single spaces and lower case."""
    return F.lower(F.regexp_replace(F.trim(unescape_html(text)), r"\s+", " "))


def straight_quotes(text: Column) -> Column:
    return F.translate(text, "“”‘’", "\"\"''")


def normal_tokens(text: Column) -> Column:
    """Lower-case letter or digit runs in order, as an array without empty pieces."""
    spaced = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def normal_brand(name: Column) -> Column:
    """Letters and digits only, lower case."""
    return F.lower(F.regexp_replace(name, "[^a-zA-Z0-9]", ""))


def vertical_name(name: Column) -> Column:
    return F.replace(F.replace(F.replace(name, F.lit(" "), F.lit("")), F.lit("&"), F.lit("And")), F.lit(","), F.lit("_"))


def vertical_snake(name: Column) -> Column:
    return F.translate(F.replace(F.lower(name), F.lit("&"), F.lit("and")), " ,", "__")


def seeded_int(slot: str, seed: int, bound: Column, *parts: Column) -> Column:
    """Repeatable integer in [0, bound) from the row's own text, independent of partitioning."""
    digest = F.md5(F.concat_ws("|", *parts, F.lit(slot), F.lit(str(seed))))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.pmod(number, bound.cast("long")).cast("int")


def seeded_unit(slot: str, seed: int, *parts: Column) -> Column:
    """Repeatable double in [0, 1)."""
    return seeded_int(slot, seed, F.lit(1_000_000), *parts) / F.lit(1_000_000.0)


def edit_similarity(left: Column, right: Column) -> Column:
    """1 - distance / longer length; adjacent swaps count one when they explain the whole difference."""
    longest = F.greatest(F.length(left), F.length(right))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(left, right) / longest)
