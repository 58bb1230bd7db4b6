"""Text helpers built from column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F


def bind(c: Column, use) -> Column:
    """Evaluate `c` once and hand it to `use`, for expressions that refer to it several times."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def filled(c: Column) -> Column:
    """Neither NULL nor empty."""
    return c.isNotNull() & (c != "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def or_sentinel(c: Column, sentinel: str = "xna") -> Column:
    """NULL or empty becomes the warehouse's "not available" value."""
    return F.coalesce(blank_to_null(c), F.lit(sentinel))


def brand_suffixes(names: list[str], separators: tuple[str, ...] = (" | ", " - ")) -> list[str]:
    """Title suffixes of shop names, in order: each name with each separator."""
    return [sep + name for name in names for sep in separators]


def clean_text(c: Column, suffixes: list[str] | tuple[str, ...] = ()) -> Column:
    """Collapse whitespace, then strip each suffix in list order, one pass.  NULL gives ''.

    The suffixes are folded over as an array; a chain of when() calls would copy the input
    expression once per suffix.
    """
    text = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))
    if not suffixes:
        return text
    return F.aggregate(
        F.array(*[F.lit(s) for s in suffixes]), text,
        lambda acc, s: F.when(
            F.endswith(acc, s),
            F.trim(F.substring(acc, F.lit(1), F.length(acc) - F.length(s))),
        ).otherwise(acc),
    )


ENTITIES = {f"&{name};": chr(point) for name, point in name2codepoint.items()} | {"&apos;": "'"}


def _entity_table() -> Column:
    """The table as one constant; a map of several hundred literals slows down planning."""
    text = "\x02".join(f"{entity}\x01{char}" for entity, char in ENTITIES.items())
    return F.str_to_map(F.lit(text), F.lit("\x02"), F.lit("\x01"))


def _numeric_entity(e: Column) -> Column:
    hexed = F.regexp_extract(e, r"^&#[xX]([0-9A-Fa-f]{1,6});$", 1)
    decimal = F.regexp_extract(e, r"^&#([0-9]{1,7});$", 1)
    point = F.when(hexed != "", F.conv(hexed, 16, 10)).otherwise(decimal).try_cast("int")
    valid = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))


def decode_entities(c: Column) -> Column:
    """Decode HTML entities (named Latin/Greek/symbol ones and numeric ones).

    Each distinct entity found in the text is replaced once; those that stand for `&` come last so
    that `&amp;lt;` ends as `&lt;`.
    """
    return F.when(F.contains(c, F.lit("&")), _decode(c)).otherwise(c)


def _decode(c: Column) -> Column:
    # The spellings of the ampersand.
    ampersands = F.array(F.lit("&amp;"), F.lit("&#38;"), F.lit("&#x26;"))
    found = F.regexp_extract_all(
        c, F.lit(r"&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[xX][0-9A-Fa-f]+);"), F.lit(0))
    decoded = F.aggregate(
        F.array_except(found, ampersands), c,
        lambda acc, e: F.replace(
            acc, e, F.coalesce(F.when(F.startswith(e, F.lit("&#")), _numeric_entity(e))
                               .otherwise(F.try_element_at(_entity_table(), e)), e)),
    )
    return F.aggregate(ampersands, decoded, lambda acc, e: F.replace(acc, e, F.lit("&")))
