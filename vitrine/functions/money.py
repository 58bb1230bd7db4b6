"""Price text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vitrine.functions.text import blank_to_null

NUMBER = r"(-?[0-9](?:[0-9.,' \x{00A0}]*[0-9])?)"
# Currencies with three decimals.
THREE_DECIMALS = r"(?i)\b(BHD|IQD|JOD|KWD|LYD|OMR|TND)\b"


def price_amount(price: Column, kind: str = "decimal(18,3)", structured: Column | bool = False) -> Column:
    """Amount of a price text such as `EUR 1,234.50`, `1.234,50 €`, `-20` or `12`.

    Where both marks occur, the last one is the decimal mark.  A mark that occurs more than once groups
    digits.  A single mark is the decimal mark, unless exactly three digits follow it and one to three
    that do not begin with a zero stand before it: then it groups, except in currencies with three decimals.  In `structured` prices
    (JSON-LD) a point is always the decimal mark.  A minus sign before the number counts.  Text without
    a readable number, or with one too large for `kind`, gives NULL.
    """
    structured = F.lit(structured) if isinstance(structured, bool) else structured
    number = F.regexp_replace(F.regexp_extract(price, NUMBER, 1), r"[^0-9.,-]", "")
    last = F.regexp_extract(number, r"([.,])[0-9]*$", 1)
    # The tail after the last mark is a fraction if the other mark or none stands before it ...
    alone = F.regexp_count(number, F.lit(r"[.,]")) == 1
    mixed = number.contains(".") & number.contains(",") & (F.regexp_count(
        number, F.when(last == ".", F.lit(r"\.")).otherwise(F.lit(","))) == 1)
    # ... but a single group of three digits is a thousand.
    thousand = number.rlike(r"^-?[1-9][0-9]{0,2}[.,][0-9]{3}$") & ~price.rlike(THREE_DECIMALS)
    fraction = mixed | (alone & ~thousand) | (structured & alone & (last == "."))
    whole = F.regexp_replace(F.regexp_replace(number, r"[.,][0-9]*$", ""), r"[.,]", "")
    tail = F.regexp_extract(number, r"[.,]([0-9]*)$", 1)
    text = F.when((last != "") & fraction, F.concat(whole, F.lit("."), tail)).otherwise(
        F.regexp_replace(number, r"[.,]", ""))
    return blank_to_null(text).try_cast(kind)


def is_overflow(price: Column, kind: str = "decimal(10,2)") -> Column:
    """Whether a price has a readable amount that is too large for `kind`."""
    return price_amount(price, "decimal(38,3)").isNotNull() & price_amount(price, kind).isNull()


def price_currency(price: Column) -> Column:
    """Currency text of a price: what stands before the number, else what stands after it."""
    before = F.trim(F.regexp_extract(price, r"^([^0-9-]*)-?[0-9]", 1))
    after = F.trim(F.regexp_extract(price, r"[0-9]([^0-9]*)$", 1))
    return F.coalesce(blank_to_null(before), blank_to_null(after))


def to_usd(amount: Column, rate: Column) -> Column:
    return (amount.cast("decimal(18,3)") * rate.cast("decimal(18,6)")).cast("decimal(28,6)")
