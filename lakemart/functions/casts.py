"""Casts that give NULL instead of an error, and semi-structured field access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


ISO_DATE = "yyyy-MM-dd"


def try_date(text: Column, fmt: str = ISO_DATE) -> Column:
    """date of a string in exactly this format, else NULL.  ISO dates take the cheaper cast."""
    if fmt == ISO_DATE:
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), text.try_cast("date"))
    return F.try_to_date(text, fmt)


def try_number(text: Column, precision: int = 18) -> Column:
    """whole number, rounded half up, else NULL."""
    return try_decimal(text, precision, 0)


def try_decimal(text: Column, precision: int, scale: int) -> Column:
    """decimal, rounded half up to the scale; NULL if unreadable or too large."""
    return text.try_cast(f"decimal({precision},{scale})")


def try_timestamp(text: Column) -> Column:
    """timestamp without time zone, else NULL.

    Whole numbers are seconds since 1970, or milli-, micro- or nanoseconds by their size; dates must be complete.
    """
    number = F.when(text.rlike(r"^\s*\d{1,18}\s*\z"), text.try_cast("bigint"))
    # Where one unit of whole numbers ends and the next begins.
    micros = (
        F.when(number < 31536000000, number * 1000000).when(number < 31536000000000, number * 1000)
        .when(number < 31536000000000000, number).otherwise((number / 1000).cast("bigint"))
    )
    since = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(micros / 1000000).cast("decimal(18,6)"))
    return F.when(number.isNotNull(), since).when(text.rlike(r"^\s*\d{4,}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp_ntz"))


def as_text(value: Column) -> Column:
    """F7"""
    return value.cast("string")


def variant_field(value: Column, name: str, type_: str = "string", safe: bool = False) -> Column:
    """a top-level field of a variant as ``type_``.

    A missing field and a JSON null are NULL.  A value that does not fit raises, or is NULL if ``safe``.
    """
    get = F.try_variant_get if safe else F.variant_get
    return get(value, f"$.{name}", type_)


def null_if(value: Column, *tokens: str) -> Column:
    """I4: NULL for any of the tokens."""
    return F.when(~value.isin(*tokens), value)
