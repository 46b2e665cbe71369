"""Typed values as big-endian bytes and back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: printable ASCII (space to tilde) that is not digits alone.
PLAIN_TEXT = r"^(?![0-9]+\z)[ -~]+\z"


def long_bytes(n: Column) -> Column:
    return F.unhex(F.lpad(F.hex(n.cast("bigint")), 16, "0"))


def int_bytes(n: Column) -> Column:
    return F.unhex(F.lpad(F.right(F.hex(n.cast("bigint")), F.lit(8)), 8, "0"))


def text_bytes(s: Column) -> Column:
    return F.encode(s, "UTF-8")


def long_value(value: Column) -> Column:
    """8 bytes as signed long, 4 bytes as signed int; NULL, empty and other lengths read 0."""
    digits = F.hex(value)
    # four bytes take the sign of their first digit along
    full = F.when(digits >= "8", F.lpad(digits, 16, "F")).otherwise(F.lpad(digits, 16, "0"))
    wide = F.octet_length(value).isin(4, 8)
    number = F.conv(F.when(F.octet_length(value) == 8, digits).otherwise(full), 16, -10)
    return F.when(wide, number.cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def text_value(value: Column) -> Column:
    """Best guess as text: 4 or 8 bytes that are digits or not printable are a number."""
    text = value.cast("string")
    return (
        F.when(value.isNull() | (F.octet_length(value) == 0), "")
        .when(F.octet_length(value).isin(4, 8) & ~text.rlike(PLAIN_TEXT), long_value(value).cast("string"))
        .otherwise(text)
    )


def tagged_bytes(text: Column, tag: Column) -> Column:
    """Text to bytes: tag ``i`` int, ``l`` long, otherwise long if all digits, else the text."""
    number = text.try_cast("bigint")
    return (
        F.when(tag == "i", int_bytes(number))
        .when((tag == "l") | text.rlike("^[0-9]+$"), long_bytes(number))
        .otherwise(text_bytes(text))
    )
