"""Column expressions that standardise raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def standard_code(text: Column) -> Column:
    """Trimmed upper-case code, e.g. `` fail `` becomes ``FAIL``."""
    return F.upper(F.trim(text))


def parsed_timestamp(text: Column) -> Column:
    """ISO-8601 text (with or without an offset) as a timestamp; NULL if it cannot be read."""
    return F.try_to_timestamp(text)


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``M`` + ``7`` -> ``M07``. Longer numbers keep all their digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))
