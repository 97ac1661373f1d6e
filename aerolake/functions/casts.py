"""Text to typed values, each as a safe form (NULL when the text does not fit)
and a strict form (error), independent of the session's ANSI setting."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


# A date needs its day: a year or a month alone is no timestamp.
FULL_DATE = r"^\s*[+-]?[0-9]{4,6}-[0-9]{1,2}-[0-9]{1,2}([^0-9-]|$)"


def try_timestamp_ntz(text: Column) -> Column:
    """Wall-clock timestamp; a zone suffix is dropped, not applied."""
    return F.when(text.rlike(FULL_DATE), text).try_cast("timestamp_ntz")


def try_int(text: Column) -> Column:
    """Whole numbers only: ``70`` fits, ``70.0`` does not."""
    return text.try_cast("int")


def try_int_rounded(text: Column) -> Column:
    """Any number, rounded half away from zero.

    The text goes to scale 0 in one step, so no intermediate scale can round
    twice (``70.4999...`` stays 70 however many digits follow).
    """
    return text.try_cast("decimal(38,0)").try_cast("int")


def try_bigint_rounded(text: Column) -> Column:
    return text.try_cast("decimal(38,0)").try_cast("bigint")


def try_decimal(text: Column, precision: int, scale: int) -> Column:
    """Rounded half away from zero to ``scale``; too many whole digits do not fit."""
    return text.try_cast(f"decimal({precision},{scale})")


def try_varchar(text: Column, width: int) -> Column:
    """Text of at most ``width`` characters. Blanks beyond the width are cut,
    anything else beyond it does not fit."""
    return F.when(F.char_length(text) <= width, text).when(
        F.char_length(F.rtrim(text)) <= width, F.substring(text, 1, width)
    )


def truncate_text(text: Column, width: int) -> Column:
    return F.substring(text, 1, width)


_SIZED = re.compile(r"(varchar|decimal)\((\d+)(?:,(\d+))?\)")
_PLAIN = {
    "timestamp": try_timestamp_ntz,
    "int": try_int,
    "rounded int": try_int_rounded,
    "rounded bigint": try_bigint_rounded,
}


def try_convert(text: Column, kind: str) -> Column:
    """Safe conversion for a kind named in the column maps."""
    if kind in _PLAIN:
        return _PLAIN[kind](text)
    name, first, second = _SIZED.fullmatch(kind).groups()
    if name == "varchar":
        return try_varchar(text, int(first))
    return try_decimal(text, int(first), int(second))


def misfit(text: Column, kind: str) -> Column:
    """True when there is a text and it does not convert. The conversion comes
    first: it is then always evaluated, and shared with the value itself."""
    return try_convert(text, kind).isNull() & text.isNotNull()


def convert(text: Column, kind: str, label: str = "value") -> Column:
    """Strict conversion: a misfit stops the query, a NULL stays NULL. (The
    message is constant, which keeps the generated code of wide tables small.)"""
    stop = F.raise_error(F.lit(f"{label}: the text does not fit {kind}"))
    return F.when(misfit(text, kind), stop).otherwise(try_convert(text, kind))
