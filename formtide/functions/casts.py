"""Fault-tolerant casts and date functions. Bad input becomes null, never an error."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from formtide.functions.columns import as_column
from formtide.functions.fixed_values import UNIT_MICROS

INFINITY_WORDS = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]



def to_number(value: Column | str) -> Column:
    """Text to double, null when it is not a decimal number.

    A JVM double also reads a type suffix (``1d``), hexadecimal floats and ``NaN``; those are
    no numbers here, nor is text too large for a double. Infinity words are.
    """
    text = as_column(value).cast("string")
    number = text.try_cast("double")
    lettered = text.rlike("[dDfFxXnN]")
    finite = F.abs(number) <= sys.float_info.max
    return F.when(~lettered & finite, number).when(
        F.lower(F.trim(text)).isin(INFINITY_WORDS), number
    )


def epoch_ms_to_timestamp(value: Column | str) -> Column:
    """Epoch milliseconds (integer or decimal text) to timestamp; out of range is null.

    The range is that of the timestamp, a 64-bit microsecond clock. Whole milliseconds are counted
    as integers, since a double times 1000 is no longer exact beyond the year 2255.
    """
    millis = to_number(value)
    integer = as_column(value).cast("string").try_cast("bigint")
    whole = F.coalesce(integer, millis.try_cast("bigint"))
    below = F.round((millis - whole) * 1000).try_cast("bigint")
    return F.timestamp_micros(F.try_add(F.try_multiply(whole, F.lit(1000)), below))


def text_to_timestamp(value: Column | str, fmt: str | None = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to timestamp, null when it does not match; ``fmt=None`` takes any ISO form."""
    text = as_column(value)
    if fmt is None:
        return text.try_cast("timestamp")
    return F.try_to_timestamp(text, F.lit(fmt))


def epoch_or_text_to_timestamp(value: Column | str) -> Column:
    """A form field that holds either epoch milliseconds or ISO text."""
    return F.coalesce(epoch_ms_to_timestamp(value), text_to_timestamp(value, None))


def yes_no(value: Column | str) -> Column:
    """``SIM`` true, ``NÃO`` false in any case, everything else null."""
    word = F.upper(as_column(value))
    return F.when(word == "SIM", True).when(word == "NÃO", False)


def truthy(value: Column | str) -> Column:
    """True for sim, true or 1 in any case, false for everything else including null."""
    word = F.lower(as_column(value).cast("string"))
    return F.coalesce(word.isin("sim", "true", "1"), F.lit(False))


def stringify(value: Column | str) -> Column:
    """Any cell as text, null stays null."""
    return as_column(value).cast("string")


def now_text(zone: str | None = None, instant: Column | None = None) -> Column:
    """An instant (default: now) as ISO text with microseconds and offset, in a zone."""
    moment = (F.current_timestamp() if instant is None else instant).cast("timestamp_ntz")
    utc = F.convert_timezone(None, F.lit("UTC"), moment)
    wall = F.convert_timezone(None, F.lit(zone or "UTC"), moment)
    minutes = F.timestamp_diff("MINUTE", utc, wall)
    offset = F.format_string(
        "%s%02d%02d",
        F.when(minutes < 0, "-").otherwise("+"),
        F.floor(F.abs(minutes) / 60),
        F.abs(minutes) % 60,
    )
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), offset)


def gap_exceeds(
    past: Column | str, future: Column | str, unit: str = "minutes", duration: float = 1
) -> Column:
    """Whether two instants lie strictly more than a duration apart, in either order."""
    limit = round(duration * UNIT_MICROS[unit])
    micros = F.timestamp_diff("MICROSECOND", as_column(past), as_column(future))
    return F.abs(micros) > F.lit(limit)
