"""Shared helper of the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    """A column given by name or as an expression. Names may hold blanks and dots."""
    return F.col(quoted(value)) if isinstance(value, str) else value


def quoted(name: str) -> str:
    """A column name that is taken literally, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"
