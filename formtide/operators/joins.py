"""Joins of media references with object listings.

No side is hinted: both grow with the data. Spark broadcasts a side it can prove small, and
adaptive execution splits a skewed partition on any side whose rows need not be seen together:
both sides of an inner join, the left side of the others. The right side of semi and anti joins
is therefore reduced to distinct keys first, which combines before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_KEY = ["form", "file_id"]


def link_media(media: DataFrame, links: DataFrame, on: list[str] = FILE_KEY) -> DataFrame:
    """Media rows with the objects of the same form and file id; many-to-many is kept (K1)."""
    return media.join(links, on, "inner")


def missing_references(
    references: DataFrame, existing: DataFrame, on: list[str] = FILE_KEY
) -> DataFrame:
    """References without an object, each id once (K2).

    Deduplication combines before the shuffle, so an id that fills a third of the input
    reaches the join as one row.
    """
    return references.dropDuplicates(on).join(existing.select(*on).distinct(), on, "left_anti")


def present_references(
    references: DataFrame, existing: DataFrame, on: list[str] = FILE_KEY
) -> DataFrame:
    """References that have an object, repeated ones included (K3)."""
    return references.join(existing.select(*on).distinct(), on, "left_semi")


def bounded_side(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """A side for a join that is broadcast only after its rows were counted.

    Fetches at most ``max_rows + 1`` rows. Within the bound they become a broadcast side;
    beyond it the distributed frame is returned for an ordinary join.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
