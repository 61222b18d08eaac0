"""Appending rows and concatenating frames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame


def append_rows(df: DataFrame | None, data: Sequence) -> DataFrame:
    """The frame followed by rows built on its schema, by position."""
    if not data:
        raise ValueError("no rows to append")
    if df is None:
        raise ValueError("no frame to append to")
    return df.union(df.sparkSession.createDataFrame(data, df.schema))


def concat_by_name(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    """Frames as one, matched by column name, duplicates kept; None when there are none."""
    given = [frame for frame in frames if frame is not None]
    if not given:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), given)
