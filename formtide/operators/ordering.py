"""Sorts, limits, pages and top-1 per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formtide.functions.columns import as_column, quoted


def sort_descending(df: DataFrame, column: str, *tiebreak: str) -> DataFrame:
    """Rows by a column, highest first (O1)."""
    return df.orderBy(as_column(column).desc(), *[as_column(name).asc() for name in tiebreak])


def latest_per_key(
    df: DataFrame, keys: list[str], moment: str, *tiebreak: str
) -> DataFrame:
    """The latest row per key, ties by the tiebreak columns (O2).

    Spark limits every key to its first row before the shuffle, so a key that fills a third of
    the input sends one row per task.
    """
    order = [as_column(moment).desc(), *[as_column(name).asc() for name in tiebreak]]
    window = Window.partitionBy(*[quoted(key) for key in keys]).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def page_slice(df: DataFrame, order: list[Column], page: int, size: int = 100) -> DataFrame:
    """Page ``page`` (from 0) of the sorted rows; the order needs a unique tiebreak (O3).

    Every task keeps its first ``(page + 1) * size`` rows only. For deep pages see ``seek_page``.
    """
    return df.orderBy(*order).offset(page * size).limit(size)


def seek_page(
    df: DataFrame, keys: list[str], page: int, size: int = 100, descending: bool = False, fan_out: int = 64
) -> DataFrame:
    """Page ``page`` (from 0) of the rows in the order of unique ``keys``, whatever its depth (O3).

    The rows before the page are counted, not moved: ``fan_out`` keys cut the rows into ranges, a scan
    of the keys counts these, and the range in which the page starts is cut again until it holds
    no more than ten pages. Only rows from its first key on are then sorted, and every task sends at
    most the rest of that range and one page. Cuts only steer the search, so the page is exact. Each
    round is one job on the keys; there are about ``log(rows) / log(fan_out)``. Nulls come first,
    in descending order last. A page beyond the end is empty.
    """
    key = F.struct(*[as_column(name) for name in keys])
    order = [as_column(name).desc() if descending else as_column(name).asc() for name in keys]
    kind = df.select(key.alias("key")).schema["key"].dataType

    def cut(row) -> Column:
        cells = [F.lit(value).cast(field.dataType) for value, field in zip(row, kind.fields)]
        return F.struct(*[cell.alias(field.name) for cell, field in zip(cells, kind.fields)])

    def before(row) -> Column:
        return key > cut(row) if descending else key < cut(row)

    start, inside, skip = None, F.lit(True), page * size
    while skip > 10 * size:
        ranges = df.filter(inside).select(*[as_column(name) for name in keys])
        sample = ranges.orderBy(F.xxhash64(*[as_column(name) for name in keys]), *order).limit(fan_out)
        cuts = [tuple(row) for row in sample.orderBy(*order).collect()]
        if len(cuts) < 2:
            break
        counts = df.filter(inside).agg(*[F.count_if(before(row)).alias(f"n{i}") for i, row in enumerate(cuts)]).first()
        last = max((i for i, n in enumerate(counts) if n <= skip), default=None)
        end = None if last == len(cuts) - 1 else cuts[0 if last is None else last + 1]
        if last is not None:
            if counts[last] == 0 and end is None:
                break
            skip, start = skip - counts[last], cuts[last]
        inside = (F.lit(True) if start is None else ~before(start)) & (F.lit(True) if end is None else before(end))
    rows = df if start is None else df.filter(~before(start))
    return rows.orderBy(*order).offset(skip).limit(size)


def take(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows of a listing."""
    return df.limit(n)


def sorted_columns(df: DataFrame) -> DataFrame:
    """Columns in alphabetical order."""
    return df.select(*[quoted(name) for name in sorted(df.columns)])
