"""Projections, filters, column selection and lineage columns."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formtide.functions.columns import as_column, quoted
from formtide.functions.fixed_values import (
    DATE_FLOOR,
    LINK_FORM,
    LINK_SUBMISSION,
    LINK_URL,
    MEDIA_KINDS,
    PROCESSED_AT,
    PROCESSED_AT_FORMAT,
    SUBMISSION_ID,
)


def filter_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column equals a value; nulls fall out."""
    return df.filter(as_column(column) == F.lit(value))


def floor_epoch_ms(floor: str = DATE_FLOOR, zone: str = "UTC") -> int:
    """A wall-clock date in a zone as epoch milliseconds."""
    moment = datetime.strptime(floor, "%Y-%m-%d %H:%M:%S").replace(tzinfo=ZoneInfo(zone))
    return int(moment.timestamp() * 1000)


def on_or_after(
    df: DataFrame, epoch_ms: Column | str, floor: str = DATE_FLOOR, zone: str = "UTC"
) -> DataFrame:
    """Rows dated on or after a floor; missing or non-numeric dates fall out.

    Compares epoch numbers, so a numeric column pushes the filter into the scan.
    """
    moment = as_column(epoch_ms)
    is_text = not isinstance(epoch_ms, str) or df.schema[epoch_ms].dataType.simpleString() == "string"
    number = moment.try_cast("double") if is_text else moment
    return df.filter(number >= F.lit(floor_epoch_ms(floor, zone)))


def select_existing_as(df: DataFrame, mapping: list[tuple[str, str]]) -> DataFrame:
    """Mapped source columns that exist, in map order, renamed."""
    present = set(df.columns)
    return df.select(
        *[F.col(quoted(source)).alias(target) for source, target in mapping if source in present]
    )


def normalize_names(df: DataFrame) -> DataFrame:
    """Column names with ``.`` replaced by ``_``."""
    return df.toDF(*[name.replace(".", "_") for name in df.columns])


def columns_by_keyword(columns: list[str], keywords: list[str]) -> list[str]:
    """Names that contain any keyword, in any case (P5)."""
    return [name for name in columns if any(word in name.lower() for word in keywords)]


def media_columns(columns: list[str], kind: str) -> list[str]:
    """Names of the columns that hold one kind of media (P5)."""
    return columns_by_keyword(columns, MEDIA_KINDS[kind]["keywords"])


def rename_optional(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist."""
    return df.withColumnsRenamed(names)


def drop_matching_keep_one(df: DataFrame, pattern: str, keep: str) -> DataFrame:
    """Drop columns whose name contains a pattern, re-append one of them at the end."""
    rest = [quoted(name) for name in df.columns if pattern not in name]
    kept = [quoted(keep)] if keep in df.columns else []
    return df.select(*rest, *kept)


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.dropna(subset=columns)


def with_processing_time(df: DataFrame, moment: Column | None = None) -> DataFrame:
    """Add the processing time as text (P10)."""
    now = F.current_timestamp() if moment is None else moment
    return df.withColumn(PROCESSED_AT, F.date_format(now, PROCESSED_AT_FORMAT))


def with_form(df: DataFrame, form: Column | str, name: str = LINK_FORM) -> DataFrame:
    """Add the form name (P10)."""
    return df.withColumn(name, F.lit(form) if isinstance(form, str) else form)


def id_column(columns: list[str]) -> str:
    """The submission id column, or the first column when there is none."""
    return SUBMISSION_ID if SUBMISSION_ID in columns else columns[0]


def link_columns(df: DataFrame, kind: str) -> DataFrame:
    """The columns of a link table, named per media kind."""
    return df.select(
        F.col(LINK_SUBMISSION),
        F.col("file_id").alias(MEDIA_KINDS[kind]["id_column"]),
        F.col("url").alias(LINK_URL),
        F.col("form").alias(LINK_FORM),
    )
