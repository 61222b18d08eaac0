"""Counts, metadata, structure summaries and differences between structures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from formtide.functions.columns import as_column, quoted
from formtide.operators.records import _as_variant, kind_of


def _names(values: list[str]) -> Column:
    return F.array(*[F.lit(value) for value in values]).cast("array<string>")


def dataset_metadata(df: DataFrame, date_column: str) -> DataFrame:
    """Row count, first and last date, list of columns (A1). One row."""
    has_date = date_column in df.columns
    date = as_column(date_column) if has_date else F.lit(None).cast("timestamp")
    return df.agg(
        F.count(F.lit(1)).alias("quantidade_registros"),
        F.min(date).alias("periodo_inicio"),
        F.max(date).alias("periodo_fim"),
    ).withColumn("colunas_disponiveis", _names(df.columns))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Number of rows (A2). One row."""
    return df.agg(F.count(F.lit(1)).alias(name))


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame and an observation of its row count, filled by the write itself (A2)."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def outcome_counts(
    df: DataFrame, by: str, status: str, outcomes: dict[str, str], total: bool = False
) -> DataFrame:
    """Rows per outcome and group (A3); ``total`` adds a grand-total row with a null group.

    ``outcomes`` maps a status value to the name of its counter.
    """
    counters = [
        F.count_if(as_column(status) == value).alias(name) for value, name in outcomes.items()
    ]
    grouped = df.rollup(quoted(by)) if total else df.groupBy(quoted(by))
    return grouped.agg(*counters)


def type_names(df: DataFrame) -> list[str]:
    """Sorted distinct type names of a frame."""
    return sorted({field.dataType.simpleString() for field in df.schema.fields})


def structure_summary(df: DataFrame) -> DataFrame:
    """Column count, names, row count and types (A4). One row."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(len(df.columns)).alias("column_count"),
        _names(df.columns).alias("column_names"),
        "row_count",
        _names(type_names(df)).alias("data_types"),
    )


def type_sets(df: DataFrame, source: str) -> DataFrame:
    """Types of the non-null values of every top-level key, null when there are none (A5).

    One pass; the number of types per key is fixed, so groups merge before the shuffle.
    """
    records = df.select(_as_variant(df, source).alias("_node"))
    entries = records.sparkSession.tvf.variant_explode(F.col("_node").outer())
    values = records.lateralJoin(entries.toDF("_position", "path", "_child")).filter(
        F.col("path").isNotNull()
    )
    kind = kind_of(F.col("_child"))
    kinds = values.select("path", F.when(kind != "null", kind).alias("kind")).distinct()
    sets = kinds.groupBy("path").agg(F.array_sort(F.collect_set("kind")).alias("types"))
    return sets.select("path", F.when(F.size("types") > 0, F.col("types")).alias("types"))


def set_difference(left: list[str], right: list[str]) -> Column:
    """Names in the left list only."""
    return F.array_except(_names(left), _names(right))


def transformation_diff(name: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns and types added and removed, signed change of the row count (A7). One row."""
    lost = before.agg((-F.count(F.lit(1))).alias("rows"))
    gained = after.agg(F.count(F.lit(1)).alias("rows"))
    old_types, new_types = type_names(before), type_names(after)
    return lost.union(gained).agg(F.sum("rows").alias("row_change")).select(
        F.lit(name).alias("transformation_name"),
        F.array_sort(set_difference(after.columns, before.columns)).alias("columns_added"),
        F.array_sort(set_difference(before.columns, after.columns)).alias("columns_removed"),
        "row_change",
        F.array_sort(set_difference(new_types, old_types)).alias("types_added"),
        F.array_sort(set_difference(old_types, new_types)).alias("types_removed"),
    )
