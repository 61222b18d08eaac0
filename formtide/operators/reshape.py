"""Wide to long and long to wide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formtide.functions.columns import quoted


def melt(
    df: DataFrame,
    id_columns: list[str],
    value_columns: list[str],
    name: str = "source_column",
    value: str = "value",
) -> DataFrame:
    """One row per id and column; values as text because columns may differ in type."""
    ids = [F.col(quoted(column)) for column in id_columns]
    values = [F.col(quoted(column)).cast("string").alias(column) for column in value_columns]
    narrow = df.select(*ids, *values)
    return narrow.unpivot(ids, [F.col(quoted(column)) for column in value_columns], name, value)


def single_media(df: DataFrame, id_column: str, columns: list[str], value: str) -> DataFrame:
    """The id and the first of the media columns, renamed (R2)."""
    return df.select(F.col(quoted(id_column)), F.col(quoted(columns[0])).cast("string").alias(value))


def pivot_wide(leaves: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """One row per record, one column per listed path.

    If a path occurs twice in a record, the value nearest the root wins.
    """
    nearest = F.min_by("value", "level") if "level" in leaves.columns else F.first("value")
    return leaves.groupBy(*[quoted(name) for name in by]).pivot("path", keys).agg(nearest)


def gather_fields(leaves: DataFrame, by: list[str], fields: str = "fields") -> DataFrame:
    """One row per record with all its leaves in a ``map<string,string>`` (R3, open schema).

    Leaves of a record are merged before the shuffle, which moves one row per record. If a
    path occurs twice in a record, the value nearest the root wins.
    """
    entry = F.struct("path", "level", "value")
    records = leaves.groupBy(*[quoted(name) for name in by]).agg(
        F.array_sort(F.collect_list(entry)).alias("_entries")
    )
    entries = F.col("_entries")
    first_of_path = F.filter(
        entries,
        lambda e, i: (i == 0) | (e["path"] != F.get(entries, i - 1)["path"]),
    )
    pairs = F.transform(first_of_path, lambda e: F.struct(e["path"], e["value"]))
    return records.select(
        *[quoted(name) for name in by], F.map_from_entries(pairs).alias(fields)
    )


def path_collisions(leaves: DataFrame, by: list[str]) -> DataFrame:
    """Records and paths that more than one leaf claims, with the number of leaves."""
    counts = leaves.groupBy(*[quoted(name) for name in by], "path").agg(
        F.count(F.lit(1)).alias("collisions")
    )
    return counts.filter(F.col("collisions") > 1)


def fields_to_columns(df: DataFrame, fields: str, keys: list[str]) -> DataFrame:
    """A map column as one column per key, null where a record lacks it; row-local.

    A map is searched from its start for every key. One pass through JSON with the wanted
    schema finds all keys at once, whatever their number.
    """
    others = [quoted(name) for name in df.columns if name != fields]
    schema = T.StructType([T.StructField(key, T.StringType()) for key in keys])
    text = F.to_json(fields, {"ignoreNullFields": "false"})
    return df.select(*others, F.from_json(text, schema).alias("_row")).select(
        *others, *[F.col("_row")[key].alias(key) for key in keys]
    )
