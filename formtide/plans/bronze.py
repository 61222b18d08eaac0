"""Bronze: landing records to one text table per form (M2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.functions.columns import as_column
from formtide.functions.fixed_values import FORMS
from formtide.functions.paths import layer_path
from formtide.functions.text import fix_texts
from formtide.operators.profile import counted
from formtide.operators.project import with_processing_time
from formtide.operators.records import normalize_fields, sorted_keys, top_level_fields
from formtide.operators.reshape import fields_to_columns
from formtide.plans.report import Skipped, run_each
from formtide.sources.pipe_csv import write_pipe_csv
from formtide.sources.submissions import read_submissions
from formtide.sources.tables import write_parquet


def bronze_fields(records: DataFrame, flat: bool = True, depth: int | None = None) -> DataFrame:
    """Records ``record`` to ``fields``, a map of texts.

    Landing writes flat records, which become maps row by row. ``flat=False`` also takes
    nested documents from elsewhere: objects are flattened, lists stay cells.
    """
    if flat:
        return records.select(top_level_fields(F.col("record")).alias("fields"))
    return normalize_fields(records.select("record"), "record", depth=depth)


def bronze_table(
    fields: DataFrame,
    keys: list[str] | None = None,
    moment: Column | None = None,
    compose: bool = True,
) -> DataFrame:
    """Maps of fields to columns: union of keys, text repaired, processing time added."""
    keys = sorted_keys(fields, "fields") if keys is None else keys
    cells = fields_to_columns(fields.select("fields"), "fields", keys)
    by_name: dict[str, list[str]] = {}
    for key in keys:
        by_name.setdefault(key.replace(".", "_"), []).append(key)
    table = cells.select(
        *[F.coalesce(*map(as_column, same)).alias(name) for name, same in by_name.items()]
    )
    table = fix_texts(table, table.columns, compose=compose, replacements=True)
    return with_processing_time(table, moment)


def run_bronze(
    spark: SparkSession,
    landing_prefix: str,
    bronze_prefix: str,
    forms: list[str] = FORMS,
    flat: bool = True,
    charset: str = "UTF-8",
    documents: bool = False,
    export: bool = False,
    parallel: int = 4,
) -> DataFrame:
    """Write every form's bronze table (Parquet, optionally a CSV export) and report per form."""

    def job(form: str) -> int:
        source = layer_path(landing_prefix, form, "json")
        fields = bronze_fields(read_submissions(spark, source, charset, documents), flat)
        keys = sorted_keys(fields, "fields")
        if not keys:
            raise Skipped("no records")
        table, count = counted(bronze_table(fields, keys))
        target = layer_path(bronze_prefix, form, "parquet")
        write_parquet(table, target)
        if export:
            csv = layer_path(bronze_prefix, form, "csv")
            write_pipe_csv(spark.read.parquet(target), csv, quoting=False)
        return count.get["rows"]

    return run_each(spark, forms, job, parallel)
