"""Gold: the latest silver table of every form (M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.functions.fixed_values import FORMS, MAIL_PDF, PDF_FILE_ID
from formtide.functions.paths import layer_path
from formtide.operators.ordering import latest_per_key
from formtide.operators.profile import counted
from formtide.operators.project import rename_optional
from formtide.plans.report import Skipped, run_each
from formtide.sources.objects import list_objects
from formtide.sources.pipe_csv import read_silver_export
from formtide.sources.tables import write_parquet

# A table is a file, or a folder of part files, with one of these extensions.
TABLE = r"^(.*?/([^/]+)/[^/]+\.(?:csv|parquet))(?:/[^/]+)?$"


def tables_in(listing: DataFrame) -> DataFrame:
    """Listed objects to tables: ``form, table, modified``, the form being the table's folder."""
    named = listing.select(
        F.regexp_extract("path", TABLE, 2).alias("form"),
        F.regexp_extract("path", TABLE, 1).alias("table"),
        "modificationTime",
    ).filter(F.col("table") != "")
    return named.groupBy("form", "table").agg(F.max("modificationTime").alias("modified"))


def latest_tables(listing: DataFrame) -> DataFrame:
    """The latest table per form; equal times go to the first name (O2)."""
    return latest_per_key(tables_in(listing), ["form"], "modified", "table")


def gold_table(silver: DataFrame) -> DataFrame:
    """A silver table under gold names."""
    return rename_optional(silver, {MAIL_PDF: PDF_FILE_ID})


def run_gold(
    spark: SparkSession,
    silver_prefix: str,
    gold_prefix: str,
    forms: list[str] = FORMS,
    extension: str = "parquet",
    parallel: int = 4,
) -> DataFrame:
    """Write every form's gold table from its latest silver table and report per form.

    ``extension="csv"`` takes the latest CSV export instead of the typed Parquet table.
    """

    def job(form: str) -> int:
        listing = list_objects(spark, f"{silver_prefix.rstrip('/')}/{form}")
        tables = tables_in(listing).filter(F.endswith("table", F.lit(f".{extension}")))
        latest = latest_per_key(tables, ["form"], "modified", "table").head()
        if latest is None:
            raise Skipped("no silver table")
        if extension == "csv":
            silver = read_silver_export(spark, latest.table)
        else:
            silver = spark.read.parquet(latest.table)
        table, count = counted(gold_table(silver))
        write_parquet(table, layer_path(gold_prefix, form, "parquet"))
        return count.get["rows"]

    return run_each(spark, forms, job, parallel)
