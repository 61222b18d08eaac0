"""Silver: declarative projection and casts per form (F1–F8, M3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.functions import casts, text
from formtide.functions.columns import as_column
from formtide.functions.fixed_values import FORMS
from formtide.functions.paths import layer_path, route_name
from formtide.operators.profile import counted
from formtide.plans.form_specs import FORM_SPECS, FormSpec
from formtide.plans.report import Skipped, run_each
from formtide.sources.pipe_csv import write_pipe_csv
from formtide.sources.tables import read_parquet_or_none, write_parquet

CASTS = {
    "text": as_column,
    "number": casts.to_number,
    "epoch_ms": casts.epoch_ms_to_timestamp,
    "timestamp": casts.text_to_timestamp,
    "epoch_or_text": casts.epoch_or_text_to_timestamp,
    "upper": text.upper_strip,
    "title": text.title_strip,
    "yes_no": casts.yes_no,
}
TEXTUAL = {"text", "upper", "title", "yes_no"}


class MissingColumns(Exception):
    """A bronze table lacks columns its form requires."""


def silver_table(
    bronze: DataFrame, spec: FormSpec, repair: bool = True, columns: list[str] | None = None
) -> DataFrame:
    """One form's silver table: mapped columns that exist, in map order, cast (F1–F8).

    Text cells are repaired once more and become null when they stand for a missing value. A reader of
    a few silver columns names them in ``columns``; then the others are neither read nor repaired.
    """
    present = set(bronze.columns)
    missing = [
        source
        for source, target, _ in spec.columns
        if target in spec.required and source not in present
    ]
    if missing:
        raise MissingColumns(f"{spec.name}: {', '.join(missing)}")

    entries = [
        entry
        for entry in spec.columns
        if entry[0] in present and (columns is None or entry[1] in columns)
    ]
    textual = list(dict.fromkeys(source for source, _, cast in entries if cast in TEXTUAL))
    others = list(dict.fromkeys(source for source, _, cast in entries if cast not in TEXTUAL))
    text_of = {source: f"_text{place}" for place, source in enumerate(textual)}
    texts = [
        text.missing_to_null(as_column(source).cast("string")).alias(name)
        for source, name in text_of.items()
    ]
    cells = bronze.select(*map(as_column, others), *texts)
    if repair:
        cells = text.fix_texts(cells, list(text_of.values()), decode_first=True)

    def cell(source: str, target: str, cast: str) -> Column:
        value = F.col(text_of[source]) if cast in TEXTUAL else as_column(source)
        return CASTS[cast](value).alias(target)

    return cells.select(*[cell(*entry) for entry in entries])


def route_table(bronze: DataFrame, name: str) -> DataFrame | None:
    """The silver table for a bronze table known by its file name; None without a route."""
    form = route_name(name)
    return None if form is None else silver_table(bronze, FORM_SPECS[form])


def run_silver(
    spark: SparkSession,
    bronze_prefix: str,
    silver_prefix: str,
    names: list[str] = FORMS,
    export: bool = False,
    parallel: int = 4,
) -> DataFrame:
    """Write every form's silver table (Parquet, optionally a CSV export) and report per form."""

    def job(name: str) -> int:
        bronze = read_parquet_or_none(spark, layer_path(bronze_prefix, name, "parquet"))
        if bronze is None:
            raise Skipped("no bronze table")
        silver = route_table(bronze, name)
        if silver is None:
            raise Skipped("no form matches the name")
        if silver.isEmpty():
            raise Skipped("empty table")
        table, count = counted(silver)
        target = f"{silver_prefix.rstrip('/')}/{route_name(name)}/{name}"
        write_parquet(table, f"{target}.parquet")
        if export:
            write_pipe_csv(spark.read.parquet(f"{target}.parquet"), f"{target}.csv")
        return count.get["rows"]

    return run_each(spark, names, job, parallel)
