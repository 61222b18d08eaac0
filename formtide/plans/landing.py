"""Landing: API pages to flat, repaired records (M1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.functions.fixed_values import DATE_FLOOR, FORMS
from formtide.functions.paths import layer_path
from formtide.functions.text import repair_fields
from formtide.operators.profile import counted
from formtide.operators.project import on_or_after
from formtide.operators.records import kind_of, unfold_fields
from formtide.plans.report import Skipped, run_each
from formtide.sources.submissions import unpack_pages


def submission_date(submission: Column) -> Column:
    """``info.date`` in epoch milliseconds, null unless it is a JSON number."""
    date = F.try_variant_get(submission, "$.info.date", "variant")
    return F.when(kind_of(date).isin("int", "float"), date.try_cast("double"))


def landing_fields(
    submissions: DataFrame, depth: int | None = None, repair: bool = True
) -> DataFrame:
    """Submissions ``form, element`` to ``form, fields``: one map of flat paths per record; row-local."""
    records = unfold_fields(submissions.select("form", "element"), "element", depth=depth)
    return repair_fields(records) if repair else records


def dated_submissions(
    pages: DataFrame, floor: str = DATE_FLOOR, zone: str = "UTC"
) -> DataFrame:
    """Submissions of pages ``form, page, body`` that are dated from the floor on."""
    return on_or_after(unpack_pages(pages), submission_date(F.col("element")), floor, zone)


def landing_records(
    pages: DataFrame, depth: int | None = None, floor: str = DATE_FLOOR, zone: str = "UTC"
) -> DataFrame:
    """Pages ``form, page, body`` to ``form, fields``: dated from the floor on, flat, repaired."""
    return landing_fields(dated_submissions(pages, floor, zone), depth)


def fields_to_json(fields: Column | str) -> Column:
    """A map of fields as one JSON object, nulls included."""
    return F.to_json(fields, {"ignoreNullFields": "false"})


def run_landing(
    spark: SparkSession,
    pages: DataFrame,
    landing_prefix: str,
    forms: list[str] = FORMS,
    depth: int | None = None,
    zone: str = "UTC",
    parallel: int = 4,
) -> DataFrame:
    """Write every form's records as JSON lines and report per form.

    A form without valid submissions keeps what it has.
    """

    def job(form: str) -> int:
        submissions = dated_submissions(pages.filter(F.col("form") == form), zone=zone)
        # a dated submission has a leaf, its date, so it becomes a record
        if submissions.isEmpty():
            raise Skipped("no valid submissions")
        records = landing_fields(submissions, depth)
        lines, count = counted(records.select(fields_to_json("fields").alias("value")))
        lines.write.mode("overwrite").text(layer_path(landing_prefix, form, "json"))
        return count.get["rows"]

    return run_each(spark, forms, job, parallel)
