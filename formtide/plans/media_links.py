"""Gold media links: submissions with the public addresses of their media (M5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.functions.columns import quoted
from formtide.functions.fixed_values import FORMS, LINK_SUBMISSION, MEDIA_KINDS
from formtide.functions.paths import layer_path, public_url, strip_extension, text_after_prefix
from formtide.operators.joins import link_media
from formtide.operators.project import drop_missing, id_column, link_columns, media_columns
from formtide.operators.reshape import melt, single_media
from formtide.operators.unions import concat_by_name
from formtide.plans.report import Skipped, run_each
from formtide.sources.objects import list_objects, media_objects
from formtide.sources.tables import read_parquet_or_none, replace_unless_empty


def form_media(table: DataFrame, form: str, kind: str) -> DataFrame | None:
    """Media references of one gold table: ``form, submission_id, file_id``.

    None when the table has no column of that kind.
    """
    media = MEDIA_KINDS[kind]
    id_name = id_column(table.columns)
    columns = [name for name in media_columns(table.columns, kind) if name != id_name]
    if not columns:
        return None
    if media["melted"]:
        long = melt(table, [id_name], columns, value="code")
    else:
        long = single_media(table, id_name, columns, "code")
    code = F.col("code")
    file_id = code if media["prefix"] is None else text_after_prefix(code, media["prefix"])
    references = drop_missing(long, ["code"]).select(
        F.lit(form).alias("form"),
        F.col(quoted(id_name)).cast("string").alias(LINK_SUBMISSION),
        file_id.alias("file_id"),
    )
    return drop_missing(references, ["file_id"])


def media_references(tables: dict[str, DataFrame], kind: str) -> DataFrame | None:
    """Media references of all gold tables (U2); None when no table has any."""
    return concat_by_name(form_media(table, form, kind) for form, table in tables.items())


def object_links(objects: DataFrame, bucket: str, key_prefix: str = "") -> DataFrame:
    """Media objects ``form, file_name, key`` to ``form, file_id, url``."""
    prefix = f"{key_prefix.strip('/')}/" if key_prefix.strip("/") else ""
    return objects.select(
        "form",
        F.coalesce(strip_extension("file_name"), F.lit("")).alias("file_id"),
        public_url(bucket, F.concat(F.lit(prefix), "key")).alias("url"),
    )


def media_links(references: DataFrame, links: DataFrame, kind: str) -> DataFrame:
    """The link table of one kind: ids join within their form only."""
    return link_columns(link_media(references, links), kind)


def run_media_links(
    spark: SparkSession,
    gold_prefix: str,
    media_prefix: str,
    bucket: str,
    key_prefix: str = "",
    forms: list[str] = FORMS,
    kinds: list[str] = list(MEDIA_KINDS),
    parallel: int = 3,
    listing: DataFrame | None = None,
) -> DataFrame:
    """Write one link table per media kind, all forms in one plan, and report per kind.

    ``listing``, a frame with a ``path`` per object such as a bucket inventory, takes the place
    of a listing of ``media_prefix``, which passes through the driver. A kind without links
    keeps the table it has.
    """
    found = list_objects(spark, media_prefix, min_size=0) if listing is None else listing
    tables = {
        form: table
        for form in forms
        if (table := read_parquet_or_none(spark, layer_path(gold_prefix, form, "parquet")))
        is not None
    }

    def job(kind: str) -> int:
        references = media_references(tables, kind)
        if references is None:
            raise Skipped("no media columns")
        objects = media_objects(found, kind, forms)
        table = media_links(references, object_links(objects, bucket, key_prefix), kind)
        rows = replace_unless_empty(table, layer_path(gold_prefix, kind, "parquet"))
        if not rows:
            raise Skipped("no links")
        return rows

    return run_each(spark, kinds, job, parallel)
