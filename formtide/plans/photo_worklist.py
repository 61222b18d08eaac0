"""Photo work-list: photos that submissions refer to and the store lacks (M6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.functions.fixed_values import FORMS, PHOTO_PREFIX
from formtide.functions.paths import (
    base_name,
    file_id_of_reference,
    layer_path,
    path_segment,
    strip_extension,
)
from formtide.functions.text import ascii_fold
from formtide.operators.records import find_by_prefix
from formtide.plans.report import Skipped, run_each
from formtide.sources.submissions import read_submissions
from formtide.sources.tables import replace_unless_empty


def photo_references(records: DataFrame, depth: int | None = None) -> DataFrame:
    """Records ``form, record`` to ``form, file_id, gridfs_url``, one row per reference."""
    found = find_by_prefix(records, "record", PHOTO_PREFIX, depth=depth)
    return found.select(
        "form", file_id_of_reference("value").alias("file_id"), F.col("value").alias("gridfs_url")
    )


def stored_photos(listing: DataFrame) -> DataFrame:
    """Listed photos ``…/{form}/{file_id}.jpg`` to ``form, file_id``."""
    return listing.select(
        path_segment("path", -2).alias("form"),
        strip_extension(base_name("path"), ".jpg").alias("file_id"),
    )


def photo_worklist(references: DataFrame, stored: DataFrame) -> DataFrame:
    """Every referenced photo once: ``form, file_id, gridfs_url, references, status`` (K2, K3).

    References combine before the shuffle and the join reuses their partitioning, so a photo
    that is referred to by a third of all rows costs one row.
    """
    photos = references.groupBy("form", "file_id").agg(
        F.min("gridfs_url").alias("gridfs_url"), F.count(F.lit(1)).alias("references")
    )
    present = stored.select("form", "file_id").distinct().withColumn("_stored", F.lit(True))
    status = F.when(F.col("_stored"), "present").otherwise("missing")
    return photos.join(present, ["form", "file_id"], "left").select(
        "form", "file_id", "gridfs_url", "references", status.alias("status")
    )


def photo_counts(worklist: DataFrame, total: bool = False) -> DataFrame:
    """Photos to fetch and references to skip per form (A3).

    Once a missing photo is fetched, further references to it are skipped too.
    """
    missing = F.col("status") == "missing"
    skipped = F.col("references") - missing.cast("bigint")
    grouped = worklist.rollup("form") if total else worklist.groupBy("form")
    return grouped.agg(
        F.count_if(missing).alias("to_fetch"), F.sum(skipped).alias("skipped")
    )


def photo_metadata(worklist: DataFrame, source: str, moment: Column | None = None) -> DataFrame:
    """Object metadata of the photos to fetch, folded to ASCII (C17)."""
    now = F.current_timestamp() if moment is None else moment
    values = {
        "source": F.lit(source),
        "form_name": F.col("form"),
        "original_gridfs_url": F.col("gridfs_url"),
        "file_id": F.col("file_id"),
        "processing_date": F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    }
    missing = worklist.filter(F.col("status") == "missing")
    return missing.select(*[ascii_fold(value).alias(name) for name, value in values.items()])


def run_photo_worklist(
    spark: SparkSession,
    landing_prefix: str,
    listing: DataFrame,
    target_prefix: str,
    forms: list[str] = FORMS,
    parallel: int = 4,
) -> DataFrame:
    """Write every form's work-list from its landing records and report per form.

    ``listing`` has a ``path`` per stored photo. A form without photos keeps what it has.
    """
    stored = stored_photos(listing)

    def job(form: str) -> int:
        records = read_submissions(spark, layer_path(landing_prefix, form, "json"))
        references = photo_references(records.withColumn("form", F.lit(form)))
        work = photo_worklist(references, stored.filter(F.col("form") == form))
        rows = replace_unless_empty(work, layer_path(target_prefix, form, "parquet"))
        if not rows:
            raise Skipped("no photos")
        return rows

    return run_each(spark, forms, job, parallel)
