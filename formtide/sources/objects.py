"""Object listings and raw object content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.functions.text import decode_windows_1252


def list_objects(
    spark: SparkSession, prefix: str, suffix: str | None = None, min_size: int = 1
) -> DataFrame:
    """Objects below a prefix: ``path, modificationTime, length``.

    Listing is Spark's own: complete, parallel, and without empty objects. Content is not read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listing = reader.load(prefix).select("path", "modificationTime", "length")
    if suffix is not None:
        listing = listing.filter(F.endswith(F.lower("path"), F.lit(suffix.lower())))
    return listing.filter(F.col("length") >= min_size)


def media_objects(listing: DataFrame, kind: str, forms: list[str] | None = None) -> DataFrame:
    """Listed media of one kind: ``form, file_name, key`` from ``…/{kind}/{form}/{file}``.

    ``file_name`` is everything after the form; ``key`` starts at the kind.
    """
    # The only filter is one test of the path: a filter on a derived column would be pushed to
    # the scan with the whole derivation copied into it. Never-null columns keep a join on them
    # from adding such filters.
    media = listing.filter(F.col("path").rlike(f"(?:^|/){kind}/[^/]+/."))
    keys = media.select(F.regexp_extract("path", f"(?:^|/)({kind}/[^/]+/.+)$", 1).alias("key"))
    form = F.coalesce(F.split_part("key", F.lit("/"), F.lit(2)), F.lit(""))
    start = F.length(form) + F.lit(len(kind) + 3)
    named = keys.select(
        form.alias("form"),
        F.coalesce(F.col("key").substr(start, F.length("key")), F.lit("")).alias("file_name"),
        F.coalesce("key", F.lit("")).alias("key"),
    )
    return named if forms is None else named.filter(F.col("form").isin(forms))


def read_binary(spark: SparkSession, path: str, charset: str | None = "UTF-8") -> DataFrame:
    """Object content as text in a charset, or as bytes with ``charset=None``."""
    files = spark.read.format("binaryFile").load(path)
    if charset is None:
        content = F.col("content")
    elif charset.lower() in ("windows-1252", "cp1252"):
        content = decode_windows_1252("content")
    else:
        content = F.decode("content", charset)
    return files.select("path", content.alias("content"))
