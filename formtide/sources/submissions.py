"""Submission documents: API pages, landing files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.functions.columns import quoted
from formtide.functions.paths import path_segment
from formtide.functions.text import windows_1252_text
from formtide.operators.joins import bounded_side
from formtide.operators.records import parse_json


def empty_page(document: Column) -> Column:
    """Whether a page document has no elements (or is no page document at all)."""
    return F.try_variant_get(document, "$.elements[0]", "variant").isNull()


def page_cutoffs(pages: DataFrame, body: str = "body") -> DataFrame:
    """The first empty page of every form that has one: ``form, cutoff``."""
    empty = pages.filter(empty_page(parse_json(body)))
    return empty.groupBy("form").agg(F.min("page").alias("cutoff"))


def unpack_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Page documents ``form, page, body`` to one row per element.

    Reading a form stops at its first empty page, so pages after a gap are ignored. The
    cut-offs, one row per form, are counted first: within the bound they are broadcast and the
    page bodies stay where they are; beyond it they are joined.
    """
    cutoffs = bounded_side(page_cutoffs(pages, body))
    others = [quoted(name) for name in pages.columns if name != body]
    kept = pages.join(cutoffs, "form", "left").filter(
        F.col("cutoff").isNull() | (F.col("page") < F.col("cutoff"))
    )
    documents = kept.select(
        *others, F.try_variant_get(parse_json(body), "$.elements", "variant").alias("_elements")
    )
    entries = documents.sparkSession.tvf.variant_explode(F.col("_elements").outer())
    return documents.lateralJoin(entries.toDF("position", "_key", "element")).select(
        *others, "position", "element"
    )


def read_submissions(
    spark: SparkSession, path: str, charset: str = "UTF-8", documents: bool = False
) -> DataFrame:
    """Landing files to one row per record: ``form, record``.

    The form is the folder of the file, or the ``form=`` partition. By default every line is a
    JSON record, which Spark splits over tasks. With ``documents`` every file is one JSON
    document, a list of records or a single one; such a file is one task.
    """
    latin = charset.lower() in ("windows-1252", "cp1252")
    if documents:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        files = files.filter(F.endswith("path", F.lit(".json")) & (F.col("length") > 0))
        raw = files.select(F.col("path").alias("_path"), F.col("content").alias("_bytes"))
    else:
        lines = spark.read.option("recursiveFileLookup", True).text(path)
        raw = lines.select(
            F.col("_metadata.file_path").alias("_path"), F.col("value").cast("binary").alias("_bytes")
        )
    if latin:
        text = windows_1252_text(F.decode("_bytes", "ISO-8859-1"))
    else:
        text = F.make_valid_utf8(F.col("_bytes").cast("string"))
    document = parse_json(text)
    folder = F.regexp_replace(path_segment("_path", -2), "^form=", "")
    records = raw.select(form_of_path(F.col("_path"), folder).alias("form"), document.alias("record"))
    if not documents:
        return records.filter(F.col("record").isNotNull())
    listed = F.try_variant_get("record", "$", "array<variant>")
    single = F.array("record")
    return records.filter(F.col("record").isNotNull()).select(
        "form", F.explode(F.coalesce(listed, single)).alias("record")
    )


def form_of_path(path: Column, folder: Column) -> Column:
    """Form of a landing file: ``form=`` partition, else ``…/{form}/{form}.json[/part]``."""
    table = F.regexp_extract(path, r"([^/]+)/\1\.[A-Za-z]+(?:/[^/]*)?$", 1)
    return F.when(table != "", table).otherwise(folder)


def write_submissions(records: DataFrame, path: str, value: str = "record") -> None:
    """Records ``form, record`` as JSON lines in UTF-8, one folder per form."""
    text = records.select("form", F.col(value).alias("value"))
    text.write.mode("overwrite").partitionBy("form").text(path)
