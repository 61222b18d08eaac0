"""Landing to bronze over new files only.

The batch jobs replace a layer. Where landing files are only ever added, a file stream with a
checkpoint processes each of them once. All steps work row by row: no state, no watermark.
Fields stay a map, because the union of keys is known only when a batch reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from formtide.functions.paths import path_segment
from formtide.functions.text import repair_fields
from formtide.operators.project import with_processing_time
from formtide.operators.records import parse_json, top_level_fields
from formtide.sources.submissions import form_of_path


def landing_stream(spark: SparkSession, landing_prefix: str) -> DataFrame:
    """Stream of flat records ``form, fields`` from JSON-line files below a prefix."""
    lines = spark.readStream.option("recursiveFileLookup", True).text(landing_prefix)
    path = F.col("_metadata.file_path")
    folder = F.regexp_replace(path_segment(path, -2), "^form=", "")
    record = parse_json(F.make_valid_utf8("value"))
    records = lines.select(form_of_path(path, folder).alias("form"), record.alias("record"))
    return records.select("form", top_level_fields(F.col("record")).alias("fields")).filter(
        F.col("fields").isNotNull()
    )


def append_bronze(
    spark: SparkSession, landing_prefix: str, bronze_path: str, checkpoint: str
) -> StreamingQuery:
    """Process the files that are new since the last run, then stop."""
    repaired = repair_fields(landing_stream(spark, landing_prefix))
    return (
        with_processing_time(repaired)
        .writeStream.format("parquet")
        .partitionBy("form")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(bronze_path)
    )
