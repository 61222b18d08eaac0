"""Sources and sinks: tables are written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from formtide.operators.records import row_to_json
from formtide.plans import gold
from formtide.plans.landing import fields_to_json
from formtide.sources import objects, pipe_csv, submissions, tables
from formtide.streaming.incremental import append_bronze


@query("SELECT * FROM supplier")
def convert_table(t):
    orc = t.scratch("supplier.orc")
    tables.convert(t.spark, f"{t.folder}/supplier.parquet", orc)
    return tables.read_table(t.spark, orc)


@query("SELECT p_partkey, p_name, p_type FROM part")
def write_and_read_csv(t):
    target = t.scratch("part.csv")
    options = {"sep": "\t", "header": "true"}
    tables.write_table(t.part.select("p_partkey", "p_name", "p_type"), target, options)
    return tables.read_table(t.spark, target, {**options, "inferSchema": "true"}).withColumn(
        "p_partkey", F.col("p_partkey").cast("bigint")
    )


@query("SELECT * FROM customer")
def empty_table(t):
    # rows appended to a table that has only a schema
    return tables.empty_table(t.spark, t.customer.schema).union(t.customer)


@query("SELECT event_type, event_id, value FROM events WHERE event_type = 'view'")
def partitioned_parquet(t):
    target = t.scratch("events.parquet")
    tables.write_parquet(t.events.select("event_type", "event_id", "value"), target, ["event_type"])
    return tables.read_parquet_or_none(t.spark, target).filter("event_type = 'view'")


@query(
    """
    SELECT c_custkey::VARCHAR AS c_custkey, c_name || ' "x" |' AS c_name,
           CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment
    FROM customer
    """
)
def pipe_csv_round_trip(t):
    target = t.scratch("customer.csv")
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "N/A").otherwise(F.col("c_mktsegment"))
    name = F.concat("c_name", F.lit(' "x" |'))
    pipe_csv.write_pipe_csv(
        t.customer.select("c_custkey", name.alias("c_name"), segment.alias("c_mktsegment")), target
    )
    return pipe_csv.read_pipe_csv(t.spark, target, charset="UTF-8")


@query(
    """
    SELECT s_suppkey, CASE WHEN s_acctbal >= 5000 THEN NULL ELSE s_name END AS s_name
    FROM supplier WHERE s_acctbal >= 0
    """
)
def silver_export_bad_lines(t):
    # short lines are padded, long ones skipped
    line = F.expr(
        "CASE WHEN s_acctbal >= 5000 THEN cast(s_suppkey AS string) WHEN s_acctbal < 0 THEN concat(s_suppkey, '|a|b') "
        "ELSE concat(s_suppkey, '|', s_name) END"
    )
    target = t.scratch("supplier.csv")
    t.supplier.select(line.cast("string").alias("s_suppkey|s_name")).write.option("header", True).option(
        "sep", "\t"
    ).csv(target)
    schema = tables.empty_table(t.spark, "s_suppkey bigint, s_name string").schema
    return pipe_csv.read_silver_export(t.spark, target, schema)


@query("SELECT event_type AS form, event_id, user_id FROM events")
def submissions_round_trip(t):
    target = t.scratch("submissions")
    rows = t.events.select(
        F.col("event_type").alias("form"), row_to_json(t.events, ["event_id", "user_id"]).alias("record")
    )
    submissions.write_submissions(rows, target)
    record = submissions.read_submissions(t.spark, target)
    return record.select(
        "form",
        F.try_variant_get("record", "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get("record", "$.user_id", "bigint").alias("user_id"),
    )


@query("SELECT DISTINCT 'event_type=' || event_type AS form FROM events")
def list_objects(t):
    media = t.scratch("media")
    lines = t.events.select("event_type", F.col("event_id").cast("string").alias("value"))
    lines.write.partitionBy("event_type").text(f"{media}/images")
    listing = objects.list_objects(t.spark, media, ".txt")
    return objects.media_objects(listing, "images").select("form").distinct()


@query(
    """
    SELECT 's_nationkey=' || s_nationkey AS form, 's_suppkey=' || s_suppkey AS object,
           'images/s_nationkey=' || s_nationkey || '/s_suppkey=' || s_suppkey AS folder,
           length(s_name) + 1 AS n_bytes
    FROM supplier
    """
)
def list_object_keys(t):
    # one object per row: a lost, doubled or wrongly keyed object shows
    media = t.scratch("media")
    suppliers = t.ranged("supplier", "s_nationkey", "s_suppkey")
    lines = suppliers.select("s_nationkey", "s_suppkey", F.col("s_name").alias("value"))
    lines.write.partitionBy("s_nationkey", "s_suppkey").text(f"{media}/images")
    listing = objects.list_objects(t.spark, media, ".txt")
    found = objects.media_objects(listing, "images")
    sizes = listing.select(
        F.regexp_extract("path", "(images/.+)$", 1).alias("key"), F.col("length").alias("n_bytes")
    )
    return found.join(sizes, "key").select(
        "form",
        F.split_part("file_name", F.lit("/"), F.lit(1)).alias("object"),
        F.regexp_extract("key", "^(.+)/[^/]+$", 1).alias("folder"),
        "n_bytes",
    )


@query("SELECT c_custkey, c_name AS pdf_file_id FROM customer")
def latest_tables(t):
    # the later of two silver tables becomes the gold table
    silver, target = t.scratch("silver"), t.scratch("gold")
    name = F.col("c_name").alias("mailStatuses_0_pdfFileId")
    tables.write_parquet(t.supplier.select("s_suppkey"), f"{silver}/ilum/z.parquet")
    tables.write_parquet(t.customer.select("c_custkey", name), f"{silver}/ilum/a.parquet")
    gold.run_gold(t.spark, silver, target, ["ilum"])
    return t.spark.read.parquet(f"{target}/ilum/ilum.parquet")


@query("SELECT sum(length(text) + 1)::BIGINT AS n_chars FROM documents")
def read_binary(t):
    target = t.scratch("documents")
    t.documents.select(F.col("text").alias("value")).write.text(target)
    content = objects.read_binary(t.spark, f"{target}/*.txt")
    return content.agg(F.sum(F.length("content")).cast("bigint").alias("n_chars"))


@query(
    """
    SELECT event_type AS form, event_id::VARCHAR AS event_id, 'Não ' || event_type AS note FROM events
    """
)
def stream_landing_to_bronze(t):
    landing, bronze = t.scratch("landing"), t.scratch("bronze")
    fields = F.create_map(
        F.lit("event_id"), F.col("event_id").cast("string"),
        F.lit("note"), F.concat(F.lit("N√£o "), "event_type"),
    )
    rows = t.events.select(F.col("event_type").alias("form"), fields_to_json(fields).alias("record"))
    submissions.write_submissions(rows, landing)
    append_bronze(t.spark, landing, bronze, t.scratch("checkpoint")).awaitTermination()
    table = t.spark.read.parquet(bronze)
    return table.select(
        "form", *[F.col("fields").getItem(name).alias(name) for name in ("event_id", "note")]
    )
