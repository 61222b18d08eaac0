"""Readers and writers on temporary folders."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from catalog.registry import Tables
from formtide.functions.fixed_values import MISSING_TOKENS
from formtide.operators.records import parse_json
from formtide.plans import gold
from formtide.sources import objects, pipe_csv, submissions, tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def places(spark):
    return spark.createDataFrame([("well 12", 4), ("pond", 19), ("north gate", 3), ("é", 0)], "place string, visits int")


def test_tables(spark, places, tmp_path):
    options = {"format": "csv", "sep": "\t", "header": "true"}
    before = dict(options)
    tables.write_table(places, f"{tmp_path}/p.tsv", options)
    assert rows(tables.read_table(spark, f"{tmp_path}/p.tsv", {**options, "inferSchema": "true"})) == rows(places)
    assert options == before
    tables.convert(spark, f"{tmp_path}/p.tsv", f"{tmp_path}/p.json", options)
    assert sorted(tables.read_table(spark, f"{tmp_path}/p.json").columns) == ["place", "visits"]
    tables.write_table(places, f"{tmp_path}/p.parquet")
    tables.write_table(places.limit(1), f"{tmp_path}/p.parquet")
    assert tables.read_table(spark, f"{tmp_path}/p.parquet").count() == 1
    with pytest.raises(Exception, match="already exists"):
        tables.write_table(places, f"{tmp_path}/p.parquet", overwrite=False)
    for call in (lambda: tables.read_table(spark, ""), lambda: tables.write_table(places, "")):
        with pytest.raises(ValueError):
            call()
    assert tables.empty_table(spark, places.schema).count() == 0
    assert tables.read_parquet_or_none(spark, f"{tmp_path}/none.parquet") is None
    assert tables.table_format("s3a://b/k/x.orc?v=1") == "orc"


def test_unpack_pages_stops_at_the_first_empty_page(spark):
    def page(*ids):
        return json.dumps({"elements": [{"id": i} for i in ids]})

    data = [
        ("a", 0, page(1, 2)), ("a", 1, page(3)), ("a", 2, page()), ("a", 3, page(4)),
        ("b", 0, page(5)), ("c", 0, "{}"), ("c", 1, page(6)), ("d", 0, page(7)), ("d", 1, "broken"),
    ]
    pages = spark.createDataFrame(data, "form string, page int, body string")
    found = submissions.unpack_pages(pages).select(
        "form", "page", "position", F.try_variant_get("element", "$.id", "int")
    )
    assert rows(found) == [("a", 0, 0, 1), ("a", 0, 1, 2), ("a", 1, 0, 3), ("b", 0, 0, 5), ("d", 0, 0, 7)]
    plan = submissions.unpack_pages(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def record_ids(df):
    return rows(df.select("form", F.try_variant_get("record", "$.n", "string")))


def test_submission_documents_in_windows_1252(spark, tmp_path):
    for form, document in {"irsp": [{"n": "ação"}, {"n": "“x”"}], "amb": {"n": "só"}}.items():
        os.makedirs(f"{tmp_path}/{form}")
        with open(f"{tmp_path}/{form}/{form}.json", "wb") as file:
            file.write(json.dumps(document, ensure_ascii=False).encode("cp1252"))
    open(f"{tmp_path}/amb/empty.json", "wb").close()
    read = submissions.read_submissions(spark, str(tmp_path), "windows-1252", documents=True)
    assert record_ids(read) == [("amb", "só"), ("irsp", "ação"), ("irsp", "“x”")]


def test_submission_lines(spark, tmp_path):
    data = spark.createDataFrame([("a", '{"n":"é"}'), ("b", '{"n":"2"}')], "form string, record string")
    submissions.write_submissions(data, f"{tmp_path}/s")
    assert record_ids(submissions.read_submissions(spark, f"{tmp_path}/s")) == [("a", "é"), ("b", "2")]


def test_pipe_csv(spark, tmp_path):
    cells = ["x|y", 'say "hi"', "NA", "nÃ£o", " pad ", "“q”"]
    with open(f"{tmp_path}/t.csv", "wb") as file:
        lines = ["id|v"] + [f'{i}|"{c.replace(chr(34), chr(34) * 2)}"' for i, c in enumerate(cells)]
        file.write("\n".join(lines).encode("cp1252"))
    table = pipe_csv.read_pipe_csv(spark, f"{tmp_path}/t.csv")
    assert rows(table) == [
        ("0", "x|y"), ("1", 'say "hi"'), ("2", None), ("3", "não"), ("4", " pad "), ("5", '"q"'),
    ]
    raw = pipe_csv.read_pipe_csv(spark, f"{tmp_path}/t.csv", repair=False)
    assert rows(raw)[3:] == [("3", "nÃ£o"), ("4", " pad "), ("5", "“q”")]
    assert "N/A" in MISSING_TOKENS


def test_pipe_csv_export(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a|"b', None)], "x string, y string, z string")
    pipe_csv.write_pipe_csv(df, f"{tmp_path}/q")
    assert rows(pipe_csv.read_pipe_csv(spark, f"{tmp_path}/q", "UTF-8", repair=False)) == [("1", 'a|"b', None)]
    pipe_csv.write_pipe_csv(df, f"{tmp_path}/n", quoting=False)
    lines = sorted({r.value for r in spark.read.text(f"{tmp_path}/n").collect()}, reverse=True)
    assert lines == ["x|y|z", '1|a\\|"b|']


def test_bad_lines(spark, tmp_path):
    with open(f"{tmp_path}/b.csv", "w") as file:
        file.write('a|b\n1|2\n1|2|3\n1\n"x|y"|4\n')
    schema = tables.empty_table(spark, "a string, b int").schema
    exported = pipe_csv.read_silver_export(spark, f"{tmp_path}/b.csv", schema)
    assert rows(exported) == [("1", 2), ("1", None), ("x|y", 4)]
    assert exported.select("a").count() == 3
    inferred = pipe_csv.read_silver_export(spark, f"{tmp_path}/b.csv")
    assert dict(inferred.dtypes)["b"] == "int"


def test_objects(spark, tmp_path):
    os.makedirs(f"{tmp_path}/images/ilum/sub")
    for name, content in {"ilum/a.jpg": b"1", "ilum/sub/b.x.PNG": b"\xe7", "ilum/zero.jpg": b""}.items():
        with open(f"{tmp_path}/images/{name}", "wb") as file:
            file.write(content)
    listing = objects.list_objects(spark, str(tmp_path))
    assert listing.count() == 2
    assert objects.list_objects(spark, str(tmp_path), ".png").count() == 1
    media = objects.media_objects(objects.list_objects(spark, str(tmp_path), min_size=0), "images", ["ilum"])
    assert rows(media) == [
        ("ilum", "a.jpg", "images/ilum/a.jpg"),
        ("ilum", "sub/b.x.PNG", "images/ilum/sub/b.x.PNG"),
    ]
    path = f"{tmp_path}/images/ilum/sub"
    assert objects.read_binary(spark, path, None).first().content == b"\xe7"
    assert objects.read_binary(spark, path, "windows-1252").first().content == "ç"
    plan = objects.list_objects(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    for place in range(150):
        (tmp_path / f"images/{place}").mkdir(parents=True)
        (tmp_path / f"images/{place}/a.jpg").write_bytes(b"x")
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        listing = objects.list_objects(spark, str(tmp_path))
        tracker = spark.sparkContext.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
        assert stages and max(tracker.getStageInfo(stage).numTasks for stage in stages) <= 64
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert listing.count() == 150


def test_a_table_by_ranges_is_written_by_many_tasks(spark):
    table = Tables(spark, "/root/testdata/sf0.01").ranged("supplier", "s_nationkey", "s_suppkey")
    parts = table.groupBy(F.spark_partition_id().alias("part")).agg(F.countDistinct("s_nationkey").alias("n")).collect()
    assert len(parts) >= spark.sparkContext.defaultParallelism
    assert sum(part.n for part in parts) < 25 + len(parts)


def test_a_spread_table_has_no_heavy_task(spark):
    # one row group, cut into many tasks of which one gets all rows
    known = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        tables_of = Tables(spark, "/root/testdata/sf0.01")
        cores = spark.sparkContext.defaultParallelism
        assert tables_of.orders.rdd.getNumPartitions() >= cores
        spread = tables_of.spread("orders")
        load = [row["count"] for row in spread.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", known)
    assert sum(load) == 15000
    assert max(load) * cores <= 1.25 * sum(load)


def test_latest_table(spark):
    data = [
        ("s/ilum/a.csv", 2, 1), ("s/ilum/b.csv", 3, 1), ("s/ilum/c.csv", 3, 1),
        ("s/irsp/x.parquet/part-0.parquet", 1, 1), ("s/irsp/x.parquet/part-1.parquet", 9, 1),
        ("s/irsp/y.parquet/part-0.parquet", 5, 1), ("s/irsp/readme.txt", 99, 1),
    ]
    listing = spark.createDataFrame(data, "path string, modificationTime int, length int")
    latest = gold.latest_tables(listing).select("form", "table")
    assert rows(latest) == [("ilum", "s/ilum/b.csv"), ("irsp", "s/irsp/x.parquet")]


def test_parse_json(spark):
    df = spark.createDataFrame([("{",), ('{"a":1}',)], "x string")
    assert df.filter(parse_json("x").isNotNull()).count() == 1
