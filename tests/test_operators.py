"""Projections, reshapes, joins, profiles, order, set operations and hierarchy."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from formtide.functions.fixed_values import FOLDER_MIME
from formtide.operators import hierarchy, joins, ordering, profile, project, reshape, unions


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_projections(spark):
    df = spark.sql("SELECT 1 AS `a.b`, 'x' AS Foto, 2 AS mailStatuses_0_pdfFileId, 3 AS mailStatuses_1_pdfFileId")
    assert project.normalize_names(df).columns[0] == "a_b"
    picked = project.select_existing_as(df, [("Foto", "f"), ("no", "x"), ("a.b", "rota de coleta")])
    assert picked.columns == ["f", "rota de coleta"]
    assert project.media_columns(["Foto_1", "photo", "ASSINATURA", "registroDaEvidcia", "x"], "images") == [
        "Foto_1", "photo", "ASSINATURA", "registroDaEvidcia",
    ]
    renamed = project.rename_optional(df, {"mailStatuses_0_pdfFileId": "pdf_file_id", "no": "y"})
    assert "pdf_file_id" in renamed.columns
    kept = project.drop_matching_keep_one(df, "pdfFileId", "mailStatuses_0_pdfFileId")
    assert kept.columns == ["a.b", "Foto", "mailStatuses_0_pdfFileId"]
    assert project.id_column(["a", "b"]) == "a"
    assert project.id_column(["a", "moreapp_submission_id"]) == "moreapp_submission_id"


def test_date_floor(spark):
    df = spark.sql("SELECT * FROM VALUES ('1672531199999'), ('1672531200000'), ('x'), (NULL) t(ms)")
    assert rows(project.on_or_after(df, "ms")) == [("1672531200000",)]
    assert rows(project.on_or_after(df, "ms", zone="Europe/Berlin")) == [("1672531199999",), ("1672531200000",)]


def test_lineage(spark):
    moment = F.lit("2024-05-06 07:08:09").cast("timestamp")
    row = project.with_form(project.with_processing_time(spark.range(1), moment), "ilum").first()
    assert (row["_processing_timestamp"], row["formulario_moreapp"]) == ("2024-05-06 07:08:09", "ilum")


def test_melt_mixed_types(spark):
    df = spark.sql("SELECT 1 AS id, 'x' AS foto, 5 AS foto2")
    assert rows(reshape.melt(df, ["id"], ["foto", "foto2"])) == [(1, "foto", "x"), (1, "foto2", "5")]
    assert rows(reshape.single_media(df, "id", ["foto2", "foto"], "code")) == [(1, "5")]


def test_joins(spark):
    refs = spark.sql("SELECT * FROM VALUES ('a','1'),('a','1'),('a','2'),('b','1') t(form,file_id)")
    stored = spark.sql("SELECT * FROM VALUES ('a','2'),('c','1') t(form,file_id)")
    assert rows(joins.missing_references(refs, stored)) == [("a", "1"), ("b", "1")]
    assert rows(joins.present_references(refs, stored)) == [("a", "2")]
    links = spark.sql("SELECT * FROM VALUES ('a','2','u'),('a','2','v'),('b','2','w') t(form,file_id,url)")
    assert rows(joins.link_media(refs, links)) == [("a", "2", "u"), ("a", "2", "v")]


def test_bounded_side(spark):
    small = joins.bounded_side(spark.range(5))
    assert small.count() == 5
    joined = spark.range(100).join(small, "id")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    big = spark.range(50)
    assert joins.bounded_side(big, max_rows=10) is big


def test_profiles(spark):
    df = spark.sql("SELECT * FROM VALUES (1, timestamp'2024-01-02'), (2, timestamp'2024-01-01') t(id, d)")
    row = profile.dataset_metadata(df, "d").first()
    assert (row[0], row[1], row[2], row[3]) == (
        2, datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2), ["id", "d"],
    )
    assert profile.dataset_metadata(df, "none").first()[1] is None
    summary = profile.structure_summary(df).first()
    assert tuple(summary) == (2, ["id", "d"], 2, ["int", "timestamp"])
    after = df.filter("id = 1").select("id", F.lit("x").alias("new"))
    diff = profile.transformation_diff("filter", df, after).first()
    assert tuple(diff) == ("filter", ["new"], ["d"], -1, ["string"], ["timestamp"])
    frame, seen = profile.counted(df)
    frame.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 2


def test_outcomes(spark):
    df = spark.sql("SELECT * FROM VALUES ('a','ok'),('a','bad'),('b','ok') t(form,status)")
    got = profile.outcome_counts(df, "form", "status", {"ok": "n_ok", "bad": "n_bad"}, total=True)
    assert rows(got) == [("a", 1, 1), ("b", 1, 0), (None, 2, 1)]


def test_order(spark):
    df = spark.sql("SELECT * FROM VALUES ('a',1,'z'),('a',1,'y'),('a',0,'x'),('b',5,'w') t(form,t,path)")
    assert rows(ordering.latest_per_key(df, ["form"], "t", "path")) == [("a", 1, "y"), ("b", 5, "w")]
    plan = ordering.latest_per_key(df, ["form"], "t", "path")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once before the shuffle, once after it
    numbers = spark.range(250)
    page = ordering.page_slice(numbers, [F.col("id").desc()], page=2)
    assert [r.id for r in page.collect()] == list(range(49, -1, -1))
    assert ordering.take(numbers, 3).count() == 3
    assert ordering.sort_descending(numbers, "id").first().id == 249
    assert ordering.sorted_columns(df).columns == ["form", "path", "t"]


def test_unions(spark):
    df = spark.createDataFrame([("Alice", 25)], "name string, age int")
    assert rows(unions.append_rows(df, [("Bob", 30)])) == [("Alice", 25), ("Bob", 30)]
    with pytest.raises(ValueError):
        unions.append_rows(df, [])
    with pytest.raises(ValueError):
        unions.append_rows(None, [("Bob", 30)])
    assert unions.concat_by_name([None, None]) is None
    assert rows(unions.concat_by_name([df, df.select("age"), None])) == [("Alice", 25), (None, 25)]


@pytest.fixture(scope="module")
def entries(spark):
    data = [
        ("f1", "a", FOLDER_MIME, ["R"], False),
        ("f2", "b", FOLDER_MIME, ["f1"], False),
        ("f3", "empty", FOLDER_MIME, ["R"], False),
        ("f4", "b", FOLDER_MIME, ["f3"], True),
        ("d1", "twice", FOLDER_MIME, ["R"], False),
        ("d2", "twice", FOLDER_MIME, ["R"], False),
        ("x", "x.txt", "text/plain", ["R"], False),
        ("y", "y.txt", "text/plain", ["f2", "f1"], False),
        ("z", "z.txt", "text/plain", ["f2"], True),
        ("c", "cycle", FOLDER_MIME, ["f2", "c"], False),
    ]
    return spark.createDataFrame(
        data, "id string, name string, mimeType string, parents array<string>, trashed boolean"
    )


@pytest.mark.parametrize("descending", [False, True])
def test_seek_page_is_the_slice_of_the_sorted_rows(spark, descending):
    some = spark.range(0, 3000, 1, 4).selectExpr("if(id % 10 = 0, null, cast(id % 7 as double)) AS a", "id AS `b.c`", "id AS v")
    table = sorted(some.collect(), key=lambda r: (r.a is not None, r.a or 0.0, r["b.c"]), reverse=descending)
    for page in (0, 30, 149, 298, 299, 300, 1000):
        got = ordering.seek_page(some, ["a", "b.c"], page, 10, descending, fan_out=4)
        assert [r.v for r in got.collect()] == [r.v for r in table[page * 10 : page * 10 + 10]]
    deep = ordering.seek_page(some, ["a", "b.c"], 200, 10, descending, fan_out=4)
    plan = deep._jdf.queryExecution().optimizedPlan().toString()
    assert int(plan.split("GlobalLimit ")[1].split()[0]) <= 10 and "Filter" in plan
    offset = [int(line.split("Offset ")[1].split()[0]) for line in plan.splitlines() if "Offset " in line]
    assert sum(offset) <= 100  # ten pages at most are sorted and left out
    assert ordering.seek_page(some.limit(0), ["a", "b.c"], 50).count() == 0
    same = spark.range(500).selectExpr("1 AS k")
    assert ordering.seek_page(same, ["k"], 30, 10).count() == 10


def test_the_tree_walks_once(entries):
    plan = hierarchy.list_tree(entries, "R")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UnionLoop ") == 1


def test_hierarchy(entries):
    children = hierarchy.list_children(entries, "R")
    assert rows(children.select("id", "type")) == [
        ("d1", "folder"), ("d2", "folder"), ("f1", "folder"), ("f3", "folder"), ("x", "file"),
    ]
    files = hierarchy.list_files_deep(entries, "R").select("id", "path")
    assert rows(files) == [("x", ""), ("y", "a"), ("y", "a/b")]
    tree = hierarchy.list_tree(entries, "R").select("path", "file_id")
    assert rows(tree) == [
        ("", "x"), ("a", "y"), ("a/b", "y"), ("a/b/cycle", None), ("empty", None),
        ("twice", None), ("twice", None),
    ]


def test_resolve_path(entries):
    assert rows(hierarchy.resolve_path(entries, "R", "a/b")) == [("f2",)]
    assert rows(hierarchy.resolve_path(entries, "R", "twice")) == []
    assert rows(hierarchy.resolve_path(entries, "R", "a/none/b")) == []
    for bad in ("/a", "a/", ""):
        with pytest.raises(ValueError):
            hierarchy.resolve_path(entries, "R", bad)
