"""Form specifications and the chain of jobs on a few submissions per form."""

from __future__ import annotations

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from formtide.functions.fixed_values import FORMS, MEDIA_KINDS
from formtide.functions.paths import layer_path
from formtide.operators.records import parse_json
from formtide.plans import bronze, gold, landing, media_links, photo_worklist, silver
from formtide.plans.form_specs import FORM_SPECS
from formtide.streaming.incremental import append_bronze

DAY = 1693526400000  # 2023-09-01


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def submission(n, date=DAY, **data):
    return {
        "id": f"s{n}",
        "info": {"date": date, "userId": "u", "customerId": 7},
        "meta": {"serialNumber": n, "registrationDate": DAY, "location": {"latitude": -23.5, "longitude": None},
                 "device": {"name": "tablet"}},
        "data": {"observacao": "N√£o poss√≠vel", "foto": f"gridfs://registrationFiles/p{n}", **data},
        "mailStatuses": [{"pdfFileId": f"pdf{n}"}],
    }


FORM_DATA = {
    "ilum": {"servioExecutado": "Sim", "buscar": {"EXTENSAOKM": "1.5", "SETOR": "ação"}},
    "irsf": {"buscar_veiculo": {"PLACA": " abc1d23 "}, "nome_motorista": " joão d'água ", "coletor": "NA"},
    "irsrsd": {"dataEHoraDaVistoria": "2024-05-06T07:08:09", "rota": {"id": "12"}},
    "ilup": {"servico_executado": "sim"},
    "amb": {"peso_entrada": " 12 ", "peso_saida": "1d", "peso_total": "7,5"},
    "irss": {"peso_total": 7.5},
    "irsp": {"rotaDeColeta": "R1", "coletor": "x|y\n\"z\""},
    "irsv": {"coletor": "ok", "nome_motorista": "ana"},
}


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("layers"))
    pages = []
    for form in FORMS:
        kept = [submission(1, **FORM_DATA[form]), submission(2, **FORM_DATA[form])]
        dropped = [submission(3, date=1600000000000), submission(4, date="x"), "text", {"id": 5}]
        pages += [(form, 0, json.dumps({"elements": kept[:1] + dropped})), (form, 1, json.dumps({"elements": kept[1:]})),
                  (form, 2, '{"elements":[]}'), (form, 3, json.dumps({"elements": [submission(9)]}))]
    df = spark.createDataFrame(pages, "form string, page int, body string")
    reports = {
        "landing": landing.run_landing(spark, df, f"{base}/landing", [*FORMS, "none"]),
        "bronze": bronze.run_bronze(spark, f"{base}/landing", f"{base}/bronze", FORMS, export=True),
        "silver": silver.run_silver(spark, f"{base}/bronze", f"{base}/silver", [*FORMS, "outro"], export=True),
        "gold": gold.run_gold(spark, f"{base}/silver", f"{base}/gold"),
    }
    return base, reports


def report(layers, name):
    return {r.form: (r.status, r.rows) for r in layers[1][name].collect()}


def test_every_form_passes_every_layer(layers):
    done = {form: ("done", 2) for form in FORMS}
    assert report(layers, "landing") == done | {"none": ("skipped", 0)}
    assert report(layers, "bronze") == done
    assert report(layers, "silver") == done | {"outro": ("skipped", 0)}
    assert report(layers, "gold") == done


def gold_rows(spark, layers, form):
    return spark.read.parquet(layer_path(f"{layers[0]}/gold", form, "parquet"))


def test_gold_schema_is_the_form_specification(spark, layers):
    kinds = {"number": "double", "epoch_ms": "timestamp", "timestamp": "timestamp",
             "epoch_or_text": "timestamp", "yes_no": "boolean"}
    for form in FORMS:
        table = gold_rows(spark, layers, form)
        bronze_columns = spark.read.parquet(layer_path(f"{layers[0]}/bronze", form, "parquet")).columns
        expected = [(t, kinds.get(c, "string")) for s, t, c in FORM_SPECS[form].columns if s in bronze_columns]
        assert table.dtypes == expected


def test_golden_cells(spark, layers):
    def first(form, *names):
        table = gold_rows(spark, layers, form)
        return tuple(table.orderBy(table.columns[0]).select(*[f"`{n}`" for n in names]).first())

    day = datetime.datetime(2023, 9, 1)
    assert first("ilum", "id_varricao", "data_varricao", "servico_executado", "extensao_km", "setor", "observacao") == (
        "s1", day, True, 1.5, "ação", "Não possível",
    )
    assert first("irsf", "placa_veiculo", "motorista", "coletor", "data_registro", "longitude") == (
        "ABC1D23", "João D'Água", None, day, None,
    )
    assert first("irsrsd", "data_hora", "id_rota", "id_inspetor") == (datetime.datetime(2024, 5, 6, 7, 8, 9), 12.0, 7.0)
    assert first("amb", "peso_entrada_kg", "peso_saida_kg", "peso_residuos_kg") == (12.0, None, None)
    assert first("irss", "peso_residuos_kg", "latitude", "SN") == (7.5, -23.5, "1")
    assert first("irsp", "rota de coleta", "coletor") == ("R1", 'x|y\n"z"')
    assert first("irsv", "conformidade", "Motorista", "data_pesagem") == ("ok", "ana", day)
    assert first("ilup", "equipado_epi", "data_registro_dispositivo") == ("sim", day)
    assert gold_rows(spark, layers, "ilup").filter("data_processamento IS NOT NULL").count() == 2


def test_media_links(spark, layers):
    base = layers[0]
    for form, name in [("ilum", "p1.jpg"), ("ilum", "p1.png"), ("ilum", "none.jpg"), ("irsf", "p2.jpg"), ("x", "p1.jpg")]:
        os.makedirs(f"{base}/media/images/{form}", exist_ok=True)
        with open(f"{base}/media/images/{form}/{name}", "w") as file:
            file.write("x")
    done = media_links.run_media_links(spark, f"{base}/gold", f"{base}/media", "bucket", "proj/media")
    assert {r.form: (r.status, r.rows) for r in done.collect()} == {
        "images": ("done", 3), "videos": ("skipped", 0), "pdfs": ("skipped", 0),
    }
    links = spark.read.parquet(layer_path(f"{base}/gold", "images", "parquet"))
    url = "https://bucket.s3.amazonaws.com/proj/media/images"
    assert links.columns == ["submission_id", "id_image", "url_presigned", "formulario_moreapp"]
    assert rows(links) == [
        ("s1", "p1", f"{url}/ilum/p1.jpg", "ilum"),
        ("s1", "p1", f"{url}/ilum/p1.png", "ilum"),
        ("s2", "p2", f"{url}/irsf/p2.jpg", "irsf"),
    ]


def test_pdf_references_use_the_named_id(spark):
    table = spark.sql("SELECT 'f' AS x, 'm1' AS moreapp_submission_id, 'q' AS mailStatuses_0_pdfFileId")
    found = media_links.media_references({"ilum": gold.gold_table(table), "irsf": table.select("x")}, "pdfs")
    assert rows(found) == [("ilum", "m1", "q")]
    assert media_links.media_references({"irsf": table.select("x")}, "pdfs") is None
    assert set(MEDIA_KINDS) == {"images", "videos", "pdfs"}


def test_missing_required_column(spark, tmp_path):
    table = spark.sql("SELECT 'a' AS id, '1693526400000' AS info_date")
    with pytest.raises(silver.MissingColumns, match="meta_registrationDate"):
        silver.silver_table(table, FORM_SPECS["amb"])
    table.write.parquet(layer_path(f"{tmp_path}/b", "amb", "parquet"))
    table.withColumn("meta_registrationDate", F.lit("x")).write.parquet(layer_path(f"{tmp_path}/b", "irss", "parquet"))
    done = silver.run_silver(spark, f"{tmp_path}/b", f"{tmp_path}/s", ["amb", "irss", "irsv"])
    assert {r.form: r.status for r in done.collect()} == {"amb": "failed", "irss": "done", "irsv": "skipped"}


def test_specifications_are_complete():
    assert {form: len(spec.columns) for form, spec in FORM_SPECS.items()} == {
        "ilup": 22, "irsf": 23, "irsrsd": 27, "amb": 15, "irss": 15, "irsp": 26, "ilum": 27, "irsv": 24,
    }
    for spec in FORM_SPECS.values():
        targets = [target for _, target, _ in spec.columns]
        assert len(set(targets)) == len(targets) and set(spec.required) <= set(targets)


def test_silver_reads_no_other_columns_and_does_not_shuffle(spark, tmp_path):
    names = [source for source, _, _ in FORM_SPECS["ilum"].columns] + ["unlisted_column"]
    spark.range(1).select(*[F.lit("1").alias(n) for n in names]).write.parquet(f"{tmp_path}/t")
    plan = silver.silver_table(spark.read.parquet(f"{tmp_path}/t"), FORM_SPECS["ilum"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text and "unlisted_column" not in text
    one = silver.silver_table(spark.read.parquet(f"{tmp_path}/t"), FORM_SPECS["ilum"], columns=["observacao"])
    text = one._jdf.queryExecution().executedPlan().toString()
    assert one.columns == ["observacao"] and "ReadSchema: struct<data_observacao:string>" in text


def test_landing_does_not_shuffle(spark):
    elements = spark.createDataFrame([("a", '{"a":{"b":[1,{"c":2}]}}'), ("a", "5"), ("b", None)], "form string, element string")
    fields = landing.landing_fields(elements)
    assert rows(fields.select("form", F.to_json("fields"))) == [("a", '{"a_b_0":"1","a_b_1_c":"2"}')]
    assert "Exchange" not in fields._jdf.queryExecution().executedPlan().toString()


def test_silver_composes_characters(spark):
    table = spark.sql("SELECT 'x' AS id, 'cafe\u0301 N√£o' AS data_observacao")
    table = table.withColumn("info_date", F.lit(str(DAY))).withColumn("meta_registrationDate", F.lit(str(DAY)))
    found = silver.silver_table(table, FORM_SPECS["ilum"], columns=["observacao"]).first()[0]
    assert found.startswith("café")


def test_empty_runs_keep_the_layers(spark, tmp_path):
    base = str(tmp_path)
    page = json.dumps({"elements": [submission(1, **FORM_DATA["ilum"])]})
    good = spark.createDataFrame([("ilum", 0, page)], "form string, page int, body string")
    empty = good.withColumn("body", F.lit('{"elements":[]}'))
    photos = spark.createDataFrame([("m/images/ilum/p1.jpg",)], "path string")
    none = photos.filter("path IS NULL")

    def tables():
        names = [f"{base}/landing/ilum/ilum.json", f"{base}/silver/ilum/ilum.parquet", f"{base}/gold/images/images.parquet"]
        return [spark.read.format("text" if n.endswith("json") else "parquet").load(n).collect() for n in names]

    def status(report):
        return [(r.status, r.rows) for r in report.collect()]

    assert status(landing.run_landing(spark, good, f"{base}/landing", ["ilum"])) == [("done", 1)]
    bronze.run_bronze(spark, f"{base}/landing", f"{base}/bronze", ["ilum"])
    assert status(silver.run_silver(spark, f"{base}/bronze", f"{base}/silver", ["ilum"])) == [("done", 1)]
    gold.run_gold(spark, f"{base}/silver", f"{base}/gold", ["ilum"])

    def link(listing):
        return media_links.run_media_links(spark, f"{base}/gold", "", "b", kinds=["images"], listing=listing)

    assert status(link(photos)) == [("done", 1)]
    before = tables()
    assert all(before)

    assert status(landing.run_landing(spark, empty, f"{base}/landing", ["ilum"])) == [("skipped", 0)]
    spark.read.parquet(f"{base}/bronze/ilum/ilum.parquet").limit(0).write.parquet(f"{base}/bronze2/ilum/ilum.parquet")
    assert status(silver.run_silver(spark, f"{base}/bronze2", f"{base}/silver", ["ilum"])) == [("skipped", 0)]
    assert status(link(none)) == [("skipped", 0)]
    assert tables() == before


def test_run_photo_worklist(spark, layers, tmp_path):
    listing = spark.createDataFrame([("fotos/ilum/p1.jpg",), ("fotos/irsf/p2.jpg",)], "path string")
    done = photo_worklist.run_photo_worklist(spark, f"{layers[0]}/landing", listing, f"{tmp_path}/w", ["ilum", "zz"])
    assert {r.form: (r.status, r.rows) for r in done.collect()} == {"ilum": ("done", 2), "zz": ("failed", None)}
    work = spark.read.parquet(layer_path(f"{tmp_path}/w", "ilum", "parquet"))
    assert rows(work.select("file_id", "status")) == [("p1", "present"), ("p2", "missing")]


def test_photo_worklist(spark):
    def record(*refs):
        return json.dumps({"data": {f"foto{i}": r for i, r in enumerate(refs)}, "l": ["gridfs://x/no"]})

    data = [("a", record("gridfs://x/1\\", "gridfs://x/1\\")), ("a", record("gridfs://x/2", "file://x/3")),
            ("b", record("gridfs://x/1\\"))]
    records = spark.createDataFrame(data, "form string, record string").withColumn("record", parse_json("record"))
    references = photo_worklist.photo_references(records)
    listing = spark.createDataFrame([("g/fotos/a/2.jpg",), ("g/fotos/b/2.jpg",)], "path string")
    work = photo_worklist.photo_worklist(references, photo_worklist.stored_photos(listing))
    assert rows(work) == [
        ("a", "1", "gridfs://x/1\\", 2, "missing"), ("a", "2", "gridfs://x/2", 1, "present"),
        ("b", "1", "gridfs://x/1\\", 1, "missing"),
    ]
    assert rows(photo_worklist.photo_counts(work, total=True)) == [("a", 1, 2), ("b", 1, 0), (None, 2, 2)]
    metadata = photo_worklist.photo_metadata(work, "Ação")
    assert {(r.source, r.form_name, r.file_id) for r in metadata.collect()} == {("Acao", "a", "1"), ("Acao", "b", "1")}


def test_stream_processes_new_files_once(spark, tmp_path):
    folder = tmp_path / "landing" / "ilum" / "ilum.json"
    os.makedirs(folder)

    def run():
        query = append_bronze(spark, f"{tmp_path}/landing", f"{tmp_path}/bronze", f"{tmp_path}/checkpoint")
        query.awaitTermination()
        return rows(spark.read.parquet(f"{tmp_path}/bronze").select("form", F.col("fields")["a"]))

    (folder / "part-1.txt").write_text('{"a":"N√£o"}\nbroken\n')
    assert run() == [("ilum", "Não")]
    (folder / "part-2.txt").write_text('{"a":2}\n')
    assert run() == [("ilum", "2"), ("ilum", "Não")]
