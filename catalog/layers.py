"""Forms, layers and jobs on submissions derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import submissions as subs
from catalog.registry import query
from formtide.functions.fixed_values import LINK_FORM, LINK_URL, MAIL_PDF
from formtide.operators import profile
from formtide.operators.records import normalized_keys, parse_json
from formtide.plans import bronze, gold, landing, media_links, photo_worklist, report, silver
from formtide.plans.form_specs import FORM_SPECS
from formtide.sources.objects import media_objects

KNOWN_DEPTH = 4


def bronze_of(t, form: str):
    """Bronze table of a form: raw submissions flattened, repaired, as columns."""
    fields = landing.landing_fields(subs.submissions(t, form), depth=KNOWN_DEPTH, repair=False)
    keys = [source for source, _, _ in FORM_SPECS[form].columns if source in subs.PATH_OF]
    moment = F.lit(subs.PROCESSED_AT).cast("timestamp")
    return bronze.bronze_table(fields.select("fields"), list(dict.fromkeys(keys)), moment)


def silver_of(t, form: str):
    return silver.route_table(bronze_of(t, form), f"{form}.csv")


def gold_of(t, form: str):
    """Gold table of a form from a clean bronze table that is computed, not flattened."""
    sources = [source for source, _, _ in FORM_SPECS[form].columns if source in subs.PATH_OF]
    cells = [
        F.expr(subs.value_sql(subs.PATH_OF[source])).cast("string").alias(source)
        for source in dict.fromkeys(sources)
    ]
    table = subs.orders_of_customers(t).select(*cells)
    return gold.gold_table(silver.silver_table(table, FORM_SPECS[form], repair=False))


def register_form(form: str) -> None:
    @query(subs.silver_sql(form), name=f"silver_{form}")
    def silver_form(t):
        return subs.without_zone(silver_of(t, form))


for _form in FORM_SPECS:
    register_form(_form)


LANDING_DOC = ["id", "info.date", "info.userId", "data.observacao", "data.peso_saida", "data.foto3"]


@query(
    f"""
    WITH pages AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
    cut AS (SELECT o_orderpriority AS form, min(o_orderkey) AS cutoff FROM pages
            WHERE c_acctbal < -990 GROUP BY o_orderpriority)
    SELECT o_orderpriority AS form, concat('S', o_orderkey) AS id, ({subs.REGISTERED})::VARCHAR AS info_date,
           concat('Não possível ', o_orderpriority) AS data_observacao,
           {subs.VALUES["data.foto3"]} AS data_foto3, 6::INTEGER AS n_fields
    FROM pages LEFT JOIN cut ON o_orderpriority = form
    WHERE (cutoff IS NULL OR o_orderkey < cutoff) AND {subs.REGISTERED} >= 1672531200000
    """
)
def landing_records(t):
    empty = F.col("c_acctbal") < -990
    doc = subs.document(LANDING_DOC)
    pages = subs.orders_of_customers(t).select(
        F.col("o_orderpriority").alias("form"),
        F.col("o_orderkey").alias("page"),
        F.concat(
            F.lit('{"elements":['), F.when(empty, "").otherwise(doc), F.lit("]}")
        ).alias("body"),
    )
    fields = landing.landing_records(pages, depth=KNOWN_DEPTH)
    names = ["id", "info_date", "data_observacao", "data_foto3"]
    return fields.select(
        "form",
        *[F.col("fields").getItem(name).alias(name) for name in names],
        F.size("fields").alias("n_fields"),
    )


@query(
    f"""
    SELECT concat('S', o_orderkey) AS id, ({subs.REGISTERED})::VARCHAR AS info_date,
           concat('userId ', o_orderpriority) AS "info_userId",
           concat('Não possível ', o_orderpriority) AS data_observacao,
           cast(o_totalprice / 2 AS VARCHAR) AS data_peso_saida,
           {subs.VALUES["data.foto3"]} AS data_foto3, '{subs.PROCESSED_AT}' AS _processing_timestamp
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def bronze_table(t):
    # nested documents from elsewhere; the union of keys is discovered
    docs = subs.orders_of_customers(t).select(parse_json(subs.document(LANDING_DOC)).alias("record"))
    fields = bronze.bronze_fields(docs, flat=False, depth=KNOWN_DEPTH)
    keys = normalized_keys(docs, "record", depth=KNOWN_DEPTH)
    return bronze.bronze_table(fields, keys, F.lit(subs.PROCESSED_AT).cast("timestamp"))


@query(
    """
    SELECT concat('S', o_orderkey) AS id, cast(o_totalprice / 2 AS VARCHAR) AS weight, 'amb' AS form
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def bronze_flat_records(t):
    doc = F.expr("to_json(struct(concat('S', o_orderkey) AS id, o_totalprice / 2 AS weight))")
    records = subs.orders_of_customers(t).select(parse_json(doc).alias("record"))
    table = bronze.bronze_table(bronze.bronze_fields(records), ["id", "weight"])
    return table.drop("_processing_timestamp").withColumn("form", F.lit("amb"))


@query("SELECT o_orderkey AS id, concat('P', o_custkey) AS pdf_file_id, o_orderdate FROM orders")
def gold_table(t):
    table = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("P"), "o_custkey").alias(MAIL_PDF),
        "o_orderdate",
    )
    return gold.gold_table(table)


@query(
    f"""
    SELECT count(*) AS quantidade_registros, epoch_ms(min({subs.REGISTERED})) AS periodo_inicio,
           epoch_ms(max({subs.REGISTERED})) AS periodo_fim
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def silver_metadata(t):
    row = profile.dataset_metadata(silver_of(t, "ilup"), "data_registro")
    return subs.without_zone(row.drop("colunas_disponiveis"))


BUCKET = "public"
LINEITEM_FORM = "CASE WHEN l_returnflag = 'A' THEN 'ilum' ELSE 'irsf' END"


def media_listing(t, kind: str, extension: str):
    """One listed object per line item, named after order and line."""
    path = F.expr(
        f"concat('s3a://{BUCKET}/media/{kind}/', {LINEITEM_FORM}, '/', l_orderkey, '-', l_linenumber, '.{extension}')"
    )
    return media_objects(t.spread("lineitem").select(path.alias("path")), kind)


def link_sql(kind: str, extension: str, id_name: str, references: str) -> str:
    return f"""
        WITH refs AS ({references}),
        links AS (
            SELECT {LINEITEM_FORM} AS form, concat(l_orderkey, '-', l_linenumber) AS file_id,
                   concat('https://{BUCKET}.s3.amazonaws.com/media/{kind}/', {LINEITEM_FORM}, '/',
                          l_orderkey, '-', l_linenumber, '.{extension}') AS url
            FROM lineitem
        )
        SELECT submission_id, file_id AS {id_name}, url AS {LINK_URL}, form AS {LINK_FORM}
        FROM refs JOIN links USING (form, file_id)
    """


@query(
    link_sql(
        "images",
        "jpg",
        "id_image",
        """
        SELECT form, concat('S', o_orderkey) AS submission_id, concat(o_orderkey, '-', n) AS file_id
        FROM orders, (VALUES ('ilum'), ('irsf')) f(form), (VALUES (1), (2), (3)) p(n)
        WHERE n < 3 OR o_orderstatus <> 'F'
        """,
    )
)
def media_links_images(t):
    tables = {form: gold_of(t, form) for form in ("ilum", "irsf")}
    references = media_links.media_references(tables, "images")
    links = media_links.object_links(media_listing(t, "images", "jpg"), BUCKET, "media")
    return media_links.media_links(references, links, "images")


@query(
    link_sql(
        "videos",
        "mp4",
        "id_video",
        """
        SELECT 'ilum' AS form, o_orderkey::VARCHAR AS submission_id, concat(o_orderkey, '-4') AS file_id
        FROM orders WHERE o_orderstatus <> 'P'
        """,
    )
)
def media_links_videos(t):
    video = F.expr(
        "CASE o_orderstatus WHEN 'P' THEN concat('file://', o_orderkey, '-4') "
        "ELSE concat('gridfs://registrationFiles/', o_orderkey, '-4') END"
    )
    tables = {
        "ilum": t.orders.select(F.col("o_orderkey").alias("id"), video.alias("Video_1"), "o_orderstatus"),
        "irsf": t.orders.select("o_orderkey", "o_orderstatus"),
    }
    references = media_links.media_references(tables, "videos")
    links = media_links.object_links(media_listing(t, "videos", "mp4"), BUCKET, "media")
    return media_links.media_links(references, links, "videos")


@query(
    link_sql(
        "pdfs",
        "pdf",
        "id_pdf",
        """
        SELECT 'irsf' AS form, o_custkey::VARCHAR AS submission_id, concat(o_orderkey, '-1') AS file_id
        FROM orders
        """,
    )
)
def media_links_pdfs(t):
    pdf = F.concat(F.col("o_orderkey"), F.lit("-1"))
    table = t.orders.select(
        "o_orderstatus", F.col("o_custkey").alias("moreapp_submission_id"), pdf.alias(MAIL_PDF)
    )
    references = media_links.media_references({"irsf": gold.gold_table(table)}, "pdfs")
    links = media_links.object_links(media_listing(t, "pdfs", "pdf"), BUCKET, "media")
    return media_links.media_links(references, links, "pdfs")


def photo_records(t):
    """A record per line item that refers to its part's photo, and lists one that does not count."""
    doc = F.expr(
        """concat('{"data":{"foto":"gridfs://registrationFiles/', l_partkey, '\\\\\\\\","n":1},"l":["gridfs://registrationFiles/x"]}')"""
    )
    return t.spread("lineitem").select(F.col("l_returnflag").alias("form"), doc.alias("record"))


def worklist(t):
    paths = t.part.filter("p_size > 25").select(
        F.concat(F.lit("s3a://gold/fotos/A/"), "p_partkey", F.lit(".jpg")).alias("path")
    )
    references = photo_worklist.photo_references(photo_records(t), depth=3)
    return photo_worklist.photo_worklist(references, photo_worklist.stored_photos(paths))


WORKLIST = """
    SELECT l_returnflag AS form, l_partkey::VARCHAR AS file_id,
           concat('gridfs://registrationFiles/', l_partkey, chr(92)) AS gridfs_url,
           count(*) AS "references",
           CASE WHEN l_returnflag = 'A' AND any_value(p_size) > 25 THEN 'present' ELSE 'missing' END AS status
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_returnflag, l_partkey
"""


@query(WORKLIST)
def photo_worklist_of_lines(t):
    return worklist(t)


@query(
    f"""
    SELECT form, count_if(status = 'missing')::BIGINT AS to_fetch,
           (sum("references") - count_if(status = 'missing'))::BIGINT AS skipped
    FROM ({WORKLIST}) GROUP BY ROLLUP (form)
    """
)
def photo_counts(t):
    return photo_worklist.photo_counts(worklist(t), total=True)


@query(
    f"""
    SELECT 'Acao' AS source, form AS form_name, gridfs_url AS original_gridfs_url, file_id,
           '2024-05-06T07:08:09.000000' AS processing_date
    FROM ({WORKLIST}) WHERE status = 'missing'
    """
)
def photo_metadata(t):
    moment = F.lit(subs.PROCESSED_AT).cast("timestamp")
    return photo_worklist.photo_metadata(worklist(t), "Ação", moment)


@query(
    """
    SELECT event_type AS form, 'done' AS status, count(*) AS rows FROM events
    WHERE event_type <> 'error' GROUP BY event_type
    UNION ALL SELECT 'error', 'failed', NULL UNION ALL SELECT 'none', 'skipped', 0
    """
)
def run_report(t):
    def job(form: str) -> int:
        if form == "error":
            raise silver.MissingColumns("info_date")
        rows = t.events.filter(F.col("event_type") == form).count()
        if not rows:
            raise report.Skipped("no rows")
        return rows

    forms = ["view", "click", "signup", "purchase", "error", "none"]
    return report.run_each(t.spark, forms, job).select("form", "status", "rows")
