"""Projections, filters, reshapes, joins, aggregates, order, set operations, hierarchy."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from formtide.functions.fixed_values import FOLDER_MIME
from formtide.operators import hierarchy, joins, ordering, profile, project, reshape, unions


@query("SELECT * FROM orders")
def scan_table(t):
    return t.orders


@query("SELECT event_id, value FROM events WHERE event_type = 'purchase'")
def filter_equal(t):
    return project.filter_equal(t.events, "event_type", "purchase").select("event_id", "value")


@query(
    """
    SELECT event_id FROM events
    WHERE event_type <> 'error' AND 1703980800000 + event_id * 10000 >= 1704067200000
    """
)
def date_floor(t):
    dated = t.events.withColumn(
        "ms", F.expr("if(event_type = 'error', 'bad', cast(1703980800000 + event_id * 10000 AS string))")
    )
    return project.on_or_after(dated, "ms", "2024-01-01 00:00:00").select("event_id")


@query("SELECT c_custkey AS id, c_name AS nome, c_mktsegment AS setor FROM customer")
def select_existing(t):
    mapping = [("c_custkey", "id"), ("absent", "x"), ("c_name", "nome"), ("c_mktsegment", "setor")]
    return project.select_existing_as(t.customer, mapping)


@query("SELECT s_suppkey AS info_key, s_name AS info_name, s_acctbal AS bal FROM supplier")
def normalize_names(t):
    dotted = t.supplier.select(
        F.col("s_suppkey").alias("info.key"), F.col("s_name").alias("info.name"), "s_acctbal"
    )
    return project.rename_optional(project.normalize_names(dotted), {"s_acctbal": "bal", "no": "x"})


@query("SELECT p_partkey, p_retailprice, p_name FROM part")
def drop_matching(t):
    narrow = t.part.select("p_partkey", "p_name", F.upper("p_name").alias("p_name_2"), "p_retailprice")
    return project.drop_matching_keep_one(narrow, "name", "p_name")


@query("SELECT p_partkey, cast(p_size AS VARCHAR) AS size, 'ilum' AS formulario FROM part")
def lineage(t):
    key = project.id_column(t.part.columns)
    tagged = project.with_form(t.part, "ilum", "formulario")
    return tagged.select(key, F.col("p_size").cast("string").alias("size"), "formulario")


@query(
    """
    SELECT n_nationkey AS id, 'n_foto_name' AS source_column, n_name AS value FROM nation
    UNION ALL SELECT c_custkey, 'c_Foto', c_name FROM customer
    UNION ALL SELECT c_custkey, 'c_photo_key', cast(c_nationkey AS VARCHAR) FROM customer
        WHERE c_acctbal >= 0
    """
)
def melt(t):
    nation = t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("n_foto_name"))
    customer = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("c_Foto"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("c_photo_key"),
        "c_mktsegment",
    )
    parts = [
        reshape.melt(df, ["id"], project.media_columns(df.columns, "images"))
        for df in (nation, customer)
    ]
    return project.drop_missing(unions.concat_by_name(parts), ["value"])


@query("SELECT o_orderkey, cast(o_custkey AS VARCHAR) AS codigo_pdf FROM orders")
def single_media(t):
    df = t.orders.select("o_orderkey", F.col("o_custkey").alias("pdf_file_id"))
    return reshape.single_media(df, "o_orderkey", project.media_columns(df.columns, "pdfs"), "codigo_pdf")


@query("SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def link_join(t):
    links = t.customer.select(F.col("c_custkey").alias("file_id"), "c_name")
    media = t.orders.withColumnRenamed("o_custkey", "file_id")
    return joins.link_media(media, links, ["file_id"]).select("o_orderkey", "o_totalprice", "c_name")


@query(
    """
    SELECT DISTINCT l_partkey FROM lineitem
    ANTI JOIN (SELECT p_partkey FROM part WHERE p_size > 10) p ON l_partkey = p_partkey
    """
)
def missing_references(t):
    stored = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    return joins.missing_references(t.lineitem.select("l_partkey"), stored, ["l_partkey"])


@query(
    """
    SELECT c_custkey FROM customer
    SEMI JOIN (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01') o
        ON c_custkey = o_custkey
    """
)
def present_references(t):
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz"))
    existing = recent.select(F.col("o_custkey").alias("c_custkey"))
    return joins.present_references(t.customer.select("c_custkey"), existing, ["c_custkey"])


@query(
    """
    SELECT count(*) AS quantidade_registros, min(ts) AS periodo_inicio, max(ts) AS periodo_fim,
           'event_id,ts,user_id,event_type,value,props' AS colunas_disponiveis
    FROM events
    """
)
def dataset_metadata(t):
    row = profile.dataset_metadata(t.events, "ts")
    return row.withColumn("colunas_disponiveis", F.array_join("colunas_disponiveis", ","))


@query("SELECT count(*) AS rows FROM lineitem")
def row_count(t):
    return profile.row_count(t.lineitem)


OUTCOMES = {"purchase": "processed", "view": "skipped", "error": "errors"}


@query(
    """
    SELECT user_id, count_if(event_type = 'purchase')::BIGINT AS processed,
           count_if(event_type = 'view')::BIGINT AS skipped,
           count_if(event_type = 'error')::BIGINT AS errors
    FROM events GROUP BY user_id
    """
)
def outcome_counts(t):
    return profile.outcome_counts(t.events, "user_id", "event_type", OUTCOMES)


@query(
    """
    SELECT user_id, count_if(event_type = 'purchase')::BIGINT AS processed,
           count_if(event_type = 'view')::BIGINT AS skipped,
           count_if(event_type = 'error')::BIGINT AS errors
    FROM events GROUP BY ROLLUP (user_id)
    """
)
def outcome_total(t):
    return profile.outcome_counts(t.events, "user_id", "event_type", OUTCOMES, total=True)


@query(
    """
    SELECT 5::INTEGER AS column_count, 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS column_names,
           count(*) AS row_count, 'bigint,double,int,string' AS data_types
    FROM customer
    """
)
def structure_summary(t):
    row = profile.structure_summary(t.customer)
    return row.select(
        "column_count",
        F.array_join("column_names", ",").alias("column_names"),
        "row_count",
        F.array_join("data_types", ",").alias("data_types"),
    )


@query(
    """
    SELECT 'open' AS transformation_name, 'total' AS columns_added,
           'o_custkey,o_orderpriority,o_totalprice' AS columns_removed,
           ((SELECT count(*) FROM orders WHERE o_orderstatus = 'O') - (SELECT count(*) FROM orders))::BIGINT
               AS row_change,
           'decimal(15,2)' AS types_added, 'double' AS types_removed
    """
)
def transformation_diff(t):
    total = F.col("o_totalprice").cast("decimal(15,2)").alias("total")
    after = t.orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus", "o_orderdate", total)
    row = profile.transformation_diff("open", t.orders, after)
    lists = ["columns_added", "columns_removed", "types_added", "types_removed"]
    return row.withColumns({name: F.array_join(name, ",") for name in lists})


@query(
    """
    SELECT user_id, event_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events
    ) WHERE rn = 1
    """
)
def latest_per_key(t):
    return ordering.latest_per_key(t.events, ["user_id"], "ts", "event_id").select(
        "user_id", "event_id", "event_type"
    )


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100 OFFSET 300")
def page_slice(t):
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()]
    return ordering.page_slice(t.orders, order, page=3).select("o_orderkey", "o_orderdate")


@query(
    """
    SELECT l_shipdate, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC LIMIT 100
    OFFSET (SELECT count(*) // 200 * 100 FROM lineitem)
    """
)
def page_seek(t):
    # the page in the middle of the table
    half = t.lineitem.count() // 200
    keys = ["l_shipdate", "l_orderkey", "l_linenumber"]
    return ordering.seek_page(t.lineitem, keys, half, descending=True).select(*keys, "l_extendedprice")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def sort_descending(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ordering.sort_descending(rows, "l_extendedprice", "l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000")
def take_top(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return ordering.take(ordering.sort_descending(rows, "o_totalprice", "o_orderkey"), 1000)


@query("SELECT c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey FROM customer")
def sorted_columns(t):
    return ordering.sorted_columns(t.customer)


@query("SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT -1, 'NEW' UNION ALL SELECT -2, NULL")
def append_rows(t):
    return unions.append_rows(t.supplier.select("s_suppkey", "s_name"), [(-1, "NEW"), (-2, None)])


@query(
    """
    SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, cast(NULL AS DOUBLE) AS balance
    FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
    """
)
def concat_by_name(t):
    customer = t.customer.selectExpr("c_custkey key", "c_name name", "c_mktsegment segment")
    supplier = t.supplier.selectExpr("s_acctbal balance", "s_name name", "s_suppkey key")
    return unions.concat_by_name([customer, None, supplier])


# Regions, nations and customers are folders, orders are files.
HIERARCHY = f"""
    SELECT concat('r', r_regionkey) AS id, r_name AS name, '{FOLDER_MIME}' AS mime, 'top' AS parent FROM region
    UNION ALL SELECT concat('n', n_nationkey), n_name, '{FOLDER_MIME}', concat('r', n_regionkey) FROM nation
    UNION ALL SELECT concat('c', c_custkey), c_name, '{FOLDER_MIME}', concat('n', c_nationkey) FROM customer
    UNION ALL SELECT concat('o', o_orderkey), o_orderpriority, 'text/plain', concat('c', o_custkey) FROM orders
"""
FOLDER_PATHS = """
    SELECT concat('r', r_regionkey) AS folder_id, r_name AS path FROM region
    UNION ALL SELECT concat('n', n_nationkey), concat(r_name, '/', n_name)
        FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT concat('c', c_custkey), concat(r_name, '/', n_name, '/', c_name)
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'top', ''
"""


def entries(t):
    listing = t.spark.sql(
        HIERARCHY.replace("FROM region", "FROM {region}")
        .replace("FROM nation", "FROM {nation}")
        .replace("FROM customer", "FROM {customer}")
        .replace("FROM orders", "FROM {orders}"),
        region=t.region, nation=t.nation, customer=t.customer, orders=t.orders,
    )
    return listing.select(
        "id", "name", F.col("mime").alias("mimeType"), F.array("parent").alias("parents")
    )


@query(
    f"""
    SELECT id, name, CASE WHEN mime = 'text/plain' THEN 'file' ELSE 'folder' END AS type
    FROM ({HIERARCHY}) WHERE parent = 'n7'
    """
)
def hierarchy_children(t):
    return hierarchy.list_children(entries(t), "n7").select("id", "name", "type")


@query(f"SELECT folder_id, path FROM ({FOLDER_PATHS})")
def hierarchy_folders(t):
    return hierarchy.folder_paths(entries(t), "top")


@query(
    f"""
    SELECT h.id, h.name, p.path FROM ({HIERARCHY}) h JOIN ({FOLDER_PATHS}) p ON h.parent = p.folder_id
    WHERE h.mime = 'text/plain'
    """
)
def hierarchy_files(t):
    return hierarchy.list_files_deep(entries(t), "top").select("id", "name", "path")


@query(
    f"""
    SELECT p.path, h.id AS file_id, h.name AS file_name FROM ({FOLDER_PATHS}) p
    LEFT JOIN (SELECT * FROM ({HIERARCHY}) WHERE mime = 'text/plain') h ON h.parent = p.folder_id
    """
)
def hierarchy_tree(t):
    return hierarchy.list_tree(entries(t), "top").select("path", "file_id", "file_name")


@query("SELECT concat('n', n_nationkey) AS id FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' AND n_name = 'NATION_7'")
def hierarchy_resolve(t):
    return hierarchy.resolve_path(entries(t), "top", "ASIA/NATION_7")
