"""Flattening, alignment and profiling of JSON records."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from formtide.operators import records, reshape
from formtide.sources.submissions import unpack_pages

# One nested document per event; valid in both dialects.
EVENT_DOC = (
    """concat('{"u":{"id":', user_id, ',"tags":["', event_type, '",null]},"p":', props, ',"e":{},"l":[]}')"""
)
# One document per page that holds its address in an object, in a list and in an object in a list.
PAGE_DOC = (
    """concat('{"a":{"u":"', url, '"},"l":["', url, '",{"w":"', url, '"}],"n":', page_id, '}')"""
)


def event_documents(t):
    return t.spread("events").selectExpr("event_id AS id", f"{EVENT_DOC} AS doc")


def page_documents(t):
    return t.spread("pages").selectExpr("page_id AS id", f"{PAGE_DOC} AS doc")


EVENT_LEAVES = f"""
    SELECT e.event_id AS id, replace(replace(replace(substr(j.fullkey, 3), '[', '_'), ']', ''), '.', '_') AS path,
           j.atom->>'$' AS value
    FROM (SELECT event_id, {EVENT_DOC} AS doc FROM events) e, json_tree(e.doc) j
    WHERE j.type NOT IN ('OBJECT', 'ARRAY')
"""


@query(EVENT_LEAVES)
def flatten_json(t):
    return records.flatten_json(event_documents(t), "doc").select("id", "path", "value")


@query(EVENT_LEAVES.replace("), '[', '_'), ']', ''), '.', '_')", "), '[', '.'), ']', ''), '.', '.')"))
def flatten_known_depth(t):
    leaves = records.flatten_json(event_documents(t), "doc", sep=".", depth=3)
    return leaves.select("id", "path", "value")


@query(
    """
    SELECT conv_id, i AS item, p AS path, CASE p WHEN 'r' THEN role ELSE turn::VARCHAR END AS value
    FROM conversations, (VALUES (0, 'r'), (1, 'm.t'), (1, 'm.0')) v(i, p)
    """
)
def flatten_list_of_records(t):
    doc = F.expr("""concat('[{"r":"', role, '"},{"m":{"t":', turn, ',"0":', turn, '}}]')""")
    turns = t.spread("conversations").select("conv_id", doc.alias("doc"))
    return records.flatten_records(turns, "doc").select("conv_id", "item", "path", "value")


@query(f"SELECT DISTINCT path FROM ({EVENT_LEAVES})")
def distinct_paths(t):
    return records.distinct_paths(records.flatten_json(event_documents(t), "doc"))


@query(
    f"""
    SELECT event_id AS id, props->>'$.k' AS p_k, cast(user_id AS VARCHAR) AS u_id, event_type AS u_tags_0,
           cast(NULL AS VARCHAR) AS u_tags_1
    FROM events
    """
)
def pivot_wide(t):
    leaves = records.flatten_json(event_documents(t), "doc", depth=3)
    return reshape.pivot_wide(leaves, ["id"], ["p_k", "u_id", "u_tags_0", "u_tags_1"])


@query(
    """
    SELECT event_id AS id, event_type AS a_b, cast(user_id AS VARCHAR) AS c FROM events
    """
)
def gather_fields(t):
    # the path a_b occurs twice: the value nearest the root wins
    doc = F.expr("""concat('{"a":{"b":', event_id, '},"a_b":"', event_type, '","c":', user_id, '}')""")
    documents = t.spread("events").select(F.col("event_id").alias("id"), doc.alias("doc"))
    fields = reshape.gather_fields(records.flatten_json(documents, "doc", depth=2), ["id"])
    return reshape.fields_to_columns(fields, "fields", ["a_b", "c"])


@query("SELECT event_id AS id, 'a_b' AS path, 2::BIGINT AS collisions FROM events")
def path_collisions(t):
    doc = F.expr("""concat('{"a":{"b":', event_id, '},"a_b":"', event_type, '","c":', user_id, '}')""")
    documents = t.spread("events").select(F.col("event_id").alias("id"), doc.alias("doc"))
    return reshape.path_collisions(records.flatten_json(documents, "doc", depth=2), ["id"])


@query(
    f"""
    SELECT page_id AS id, 'a_u' AS path, url AS value FROM pages
    UNION ALL SELECT page_id, 'l', json_extract({PAGE_DOC}, '$.l')::VARCHAR FROM pages
    UNION ALL SELECT page_id, 'n', page_id::VARCHAR FROM pages
    """
)
def normalize_json(t):
    return records.normalize_json(page_documents(t), "doc").select("id", "path", "value")


@query(
    f"""
    SELECT p.page_id AS id, j.atom->>'$' AS reference
    FROM (SELECT page_id, {PAGE_DOC} AS doc FROM pages) p, json_tree(p.doc) j
    WHERE j.type = 'VARCHAR' AND json_type(p.doc, j.path) = 'OBJECT'
        AND starts_with(j.atom->>'$', 'https://')
    """
)
def find_by_prefix(t):
    found = records.find_by_prefix(page_documents(t), "doc", "https://")
    return found.select("id", F.col("value").alias("reference"))


@query("SELECT event_id FROM events WHERE event_type NOT IN ('error', 'click', 'signup')")
def parse_or_skip(t):
    doc = F.expr(
        "CASE event_type WHEN 'error' THEN substr(props, 1, 4) WHEN 'click' THEN '{}' "
        "WHEN 'signup' THEN '17' ELSE props END"
    )
    rows = t.spread("events").select("event_id", doc.alias("doc"))
    return records.parse_or_skip(rows, "doc").select("event_id")


@query(
    """
    SELECT event_id AS id, CASE WHEN event_type <> 'error' THEN cast(user_id AS VARCHAR) END AS a,
           CASE WHEN event_type = 'error' THEN event_type END AS b,
           CASE WHEN event_type = 'error' THEN '[1,{"x":2}]' END AS c
    FROM events
    """
)
def align_json(t):
    doc = F.expr(
        """if(event_type = 'error', concat('{"c":[1,{"x":2}],"b":"', event_type, '"}'), concat('{"a":', user_id, '}'))"""
    )
    rows = t.spread("events").select(F.col("event_id").alias("id"), doc.alias("doc"))
    return records.align_json_records(rows, "doc")


@query(
    """
    SELECT c_acctbal AS balance, c_custkey AS key, c_name AS name, cast(NULL AS VARCHAR) AS type FROM customer
    UNION ALL SELECT NULL, p_partkey, p_name, p_type FROM part
    """
)
def align_frames(t):
    customer = t.customer.selectExpr("c_custkey key", "c_name name", "c_acctbal balance")
    part = t.part.selectExpr("p_type type", "p_partkey key", "p_name name")
    return records.align_frames([customer, part])


@query(
    """
    SELECT * FROM (VALUES ('event', 'str'), ('user', 'int,str'), ('value', 'float'), ('ok', 'bool'),
        ('nested', 'dict,list'), ('nothing', NULL)) v(path, types)
    """
)
def type_sets(t):
    doc = F.expr(
        """concat('{"event":"', event_type, '","user":', if(event_type = 'error', '"x"', cast(user_id AS string)),
        ',"value":', value, ',"ok":', event_type = 'view', ',"nothing":null,"nested":',
        if(event_type = 'view', '{"a":1}', '[1]'), '}')"""
    )
    sets = records_types(t.spread("events").select(doc.alias("doc")))
    return sets.select("path", F.array_join("types", ",").alias("types"))


def records_types(documents):
    from formtide.operators.profile import type_sets as sets

    return sets(documents, "doc")


@query(
    """
    SELECT p_partkey, '{"p_name":"' || p_name || '","p_size":' || p_size || ',"nothing":null}' AS doc FROM part
    """
)
def row_to_json(t):
    rows = t.part.select("p_partkey", "p_name", "p_size", F.lit(None).cast("string").alias("nothing"))
    return rows.select("p_partkey", records.row_to_json(rows, ["p_name", "p_size", "nothing"]).alias("doc"))


@query(
    """
    SELECT c.conv_id AS form, c.turn AS page, c.role, c.text FROM conversations c
    LEFT JOIN (SELECT conv_id, min(turn) AS cutoff FROM conversations
               WHERE length(text) < 60 GROUP BY conv_id) e ON c.conv_id = e.conv_id
    WHERE cutoff IS NULL OR c.turn < cutoff
    """
)
def unpack_pages_of_turns(t):
    # a turn is a page with one element; a short turn is an empty page
    element = F.when(F.length("text") >= 60, F.struct("role", "text"))
    elements = F.filter(F.array(element), lambda e: e.isNotNull())
    body = F.to_json(F.struct(elements.alias("elements")))
    pages = t.spread("conversations").select(
        F.col("conv_id").alias("form"), F.col("turn").alias("page"), body.alias("body")
    )
    element = unpack_pages(pages).select(
        "form",
        "page",
        F.try_variant_get("element", "$.role", "string").alias("role"),
        F.try_variant_get("element", "$.text", "string").alias("text"),
    )
    return element
