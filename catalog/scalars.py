"""Casts, text repair, paths and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from formtide.functions import casts, paths, text
from formtide.functions.fixed_values import MOJIBAKE_REPLACEMENTS


@query(
    """
    SELECT event_id,
           CASE event_type WHEN 'view' THEN try_cast(value AS DOUBLE) WHEN 'click' THEN NULL
                WHEN 'signup' THEN 12.0::DOUBLE WHEN 'purchase' THEN 1000.0::DOUBLE END AS n
    FROM events
    """
)
def to_number(t):
    messy = F.expr(
        "CASE event_type WHEN 'view' THEN cast(value AS string) WHEN 'click' THEN 'abc' "
        "WHEN 'signup' THEN ' 12 ' WHEN 'purchase' THEN '1e3' ELSE '1d' END"
    )
    return t.events.select("event_id", casts.to_number(messy).alias("n"))


@query(
    """
    SELECT event_id,
           CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN NULL
                ELSE epoch_ms(1693526400000 + event_id * 1000) END AS moment
    FROM events
    """
)
def epoch_ms(t):
    messy = F.expr(
        "CASE event_type WHEN 'error' THEN 'x' WHEN 'click' THEN '9223372036855000' "
        "WHEN 'view' THEN cast(1693526400000 + event_id * 1000 AS string) "
        "ELSE concat(cast(1693526400000 + event_id * 1000 AS string), '.0') END"
    )
    moment = casts.epoch_ms_to_timestamp(messy).cast("timestamp_ntz")
    return t.events.select("event_id", moment.alias("moment"))


@query(
    """
    SELECT event_id,
           CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS moment
    FROM events
    """
)
def text_to_timestamp(t):
    messy = F.expr("if(event_type = 'error', 'bad', date_format(ts, 'yyyy-MM-dd HH:mm:ss'))")
    moment = casts.text_to_timestamp(messy).cast("timestamp_ntz")
    return t.events.select("event_id", moment.alias("moment"))


@query(
    """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS answer,
           o_orderstatus = 'F' AS flag
    FROM orders
    """
)
def yes_no(t):
    word = F.expr("CASE o_orderstatus WHEN 'F' THEN 'Sim' WHEN 'O' THEN 'não' END")
    return t.orders.select(
        "o_orderkey", casts.yes_no(word).alias("answer"), casts.truthy(word).alias("flag")
    )


@query("SELECT p_partkey, cast(p_size AS VARCHAR) AS size_text, cast(p_retailprice AS VARCHAR) AS price_text FROM part")
def stringify(t):
    return t.part.select(
        "p_partkey",
        casts.stringify("p_size").alias("size_text"),
        casts.stringify("p_retailprice").alias("price_text"),
    )


@query(
    """
    SELECT event_id,
           strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '-0300' AS local_text,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+0000' AS utc_text
    FROM events
    """
)
def now_in_zone(t):
    instant = F.col("ts").cast("timestamp")
    return t.events.select(
        "event_id",
        casts.now_text("America/Sao_Paulo", instant).alias("local_text"),
        casts.now_text(None, instant).alias("utc_text"),
    )


@query(
    """
    SELECT event_id,
           abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15')) > 7::BIGINT * 86400000000 AS over_a_week,
           abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15')) > 90::BIGINT * 60000000 AS over_90_minutes
    FROM events
    """
)
def gap_exceeds(t):
    middle = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return t.events.select(
        "event_id",
        casts.gap_exceeds("ts", middle, "weeks", 1).alias("over_a_week"),
        casts.gap_exceeds(middle, F.col("ts"), "minutes", 90).alias("over_90_minutes"),
    )


@query("SELECT p_partkey, upper(p_name) AS plate FROM part")
def upper_strip(t):
    padded = F.concat(F.lit("\t  "), "p_name", F.lit(" \n"))
    return t.part.select("p_partkey", text.upper_strip(padded).alias("plate"))


@query(
    r"""
    SELECT p_partkey,
           array_to_string(list_transform(
               regexp_extract_all(replace(p_name, ' ', '-d'''), '\pL+|[^\pL]+'),
               lambda y: upper(y[1]) || lower(y[2:])), '') AS driver
    FROM part
    """
)
def title_strip(t):
    name = F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("-d'")), F.lit(" "))
    return t.part.select("p_partkey", text.title_strip(name).alias("driver"))


@query("SELECT doc_id, text FROM documents")
def repair_encoding(t):
    damaged = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return t.spread("documents").select("doc_id", text.repair_double_encoding(damaged).alias("text"))


@query("SELECT doc_id, text FROM documents")
def decode_windows_1252(t):
    misread = text.decode_windows_1252(F.col("text").cast("binary"))
    repaired = text.repair_double_encoding(misread, windows_1252=True)
    return t.spread("documents").select("doc_id", repaired.alias("text"))


# Latin letters as they look after a Mac-Roman round trip; the repair table knows most of them.
MAC_ROMAN_DAMAGE = [("é", "√©"), ("ç", "√ß"), ("ä", "√§"), ("ü", "√º"), ("ñ", "√±"), ("ó", "√≥")]


def nested_replace(sql: str, pairs: list[tuple[str, str]]) -> str:
    for wrong, right in pairs:
        sql = f"replace({sql}, '{wrong}', '{right}')"
    return sql


@query(
    f"SELECT doc_id, {nested_replace(nested_replace('text', MAC_ROMAN_DAMAGE), MOJIBAKE_REPLACEMENTS)}"
    " AS text FROM documents"
)
def replace_table(t):
    damaged = F.col("text")
    for letter, pair in MAC_ROMAN_DAMAGE:
        damaged = F.replace(damaged, F.lit(letter), F.lit(pair))
    return t.spread("documents").select("doc_id", text.apply_replacements(damaged).alias("text"))


@query(
    """
    SELECT doc_id, text || ' "ffi" ABC' || chr(10) || 'x' AS text FROM documents
    """
)
def general_fix(t):
    damaged = F.replace("text", F.lit("\n"), F.lit("\r\n"))
    damaged = F.replace(damaged, F.lit("é"), F.lit("&eacute;"))
    damaged = F.replace(damaged, F.lit("ü"), F.lit("&#252;"))
    tail = F.lit(" “ﬃ” \uff21\uff22\uff23\u2028\u001b[31m\u0007x")
    documents = t.spread("documents").select("doc_id", F.concat(damaged, tail).alias("text"))
    return text.fix_texts(documents, ["text"])


@query(
    r"""
    SELECT doc_id,
           regexp_replace(strip_accents(replace(text, 'ß', '')), '[^\x00-\x7F]', '', 'g') AS folded
    FROM documents
    """
)
def ascii_fold(t):
    return t.spread("documents").select("doc_id", text.ascii_fold("text").alias("folded"))


@query(
    r"""
    SELECT page_id, string_split(url, 'example.')[2] AS tail,
           string_split(url, '/')[-1] AS base,
           CASE WHEN len(string_split(url, '/')) >= 2 THEN string_split(url, '/')[-2] END AS folder,
           url AS stem,
           'https://public.s3.amazonaws.com/pages/' || page_id || '.png' AS link
    FROM pages
    """
)
def path_parts(t):
    return t.pages.select(
        "page_id",
        paths.text_after_prefix("url", "example.").alias("tail"),
        paths.base_name("url").alias("base"),
        paths.path_segment("url", -2).alias("folder"),
        paths.strip_extension(F.concat("url", F.lit("/."), F.lit("x.png")), "/.x.png").alias("stem"),
        paths.public_url("public", F.concat(F.lit("pages/"), "page_id", F.lit(".png"))).alias("link"),
    )


@query(
    """
    SELECT event_id,
           CASE WHEN event_type = 'view' THEN 'amb' WHEN event_type = 'click' THEN 'irss'
                WHEN event_type = 'error' THEN 'ilum' END AS form,
           CASE WHEN event_type = 'view' THEN 'folder' ELSE 'file' END AS kind
    FROM events
    """
)
def classify_route(t):
    name = F.expr(
        "CASE event_type WHEN 'view' THEN ' AMB_irss.csv' WHEN 'click' THEN 'irss_irsp.csv' "
        "WHEN 'error' THEN 'x_ILUM.csv ' ELSE 'outro.csv' END"
    )
    mime = F.expr("if(event_type = 'view', 'application/vnd.google-apps.folder', 'image/png')")
    return t.events.select(
        "event_id", paths.route_column(name).alias("form"), paths.entry_kind(mime).alias("kind")
    )
