"""Casts, text repair, paths and dates on hand-written cells."""

from __future__ import annotations

import datetime
import html
import unicodedata

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from formtide.functions import casts, paths, text
from formtide.functions.fixed_values import MISSING_TOKENS, MOJIBAKE_REPLACEMENTS


def apply(spark, values, function):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string")
    return [r.y for r in df.select("i", function("x").alias("y")).orderBy("i").collect()]


NUMBERS = [
    "1", " 12 ", "1e3", "1d", "1f", "0x10", "0x1p3", "inf", "-Infinity", "nan", "NaN", "+5", ".5",
    "5.", "1,5", "1_000", "", "abc", None, "1e400", "١", "1693526400000.0", "-7",
]


def test_to_number_follows_pandas(spark):
    expected = pd.to_numeric(pd.Series(NUMBERS), errors="coerce")
    got = apply(spark, NUMBERS, casts.to_number)
    assert got == [None if pd.isna(v) else v for v in expected]


def test_epoch_ms(spark):
    values = ["1693526400000", "1693526400000.0", "1693526400000.5", "abc", None, "9223372036855000", "inf"]
    moment = datetime.datetime(2023, 9, 1)
    half = moment + datetime.timedelta(microseconds=500)
    assert apply(spark, values, casts.epoch_ms_to_timestamp) == [moment, moment, half, None, None, None, None]


def test_epoch_ms_beyond_a_nanosecond_clock(spark):
    values = ["9223372036855", "28671681925123", "28671681925123.0", "72057594037927", "253402300799999", "-62100000000001"]
    zero = datetime.datetime(1970, 1, 1)
    expected = [zero + datetime.timedelta(milliseconds=int(v.split(".")[0])) for v in values]
    assert apply(spark, values, casts.epoch_ms_to_timestamp) == expected
    # the last millisecond of the clock, which no double holds, and the first beyond it
    def micros(value):
        return F.unix_micros(casts.epoch_ms_to_timestamp(value))

    last = ["9223372036854775", "9223372036854776", "-9223372036854775", "1e300"]
    assert apply(spark, last, micros) == [9223372036854775000, None, -9223372036854775000, None]


def test_single_conversion_keeps_real_dates(spark):
    # converting twice, as the data's former owner did, reads nanoseconds as milliseconds: null
    once = pd.to_datetime(pd.Series([1693526400000]), unit="ms")
    twice = pd.to_datetime(pd.to_numeric(once, errors="coerce"), unit="ms", errors="coerce")
    assert twice.isna().all()
    assert apply(spark, ["1693526400000"], casts.epoch_ms_to_timestamp)[0] is not None


def test_text_to_timestamp(spark):
    values = ["2024-05-06 07:08:09", "bad", None]
    assert apply(spark, values, casts.text_to_timestamp) == [datetime.datetime(2024, 5, 6, 7, 8, 9), None, None]
    iso = apply(spark, ["2024-05-06T07:08:09", "1693526400000", "x"], casts.epoch_or_text_to_timestamp)
    assert iso == [datetime.datetime(2024, 5, 6, 7, 8, 9), datetime.datetime(2023, 9, 1), None]


def test_yes_no_and_truthy(spark):
    values = ["sim", "Não", "NÃO", "x", None, "1", "TRUE"]
    assert apply(spark, values, casts.yes_no) == [True, False, False, None, None, None, None]
    assert apply(spark, values, casts.truthy) == [True, False, False, False, False, True, True]


def test_now_text_with_fixed_instant(spark):
    instant = F.lit("2024-01-01 03:00:00.5").cast("timestamp")
    row = spark.range(1).select(
        casts.now_text("America/Sao_Paulo", instant).alias("a"),
        casts.now_text(None, instant).alias("b"),
        casts.now_text("Asia/Kolkata", instant).alias("c"),
    )
    assert tuple(row.first()) == (
        "2024-01-01T00:00:00.500000-0300",
        "2024-01-01T03:00:00.500000+0000",
        "2024-01-01T08:30:00.500000+0530",
    )


@pytest.mark.parametrize("micros, expected", [(60_000_000, False), (60_000_001, True), (-60_000_001, True)])
def test_gap_is_strict(spark, micros, expected):
    past = F.lit("2024-01-01 00:00:00").cast("timestamp")
    future = F.timestamp_micros(F.unix_micros(past) + micros)
    assert spark.range(1).select(casts.gap_exceeds(past, future)).first()[0] is expected


def test_upper_and_title(spark):
    values = [" joão d'água\u00a0", "ana-maria", "\t\nABC 1d23\u2003", "o'NEILL", "cafe\u0301s", None]
    assert apply(spark, values, text.title_strip) == [v and v.title().strip() for v in values]
    assert apply(spark, values, text.upper_strip) == [v and v.upper().strip() for v in values]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(min_codepoint=32, max_codepoint=0x17F)), min_size=20, max_size=60))
def test_strip_follows_python(spark, values):
    assert apply(spark, values, text.strip_blanks) == [v.strip() for v in values]


def python_repair(value):
    try:
        decoded = value.encode("latin-1").decode("utf-8")
    except UnicodeError:
        return value
    return value if "Ã" in decoded else decoded


MOJIBAKE = ["nÃ£o", "ação", "Ã", "avaliaÃ§Ã£o €", "plain", "", "Ãƒ£", "Â°", "\u0080Ã£", "não nÃ£o"]


def test_repair_double_encoding(spark):
    assert apply(spark, MOJIBAKE, text.repair_double_encoding) == [python_repair(v) for v in MOJIBAKE]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(min_codepoint=1, max_codepoint=0x130)), min_size=20, max_size=60))
def test_repair_on_random_text(spark, values):
    values = values + [v.encode("utf-8").decode("latin-1") for v in values]
    assert apply(spark, values, text.repair_double_encoding) == [python_repair(v) for v in values]


def test_replacement_table(spark):
    values = [wrong for wrong, _ in MOJIBAKE_REPLACEMENTS] + ["xN√£o poss√≠vely", "√ö√¥√∞", "plain", None]

    def expected(value):
        for wrong, right in MOJIBAKE_REPLACEMENTS:
            value = value.replace(wrong, right)
        return value

    assert apply(spark, values, text.apply_replacements) == [v and expected(v) for v in values]


FIX_CASES = {
    "a&amp;b &eacute; &#233; &#x41; &zzz;": "a&b é é A &zzz;",
    "<b>&amp;</b>": "<b>&amp;</b>",
    "\u001b[31mred\u001b[0m": "red",
    "ﬁm “x” l’a": "fim \"x\" l'a",
    "a\r\nb\rc\u2028d": "a\nb\nc\nd",
    "cafe\u0301": "café",
    "ＡＢＣ": "ABC",
    "bell\u0007": "bell",
    "nÃ£o": "não",
    "â€œoiâ€\u009d": '"oi"',
    "\u0085\u0096": "\n–",
    "ação já": "ação já",
}


def test_fix_text_steps(spark):
    assert apply(spark, list(FIX_CASES), text.fix_text) == list(FIX_CASES.values())


def fixed(spark, values, **options):
    df = spark.createDataFrame([(i, v, "ﬁ", v) for i, v in enumerate(values)], "i int, `a b` string, _fixed string, other string")
    rows = text.fix_texts(df, ["a b", "_fixed"], **options).orderBy("i").collect()
    assert [r.other for r in rows] == values and {r._fixed for r in rows} == {"fi"}
    return [r["a b"] for r in rows]


AWKWARD = [
    None, "", "nÃ£o &amp; cafe\u0301", "Ãƒ£", "&#55296; &#1114112; &#x10FFFF; &#0;", "a & b &amp <i>", "it's \\ 'x' ",
    "\u001b[3ﬁx \u001b[1;31mred", "e\u0301\u0327 가 \u212b", "ǆﬀ \u0149", "\r\u0007\n\r\n\u0085", "N√£o £ Nã£o Atende",
]


@pytest.mark.parametrize("first", [False, True])
def test_tables_are_fixed_as_single_texts(spark, first):
    values = [*FIX_CASES, *FIX_CASES.values(), *MOJIBAKE, *AWKWARD]
    expected = apply(spark, values, lambda x: text.fix_text(x, decode_first=first))
    assert fixed(spark, values, decode_first=first) == expected
    replaced = apply(spark, expected, text.apply_replacements)
    assert fixed(spark, values, decode_first=first, replacements=True) == replaced
    maps = spark.createDataFrame([(i, {"k": v, "n": None}) for i, v in enumerate(values)], "i int, fields map<string,string>")
    rows = text.repair_fields(maps).orderBy("i").collect()
    if not first:
        assert [r.fields for r in rows] == [{"k": v, "n": None} for v in replaced]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(min_codepoint=0x41, max_codepoint=0xFFF, exclude_categories=["Cs", "Cn"])), min_size=20, max_size=60))
def test_composition_follows_unicode(spark, values):
    values = values + [unicodedata.normalize("NFD", v) for v in values]
    assert apply(spark, values, text.compose_characters) == [unicodedata.normalize("NFC", v) for v in values]



def test_entities_follow_the_html_table(spark):
    values = list(text.NAMED_ENTITIES)
    assert apply(spark, values, text.unescape_entities) == [html.unescape(v) for v in values]


def test_nothing_to_fix_never_matches_a_step(spark):
    clean = "".join(chr(p) for p in [9, 10, *range(32, 127), *range(0xC0, 0x100)] if chr(p) != "&")
    assert apply(spark, [clean], text.fix_text) == [clean]


def test_windows_1252(spark):
    defined = bytes(b for b in range(0x20, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    undefined = [bytes([0x93, b]) for b in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    df = spark.createDataFrame([(i, b) for i, b in enumerate([defined, *undefined])], "i int, b binary")
    got = [r.x for r in df.select("i", text.decode_windows_1252("b").alias("x")).orderBy("i").collect()]
    assert got == [defined.decode("cp1252")] + [b.decode("latin-1") for b in undefined]


def test_ascii_fold(spark):
    values = ["Ação – São", "ﬁ ½ ①", "日本", "œæß", "e\u0301", "x", None, "".join(map(chr, range(0x80, 0x250)))]

    def fold(value):
        return unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()

    assert apply(spark, values, text.ascii_fold) == [v and fold(v) for v in values]


def test_missing_tokens(spark):
    assert apply(spark, [*MISSING_TOKENS, "x", None], text.missing_to_null) == [None] * len(MISSING_TOKENS) + ["x", None]


def test_text_after_prefix(spark):
    prefix = "gridfs://registrationFiles/"
    values = [f"{prefix}abc", "x", f"{prefix}a {prefix}b", None, prefix]
    assert apply(spark, values, lambda c: paths.text_after_prefix(c, prefix)) == ["abc", None, "a ", None, ""]


def test_path_functions(spark):
    import os.path

    values = ["a/b.c/d", "x.tar.gz", ".bashrc", "a/.x", "...jpg", "..a.jpg", "a.jpg", "s/t/u.png"]
    assert apply(spark, values, paths.strip_extension) == [os.path.splitext(v)[0] for v in values]
    assert apply(spark, values, paths.base_name) == [os.path.basename(v) for v in values]
    assert apply(spark, ["a/b/c", "c"], lambda c: paths.path_segment(c, -2)) == ["b", None]
    assert apply(spark, ["gridfs://x/ab\\"], paths.file_id_of_reference) == ["ab"]
    assert apply(spark, ["k/x.png"], lambda c: paths.public_url("b", c)) == ["https://b.s3.amazonaws.com/k/x.png"]
    assert paths.layer_path("s3a://x/y/", "ilum", "csv") == "s3a://x/y/ilum/ilum.csv"


def test_routes(spark):
    names = ["irsp.csv", "AMB_irss.csv", "outro.csv", " irsrsd.json"]
    expected = ["irsp", "amb", None, "irsrsd"]
    assert [paths.route_name(n) for n in names] == expected
    assert apply(spark, names, paths.route_column) == expected
