"""Text repair: strip and case, double encodings, damaged characters, charsets, ASCII folding.

Every repair is a native expression behind a cheap test, so undamaged text passes at the
price of one scan. Composition calls the normaliser that Spark ships for its collations; only
ASCII folding uses an Arrow UDF, and it receives null for every text that native expressions
have settled already.
"""

from __future__ import annotations

import html.entities
import unicodedata
from collections.abc import Callable
from functools import partial, reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formtide.functions.columns import as_column, quoted
from formtide.functions.fixed_values import (
    BLANKS,
    LIGATURES,
    MISSING_TOKENS,
    MOJIBAKE_REPLACEMENTS,
    WINDOWS_1252_BYTES,
    WINDOWS_1252_CHARS,
)

CASED_RUN = r"([\p{Lt}\p{IsLowercase}\p{IsUppercase}]+|[^\p{Lt}\p{IsLowercase}\p{IsUppercase}]+)"
# A multi-byte UTF-8 sequence that was read with a one-byte charset starts with such a pair.
UTF8_PAIR = r"[\x{{C2}}-\x{{F4}}][\x{{80}}-\x{{BF}}{}]"
UNDEFINED_WINDOWS_1252 = r"[\x{81}\x{8D}\x{8F}\x{90}\x{9D}]"


def strip_blanks(value: Column | str) -> Column:
    """Remove blanks of any kind, not only spaces, from both ends."""
    return F.btrim(as_column(value), F.lit(BLANKS))


def upper_strip(value: Column | str) -> Column:
    """Upper case without surrounding blanks (C4)."""
    return strip_blanks(F.upper(as_column(value)))


def title_strip(value: Column | str) -> Column:
    """Every run of letters capitalised, surrounding blanks removed.

    ``initcap`` alone breaks words at blanks only; here ``d'água`` becomes ``D'Água``.
    """
    runs = F.regexp_extract_all(as_column(value), F.lit(CASED_RUN), F.lit(1))
    return strip_blanks(F.array_join(F.transform(runs, F.initcap), ""))


def missing_to_null(value: Column | str) -> Column:
    """Null for a cell that a text table reader takes as missing."""
    text = as_column(value)
    return F.when(~text.isin(MISSING_TOKENS), text)


def _as_utf8(latin1: Column) -> Column:
    """Characters up to U+00FF taken as bytes and decoded as UTF-8; null when not valid."""
    return F.try_validate_utf8(F.encode(latin1, "ISO-8859-1").cast("string"))


def repair_double_encoding(value: Column | str, windows_1252: bool = False) -> Column:
    """Undo UTF-8 text that was read as Latin-1.

    The decoded text is taken only if every character fits a byte, the bytes are valid UTF-8
    and no ``Ã`` is left. With ``windows_1252`` the text was read with that charset instead.
    """
    text = as_column(value)
    trail = WINDOWS_1252_CHARS if windows_1252 else ""
    narrow = F.translate(text, trail, WINDOWS_1252_BYTES) if windows_1252 else text
    suspicious = text.rlike(UTF8_PAIR.format(trail)) & ~narrow.rlike(r"[\x{100}-\x{10FFFF}]")
    # the two bytes of Ã, seen before they are decoded
    clean = ~F.contains(narrow, F.lit("\u00c3\u0083"))
    return F.coalesce(F.when(suspicious & clean, _as_utf8(narrow)), text)


def replace_in_order(text: Column, table: list[tuple[str, str]]) -> Column:
    """Literal replacements one after the other."""
    rows = ", ".join(f"struct('{wrong}' AS wrong, '{right}' AS right)" for wrong, right in table)
    return F.aggregate(
        F.expr(f"array({rows})"),
        text,
        lambda done, row: F.replace(done, row["wrong"], row["right"]),
    )


def apply_replacements(value: Column | str) -> Column:
    """The ordered replacement table (C9), skipped for text that holds none of its keys."""
    text = as_column(value)
    damaged = F.contains(text, F.lit("√")) | F.contains(text, F.lit("Nã£o Atende"))
    return F.when(damaged, replace_in_order(text, MOJIBAKE_REPLACEMENTS)).otherwise(text)


def windows_1252_text(latin1: Column | str) -> Column:
    """Text that was read as ISO-8859-1 although it was windows-1252 (C11).

    Text with one of the five bytes windows-1252 leaves undefined stays ISO-8859-1.
    """
    text = as_column(latin1)
    mapped = F.translate(text, WINDOWS_1252_BYTES, WINDOWS_1252_CHARS)
    return F.when(text.rlike(UNDEFINED_WINDOWS_1252), text).otherwise(mapped)


def decode_windows_1252(content: Column | str) -> Column:
    """Bytes in windows-1252 to text, falling back to ISO-8859-1 (C11)."""
    return windows_1252_text(F.decode(as_column(content), "ISO-8859-1"))


# -- general text fix -------------------------------------------------------------------------

NAMED_ENTITIES = {
    f"&{name};": chr(point)
    for name, point in html.entities.name2codepoint.items()
    if point < 0x100 or 0x2010 <= point <= 0x2122
}
ENTITY_TABLE = "\x01".join(f"{name}\x02{letter}" for name, letter in NAMED_ENTITIES.items())
ENTITY = "&#?[0-9A-Za-z]{1,24};"
ENTITY_OR_TEXT = f"({ENTITY}|[^&]+|&)"
TERMINAL_ESCAPE = r"\x{1B}\[[0-9;]*[a-zA-Z]"
CONTROLS = r"\x{0}-\x{8}\x{B}\x{E}-\x{1F}\x{7F}\x{206A}-\x{206F}\x{FEFF}\x{FFF9}-\x{FFFC}"
BREAKS = r"\r\x{80}-\x{9F}\x{2028}\x{2029}"
CURLY = "\u02bc\u2018\u2019\u201a\u201b\u201c\u201d\u201e\u201f"
STRAIGHT = "'" * 5 + '"' * 4
DIGRAPH_RANGES = r"\x{132}\x{133}\x{149}\x{1C4}-\x{1CC}\x{1F1}-\x{1F3}"
LIGATURE_RANGES = DIGRAPH_RANGES + r"\x{FB00}-\x{FB06}"
# Everything below U+0300 is its own composed form, and so are common signs and punctuation.
MAY_COMPOSE = (
    r"[\x{300}-\x{200F}\x{2028}-\x{202F}\x{205F}-\x{209F}"
    r"\x{20C0}-\x{2219}\x{221B}-\x{10FFFF}]"
)
FULL_WIDTH = "".join(chr(point) for point in range(0xFF01, 0xFF5F)) + chr(0x3000)
HALF_WIDTH = "".join(chr(point - 0xFEE0) for point in range(0xFF01, 0xFF5F)) + " "


def _entity_text(token: Column) -> Column:
    """Text of one HTML entity; the token itself when it is none we know."""
    names = F.str_to_map(F.lit(ENTITY_TABLE), F.lit("\x01"), F.lit("\x02"))
    digits = F.regexp_extract(token, "^&#([0-9]{1,7});$", 1)
    hexes = F.regexp_extract(token, "^&#[xX]([0-9A-Fa-f]{1,6});$", 1)
    point = F.coalesce(
        F.when(digits != "", digits.try_cast("bigint")),
        F.when(hexes != "", F.conv(hexes, 16, 10).try_cast("bigint")),
    )
    valid = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    known = F.coalesce(F.try_element_at(names, token), F.when(valid, character), token)
    return F.when(F.startswith(token, F.lit("&")), known).otherwise(token)


def unescape_entities(value: Column | str) -> Column:
    """HTML entities to characters, unless the text looks like markup (part of C10)."""
    text = as_column(value)
    tokens = F.regexp_extract_all(text, F.lit(ENTITY_OR_TEXT), F.lit(1))
    plain = F.array_join(F.transform(tokens, _entity_text), "")
    return F.when(text.rlike(ENTITY) & ~F.contains(text, F.lit("<")), plain).otherwise(text)


def straighten_quotes(value: Column | str) -> Column:
    """Curly quotation marks to straight ones (part of C10)."""
    return F.translate(as_column(value), CURLY, STRAIGHT)


def narrow_letters(value: Column | str) -> Column:
    """Full-width forms to ASCII (part of C10)."""
    return F.translate(as_column(value), FULL_WIDTH, HALF_WIDTH)


def _settled_characters() -> tuple[str, str]:
    """One table for all that becomes one character or none: line breaks, stray C1 characters
    (windows-1252, quotation marks among them straight at once), full-width forms, quotation marks,
    and at the end, without a counterpart, the controls."""
    straight = dict(zip(CURLY, STRAIGHT))
    stray = {c: straight.get(w, w) for c, w in zip(WINDOWS_1252_BYTES, WINDOWS_1252_CHARS)}
    breaks = dict.fromkeys("\r\x85\u2028\u2029", "\n")
    one = stray | breaks | dict(zip(FULL_WIDTH, HALF_WIDTH)) | straight
    points = [*range(0x9), 0xB, *range(0xE, 0x20), 0x7F, *range(0x206A, 0x2070), 0xFEFF]
    gone = "".join(map(chr, [*points, *range(0xFFF9, 0xFFFD)])).replace("\r", "")
    return "".join(one) + gone, "".join(one.values())


SETTLED_FROM, SETTLED_TO = _settled_characters()


def settle_characters(value: Column | str) -> Column:
    """Line breaks to ``\\n``, stray C1 characters to windows-1252, controls removed, full-width forms to
    ASCII, quotation marks straight: one pass over the text (part of C10)."""
    text = F.replace(as_column(value), F.lit("\r\n"), F.lit("\n"))
    return F.translate(text, SETTLED_FROM, SETTLED_TO)


def remove_terminal_escapes(value: Column | str) -> Column:
    """Terminal escape sequences removed (part of C10)."""
    return F.regexp_replace(as_column(value), TERMINAL_ESCAPE, "")


def spell_out_ligatures(value: Column | str) -> Column:
    """Ligatures and digraphs to letters (part of C10)."""
    text = as_column(value)
    typographic = [pair for pair in LIGATURES if "\ufb00" <= pair[0] <= "\ufb06"]
    return F.when(text.rlike(f"[{DIGRAPH_RANGES}]"), replace_in_order(text, LIGATURES)).otherwise(
        replace_in_order(text, typographic)
    )


def may_compose(text: Column) -> Column:
    """Whether the composed form of a text can differ; false for ASCII without a scan by regex."""
    return (F.octet_length(text) != F.length(text)) & text.rlike(MAY_COMPOSE)


def composed(text: Column) -> Column:
    """Unicode composed form (NFC) by the normaliser that comes with Spark's collations."""
    return F.java_method(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False)
    )


def compose_characters(value: Column | str) -> Column:
    """Unicode composed form (NFC) within the JVM; text that cannot change passes after a test."""
    text = as_column(value)
    return F.when(may_compose(text), composed(text)).otherwise(text)


# What each step of the text fix acts on, and the step; they run in this order.
WIDE = r"\x{FF01}-\x{FF5E}\x{3000}"
QUOTES = r"\x{2BC}\x{2018}-\x{201F}"
FIX_STEPS = [
    ("&", unescape_entities),
    (UTF8_PAIR.format(WINDOWS_1252_CHARS), partial(repair_double_encoding, windows_1252=True)),
    (r"\x{1B}\[", remove_terminal_escapes),
    (f"[{LIGATURE_RANGES}]", spell_out_ligatures),
    (f"[{CONTROLS}{BREAKS}{WIDE}{QUOTES}]", settle_characters),
]
DECODE_FIRST = (UTF8_PAIR.format(""), repair_double_encoding)
# Printable ASCII without & and the Latin-1 letters: no step acts on a text of these alone, for a
# damaged pair ends in a character outside of them. (The negated class is several times slower.)
MAY_NEED_FIX = r"[\x{0}-\x{8}\x{B}-\x{1F}&\x{7F}-\x{BF}\x{100}-\x{10FFFF}]"


def _steps(decode_first: bool, compose: bool, replacements: bool) -> list[Callable[[Column], Column]]:
    """The steps of the text fix, each behind its own test.

    Order: entities, double encodings, terminal escapes, ligatures, single characters; with
    ``decode_first`` a Latin-1 double encoding is undone before (C8, then C10); then composition,
    then the replacement table (C9).
    """
    guarded = ([DECODE_FIRST] if decode_first else []) + FIX_STEPS

    def where(trigger: str, step: Callable) -> Callable[[Column], Column]:
        return lambda text: F.when(text.rlike(trigger), step(text)).otherwise(text)

    steps = [where(trigger, step) for trigger, step in guarded]
    return steps + [compose_characters] * compose + [apply_replacements] * replacements


# -- the steps as SQL: an expression is built by a call to the JVM per node, which for a wide table
# takes longer than the query; SQL is parsed once per column.


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _replace_sql(x: str, table: list[tuple[str, str]]) -> str:
    """Replacements in order. The table is one literal: a plan holds a node per column, not per pair."""
    pairs = _quote(chr(1).join(f"{wrong}{chr(2)}{right}" for wrong, right in table))
    wrong, right = (f"substring_index(pair, {_quote(chr(2))}, {side})" for side in (1, -1))
    return f"aggregate(split({pairs}, {_quote(chr(1))}), {x}, (done, pair) -> replace(done, {wrong}, {right}))"


def _entities_sql(x: str) -> str:
    names = f"str_to_map({_quote(ENTITY_TABLE)}, {_quote(chr(1))}, {_quote(chr(2))})"
    digits, hexes = "regexp_extract(e, '^&#([0-9]{1,7});$', 1)", "regexp_extract(e, '^&#[xX]([0-9A-Fa-f]{1,6});$', 1)"
    point = f"coalesce(try_cast({digits} AS bigint), try_cast(conv(nullif({hexes}, ''), 16, 10) AS bigint))"
    valid = f"({point} BETWEEN 1 AND 55295 OR {point} BETWEEN 57344 AND 1114111)"
    letter = f"if({valid}, decode(unhex(lpad(hex({point}), 8, '0')), 'UTF-32'), null)"
    token = f"e -> if(startswith(e, '&'), coalesce(try_element_at({names}, e), {letter}, e), e)"
    tokens = f"regexp_extract_all({x}, {_quote(ENTITY_OR_TEXT)}, 1)"
    return f"if({x} RLIKE {_quote(ENTITY)} AND NOT contains({x}, '<'), array_join(transform({tokens}, {token}), ''), {x})"


def _double_encoding_sql(x: str, windows_1252: bool = False) -> str:
    trail = WINDOWS_1252_CHARS if windows_1252 else ""
    narrow = f"translate({x}, {_quote(trail)}, {_quote(WINDOWS_1252_BYTES)})" if windows_1252 else x
    wide, broken = _quote(r"[\x{100}-\x{10FFFF}]"), _quote("\u00c3\u0083")
    decoded = f"try_validate_utf8(CAST(encode({narrow}, 'ISO-8859-1') AS string))"
    return f"coalesce(if(NOT {narrow} RLIKE {wide} AND NOT contains({narrow}, {broken}), {decoded}, null), {x})"


def _ligatures_sql(x: str) -> str:
    typographic = [pair for pair in LIGATURES if "\ufb00" <= pair[0] <= "\ufb06"]
    digraphs = _quote(f"[{DIGRAPH_RANGES}]")
    return f"if({x} RLIKE {digraphs}, {_replace_sql(x, LIGATURES)}, {_replace_sql(x, typographic)})"


def _settle_sql(x: str) -> str:
    lines = f"replace({x}, '\\r\\n', '\\n')"
    return f"translate({lines}, {_quote(SETTLED_FROM)}, {_quote(SETTLED_TO)})"


def _steps_sql(x: str, decode_first: bool, compose: bool, replacements: bool) -> list[str]:
    """``_steps`` for a column, each as SQL text over the name ``x``."""
    bodies = [
        _entities_sql(x), _double_encoding_sql(x, windows_1252=True),
        f"regexp_replace({x}, {_quote(TERMINAL_ESCAPE)}, '')", _ligatures_sql(x), _settle_sql(x),
    ]
    tests = [f"{x} RLIKE {_quote(trigger)}" for trigger, _ in FIX_STEPS]
    if decode_first:
        tests.insert(0, f"{x} RLIKE {_quote(DECODE_FIRST[0])}")
        bodies.insert(0, _double_encoding_sql(x))
    if compose:
        tests.append(f"octet_length({x}) != length({x}) AND {x} RLIKE {_quote(MAY_COMPOSE)}")
        bodies.append(f"java_method('com.ibm.icu.text.Normalizer', 'compose', {x}, false)")
    if replacements:
        tests.append(f"contains({x}, '√') OR contains({x}, 'Nã£o Atende')")
        bodies.append(_replace_sql(x, MOJIBAKE_REPLACEMENTS))
    return [f"if({test}, {body}, {x})" for test, body in zip(tests, bodies)]


def fix_texts(
    df: DataFrame,
    columns: list[str],
    decode_first: bool = False,
    compose: bool = True,
    replacements: bool = False,
) -> DataFrame:
    """The general text fix on text columns (C10; with ``decode_first`` C8 before, with
    ``replacements`` C9 after it).

    All texts of a row go through one expression, so a plan holds the steps once, whatever the number
    of columns. A text without anything to fix costs one test and is null to the steps; a step's
    result is computed once, however often the next needs it. Every column named here is read: a
    reader of a few columns names these.
    """
    if not columns:
        return df
    test = _quote(MAY_NEED_FIX)
    every = [quoted(name) for name in df.columns]
    fixed = f"transform(array({', '.join(map(quoted, columns))}), t -> if(t RLIKE {test}, t, null))"
    for step in _steps_sql("t", decode_first, compose, replacements):
        fixed = f"transform({fixed}, t -> {step})"
    mark = "_fixed"
    while mark in df.columns:
        mark += "_"
    place = {name: i for i, name in enumerate(columns)}
    return df.selectExpr(*every, f"{fixed} AS {mark}").selectExpr(
        *[
            f"coalesce({mark}[{place[name]}], {column}) AS {column}" if name in place else column
            for name, column in zip(df.columns, every)
        ]
    )


def fix_text(value: Column | str, decode_first: bool = False, compose: bool = True) -> Column:
    """The text fix as an expression, for a single text; ``fix_texts`` is the one for tables."""
    text = as_column(value)
    steps = _steps(decode_first, compose, False)
    damaged = F.filter(F.array(text), lambda one: one.rlike(MAY_NEED_FIX))
    fixed = reduce(lambda texts, step: F.transform(texts, step), steps, damaged)
    return F.coalesce(F.get(fixed, 0), text)


# -- ASCII folding ----------------------------------------------------------------------------


def _ascii_folder():
    """Arrow UDF: NFKD without what is not ASCII. Self-contained like the others."""

    @F.arrow_udf(T.StringType())
    def fold_batch(texts: pa.Array) -> pa.Array:
        return pc.replace_substring_regex(pc.utf8_normalize(texts, form="NFKD"), r"[^\x00-\x7F]+", "")

    return fold_batch


def _fold(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


def _fold_tables() -> tuple[str, str]:
    """Characters below U+2100 that fold to one ASCII character, then those that vanish."""
    single, vanishing = {}, []
    for point in [*range(0x80, 0x370), *range(0x1E00, 0x2100)]:
        folded = _fold(chr(point))
        if len(folded) == 1:
            single[chr(point)] = folded
        elif not folded:
            vanishing.append(chr(point))
    return "".join(single) + "".join(vanishing), "".join(single.values())


FOLD_FROM, FOLD_TO = _fold_tables()


def ascii_fold(value: Column | str) -> Column:
    """Decompose, then drop everything outside ASCII (C17).

    Latin letters, combining marks and punctuation fold natively; the UDF sees only texts that
    hold something else.
    """
    text = F.translate(as_column(value), FOLD_FROM, FOLD_TO)
    rest = F.when(text.rlike(r"[\x{80}-\x{10FFFF}]"), text)
    return F.coalesce(_ascii_folder()(rest), text)


# -- maps of fields ---------------------------------------------------------------------------


def repair_fields(df: DataFrame, fields: str = "fields", compose: bool = True) -> DataFrame:
    """The text fix and the replacement table on all values of a map column (C10, then C9).

    Values without anything to fix are null to the steps; a record without any passes as it is.
    """
    others = [quoted(name) for name in df.columns if name != fields]
    values = as_column(fields)
    some = F.exists(F.map_values(values), _needs_fix)
    damaged = F.transform_values(values, lambda _, text: F.when(text.rlike(MAY_NEED_FIX), text))
    fixed = reduce(_on_values, _steps(False, compose, True), F.when(some, damaged))
    repaired = F.map_zip_with(values, fixed, lambda _, text, better: F.coalesce(better, text))
    return df.select(*others, F.when(some, repaired).otherwise(values).alias(fields))


def _needs_fix(text: Column) -> Column:
    return F.coalesce(text.rlike(MAY_NEED_FIX), F.lit(False))


def _on_values(fields: Column, step: Callable[[Column], Column]) -> Column:
    return F.transform_values(fields, lambda _, text: step(text))
