"""JSON records: parsing, flattening to one row per leaf, alignment to a common set of keys.

Records stay ``VARIANT`` until a leaf is reached. Flattening is a chain of generators in one
pass over the input: no shuffle, no second scan, no action.
"""

from __future__ import annotations

import json
import sys
from decimal import Decimal
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formtide.functions.columns import as_column, quoted

# Levels unfolded by generators when the depth of the records is not known beforehand.
NATIVE_LEVELS = 8

DEEP_LEAF = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("json", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("in_list", T.BooleanType()),
    ]
)


LEAVES = "array<struct<path: string, level: int, value: string, rest: variant>>"

JSON_KEY = r'"(?:[^"\\]++|\\.)*+":'
# A non-empty list; an object has no first position.
IS_FILLED_LIST = "try_variant_get(_node, '$[0]', 'variant') IS NOT NULL"

PREFIXED_OR_CONTAINER = """CASE WHEN schema_of_variant(_node) = 'STRING'
    THEN NOT in_list AND startswith(try_variant_get(_node, '$', 'string'), :prefix)
    ELSE startswith(schema_of_variant(_node), 'OBJECT<') OR startswith(schema_of_variant(_node), 'ARRAY<') END"""

# A scalar's type in the schema of a record.
SCALAR_TYPE = r": (?:[A-Z]+|DECIMAL\(\d+,\d+\))(?=[,>])"

WIDE_INTEGER = r"^DECIMAL\((19|[23][0-9]),0\)$"


def scalar_text(node: Column) -> Column:
    """A scalar as text; a float keeps its fraction: ``2.0`` does not become ``2``."""
    name = F.schema_of_variant(node)
    text = node.cast("string")
    whole_float = name.endswith(",0)") & ~name.rlike(WIDE_INTEGER)
    return F.when(whole_float, F.concat(text, F.lit(".0"))).otherwise(text)


def parse_json(text: Column | str) -> Column:
    """JSON text to ``VARIANT``, null when it does not parse."""
    return F.try_parse_json(as_column(text))


def _as_variant(df: DataFrame, source: str) -> Column:
    if isinstance(df.schema[source].dataType, T.VariantType):
        return as_column(source)
    return parse_json(source)


def kind_of(node: Column) -> Column:
    """Type of a value: str, int, float, bool, null, list or dict.

    A number without fraction is a short ``DECIMAL(n,0)`` when it was written as ``2.0``, and a
    long one when it is an integer beyond 64 bits.
    """
    name = F.schema_of_variant(node)
    return (
        F.when(name == "STRING", "str")
        .when((name == "BIGINT") | name.rlike(WIDE_INTEGER), "int")
        .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "float")
        .when(name == "BOOLEAN", "bool")
        .when(name == "VOID", "null")
        .when(name.startswith("OBJECT"), "dict")
        .when(name.startswith("ARRAY"), "list")
        .otherwise(F.lower(name))
    )


def _deep_walk(sep: str, lists: bool):
    """Walk over record parts ``(path, node)`` that lie deeper than the native levels.

    It only walks. A leaf is handed back as JSON that parses to the very value it was, so kind
    and text of a deep leaf come from the same expressions as those of any other.
    Self-contained, so executors need no copy of this package to run it.
    """
    first_level = NATIVE_LEVELS + 1

    def as_json(value):
        if isinstance(value, dict):
            cells = (f"{json.dumps(key)}:{as_json(cell)}" for key, cell in value.items())
            return "{" + ",".join(cells) + "}"
        if isinstance(value, list):
            return "[" + ",".join(map(as_json, value)) + "]"
        if isinstance(value, Decimal):
            text = format(value, "f")
            # an integer of up to 18 digits would parse as one, a decimal never was one
            return text if "." in text or len(text.lstrip("-")) > 18 else f"{text}.0"
        if isinstance(value, float):
            # only numbers with an exponent parse as DOUBLE
            text = repr(value)
            return text if "e" in text else f"{text}e0"
        return json.dumps(value, default=str)

    def unfold_parts(parts):
        leaves, pending = [], [(path, node, first_level) for path, node in parts]
        while pending:
            path, node, level = pending.pop()
            in_list = isinstance(node, list)
            for step, child in enumerate(node) if in_list else node.items():
                here = f"{path}{sep}{step}"
                if isinstance(child, dict) or (lists and isinstance(child, list)):
                    pending.append((here, child, level + 1))
                else:
                    leaves.append((here, as_json(child), level, in_list))
        return leaves

    return unfold_parts


def _deep_leaves(sep: str, lists: bool):
    """Arrow UDF: leaves of one record part that lies deeper than the generators reach."""
    unfold_parts = _deep_walk(sep, lists)

    @F.pandas_udf(T.ArrayType(DEEP_LEAF))
    def unfold(parts: pd.Series) -> pd.Series:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))
        return parts.map(lambda part: unfold_parts([("", part.toPython())]), na_action="ignore")

    return unfold


def flatten_json(
    df: DataFrame,
    source: str,
    sep: str = "_",
    parent: str = "",
    depth: int | None = None,
    explode_arrays: bool = True,
) -> DataFrame:
    """One row per leaf of a JSON column (J1, J2; J4 with ``explode_arrays=False``).

    Keeps the other columns and adds ``path``, ``value`` (text), ``kind``, ``level`` and
    ``in_list`` (the leaf stands directly in a list). Paths join keys and list positions with
    ``sep``. Null leaves stay, empty objects and lists vanish, a lone scalar has a path only
    if ``parent`` names one. Without arrays exploded, a list is a leaf that holds JSON text.

    ``depth=None`` unfolds any depth: eight levels by generators, whatever lies deeper by an
    Arrow UDF that gets null for all other rows. A caller who knows the depth passes it and
    stays within the JVM; a record that turns out deeper then fails the query instead of
    losing leaves.
    """
    keep = [quoted(name) for name in df.columns if name != source]
    current = _opened_levels(df, source, sep, parent, depth, explode_arrays)
    return _leaves(current, keep, sep, depth, explode_arrays)


def _opened_levels(
    df: DataFrame,
    source: str,
    sep: str,
    parent: str,
    depth: int | None,
    explode_arrays: bool,
    prefix: str | None = None,
) -> DataFrame:
    """Nodes ``path, _node, level, in_list`` after the native levels, by a chain of generators.

    With a prefix, every level passes on only containers and the strings that ``find_by_prefix`` wants.
    """
    levels = NATIVE_LEVELS if depth is None else depth
    keep = [quoted(name) for name in df.columns if name != source]
    start = df.select(
        *keep,
        F.lit(parent).alias("path"),
        _as_variant(df, source).alias("_node"),
        F.lit(0).alias("level"),
        F.lit(False).alias("in_list"),
    )
    # only objects are opened if lists are to stay cells
    opened = "_node" if explode_arrays else f"if({IS_FILLED_LIST}, null, _node)"
    others = "".join(f"{name}, " for name in keep)
    unfolded = "{start}"
    for _ in range(levels):
        unfolded = f"""(
            SELECT {others}
                CASE WHEN pos IS NULL THEN path
                     WHEN key IS NOT NULL AND path = '' THEN key
                     ELSE concat(path, :sep, coalesce(key, cast(pos AS string))) END AS path,
                if(pos IS NULL, _node, value) AS _node,
                if(pos IS NULL, level, level + 1) AS level,
                if(pos IS NULL, in_list, key IS NULL) AS in_list
            FROM (SELECT *, {opened} AS _open FROM {unfolded}),
                LATERAL variant_explode_outer(_open) AS _step(pos, key, value)
        )"""
        unfolded = unfolded if prefix is None else f"(SELECT * FROM {unfolded} WHERE {PREFIXED_OR_CONTAINER})"
    args = {"sep": sep} if prefix is None else {"sep": sep, "prefix": prefix}
    return df.sparkSession.sql(f"SELECT * FROM {unfolded}", args=args, start=start)


def _leaves(
    current: DataFrame, keep: list[str], sep: str, depth: int | None, explode_arrays: bool
) -> DataFrame:
    """Nodes after the native levels to leaves; what is deeper goes to an Arrow UDF or fails."""
    node, path = F.col("_node"), F.col("path")
    kind = kind_of(node)
    containers = ["dict", "list"] if explode_arrays else ["dict"]
    current = current.withColumn("kind", kind)
    is_container = F.col("kind").isin(containers)
    text = F.to_json(node)
    has_content = is_container & ~text.isin("{}", "[]")
    value = F.when(F.col("kind") == "list", text).otherwise(scalar_text(node))
    if depth is None:
        rest = _deep_leaves(sep, explode_arrays)(F.when(has_content, node))
        below = F.explode_outer(rest).alias("_below")
        current = current.select("*", below).filter(~is_container | F.col("_below").isNotNull())
        current = current.select(
            *keep,
            F.concat(path, F.coalesce("_below.path", F.lit(""))).alias("path"),
            F.coalesce(F.try_parse_json("_below.json"), node).alias("_node"),
            F.coalesce("_below.level", "level").alias("level"),
            F.coalesce("_below.in_list", "in_list").alias("in_list"),
        ).withColumn("kind", kind)
        leaves = current.select(*keep, "path", value.alias("value"), "kind", "level", "in_list")
    else:
        too_deep = F.raise_error(
            F.concat(F.lit(f"record deeper than the declared {depth} levels at "), path)
        )
        vanishes = F.when(has_content, too_deep.cast("boolean")).otherwise(is_container)
        leaves = current.filter(~vanishes).select(
            *keep, "path", value.alias("value"), "kind", "level", "in_list"
        )
    return leaves.filter(path != "")


def _deep_fields(sep: str, lists: bool):
    """Arrow UDF: all leaves of the parts of a record that lie below the native levels.

    Takes the parts as one list and the path of each; a leaf comes back as by ``_deep_leaves``.
    """
    unfold_parts = _deep_walk(sep, lists)

    @F.pandas_udf(T.ArrayType(DEEP_LEAF))
    def unfold(parts: pd.Series, paths: pd.Series) -> pd.Series:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))
        return pd.Series(
            [
                None if nodes is None else unfold_parts(list(zip(names, nodes.toPython())))
                for nodes, names in zip(parts, paths)
            ],
            dtype=object,
        )

    return unfold


def unfold_fields(
    df: DataFrame,
    source: str,
    fields: str = "fields",
    sep: str = "_",
    depth: int | None = None,
    explode_arrays: bool = True,
) -> DataFrame:
    """All leaves of a JSON column as one ``map<string,string>`` per row.

    The same leaves as ``flatten_json`` gives, but unfolded level by level inside the row: nothing is
    exploded, so there is nothing to gather and no shuffle, and a record needs no key. Every level
    opens only the containers that the one before has found. If a path occurs twice in a record, the
    value nearest the root wins. Rows without a leaf are left out.

    ``depth`` as for ``flatten_json``.
    """
    levels = NATIVE_LEVELS if depth is None else depth
    keep = [quoted(name) for name in df.columns if name != source]

    def steps(node: Column, level: int) -> Column:
        """Members of an object or elements of a list as key and value; null for anything else.

        A list at the root has no name before its positions, but the separator.
        """
        members = F.map_entries(F.try_variant_get(node, "$", "map<string,variant>"))
        if not explode_arrays:
            return members
        elements = F.transform(
            F.try_variant_get(node, "$", "array<variant>"),
            lambda child, place: F.struct(
                (place.cast("string") if level else F.concat(F.lit(sep), place)).alias("key"),
                child.alias("value"),
            ),
        )
        return F.coalesce(members, elements)

    def leaf(node: Column, path: Column, level: int) -> Column:
        text = scalar_text(node)
        if not explode_arrays:
            is_list = F.schema_of_variant(node).startswith("ARRAY")
            text = F.when(is_list, F.to_json(node)).otherwise(text)
        return F.struct(
            path.alias("path"), F.lit(level).alias("level"), text.alias("value"),
            F.lit(None).cast("variant").alias("rest"),
        )

    def unfold(node: Column, path: Column, level: int) -> Column:
        """All leaves below a node; what is no container is one leaf."""
        if level == levels:
            return at_end(node, path, level)
        prefix = F.concat(path, F.lit(sep)) if level else F.lit("")

        def child(step: Column) -> Column:
            return unfold(step["value"], F.concat(prefix, step["key"]), level + 1)

        below = F.flatten(F.transform(steps(node, level), child))
        own = F.array(leaf(node, path, level)) if level else F.array().cast(LEAVES)
        return F.coalesce(below, own)

    def at_end(node: Column, path: Column, level: int) -> Column:
        """A leaf, or a container for which there is no level left."""
        inner = steps(node, level)
        if depth is None:
            rest = F.array(
                F.struct(
                    path.alias("path"), F.lit(level).alias("level"),
                    F.lit(None).cast("string").alias("value"), node.alias("rest"),
                )
            )
        else:
            message = F.concat(F.lit(f"record deeper than the declared {depth} levels at "), path)
            rest = F.raise_error(message).cast(LEAVES)
        return (
            F.when(F.size(inner) > 0, rest)
            .when(inner.isNotNull(), F.array().cast(LEAVES))
            .otherwise(F.array(leaf(node, path, level)))
        )

    current = df.select(*keep, _as_variant(df, source).alias("_record"))
    # no generator and no projection between the levels, so nothing is copied from one to the next
    current = current.select(*keep, unfold(F.col("_record"), F.lit(""), 0).alias("_entries"))
    if depth is None:
        rest = F.filter("_entries", lambda e: e["rest"].isNotNull())
        some = F.exists("_entries", lambda e: e["rest"].isNotNull())
        parts = F.to_variant_object(F.transform(rest, lambda e: e["rest"]))
        paths = F.transform(rest, lambda e: e["path"])
        below = _deep_fields(sep, explode_arrays)(F.when(some, parts), F.when(some, paths))
        current = current.select(*keep, "_entries", below.alias("_below"))
        deep = F.transform(
            F.col("_below"), lambda e: deep_leaf(F.try_parse_json(e["json"]), e["path"], e["level"])
        )
        native = F.filter("_entries", lambda e: e["rest"].isNull())
        whole = F.concat(native, F.coalesce(deep, F.array().cast(LEAVES)))
        current = current.select(*keep, whole.alias("_entries"))
    return _as_fields(current, keep, fields)


def deep_leaf(node: Column, path: Column, level: Column) -> Column:
    is_list = F.schema_of_variant(node).startswith("ARRAY")
    text = F.when(is_list, F.to_json(node)).otherwise(scalar_text(node))
    return F.struct(
        path.alias("path"), level.alias("level"), text.alias("value"),
        F.lit(None).cast("variant").alias("rest"),
    )


def _as_fields(records: DataFrame, keep: list[str], fields: str) -> DataFrame:
    """``_entries`` (path, level, value) as a map; of equal paths the one nearest the root stays."""
    entries = F.col("_entries")

    def as_map(found: Column) -> Column:
        return F.map_from_entries(F.transform(found, lambda e: F.struct(e["path"], e["value"])))

    ordered = F.array_sort(
        F.transform(entries, lambda e: F.struct(e["path"], e["level"], e["value"]))
    )
    # the first of a path is the one that no entry before it shares; only records with a collision pay
    first_of_path = F.aggregate(
        ordered,
        F.array().cast("array<struct<path: string, level: int, value: string>>"),
        lambda done, e: F.when(
            F.try_element_at(done, F.lit(-1))["path"] == e["path"], done
        ).otherwise(F.array_append(done, e)),
    )
    paths = F.transform(entries, lambda e: e["path"])
    distinct = F.size(F.array_distinct(paths)) == F.size(entries)
    whole = F.when(distinct, as_map(entries)).otherwise(as_map(first_of_path))
    # a generator drops rows without a leaf; a filter would be pushed down and unfold them twice
    some = F.when(F.size(entries) > 0, F.array(whole))
    return records.select(*keep, F.explode(some).alias(fields))


def normalize_fields(
    df: DataFrame, source: str, fields: str = "fields", depth: int | None = None
) -> DataFrame:
    """The leaves of ``normalize_json`` as one map per row; row-local."""
    keep = [quoted(name) for name in df.columns if name != source]
    dotted = unfold_fields(df, source, "_dotted", ".", depth, explode_arrays=False)
    entries = F.transform(
        F.map_entries("_dotted"),
        lambda e: F.struct(
            F.replace(e["key"], F.lit("."), F.lit("_")).alias("path"),
            # levels are counted by the dots, which only collisions ask for
            F.length(F.regexp_replace(e["key"], "[^.]", "")).alias("level"),
            e["value"].alias("value"),
        ),
    )
    return _as_fields(dotted.select(*keep, entries.alias("_entries")), keep, fields)


def flatten_records(
    df: DataFrame, source: str, sep: str = ".", parent: str = "", depth: int | None = None
) -> DataFrame:
    """Library flavour (J2): a list at the root is one record per element, ``item`` numbers them."""
    node = _as_variant(df, source)
    opened = df.withColumn(source, node).withColumn(
        "_elements", F.try_variant_get(as_column(source), "$", "array<variant>")
    )
    keep = [quoted(name) for name in df.columns if name != source]
    single = F.array(F.struct(F.lit(0).alias("item"), as_column(source).alias("record")))
    listed = F.transform(
        "_elements", lambda record, item: F.struct(item.alias("item"), record.alias("record"))
    )
    records = opened.select(
        *keep, F.inline(F.when(F.col("_elements").isNull(), single).otherwise(listed))
    )
    return flatten_json(records, "record", sep=sep, parent=parent, depth=depth)


def normalize_json(df: DataFrame, source: str, depth: int | None = None) -> DataFrame:
    """Flatten objects only; lists stay cells as JSON text; names joined with ``_``."""
    flat = flatten_json(df, source, sep=".", depth=depth, explode_arrays=False)
    return flat.withColumn("path", F.replace("path", F.lit("."), F.lit("_")))


def find_by_prefix(
    df: DataFrame, source: str, prefix: str, depth: int | None = None
) -> DataFrame:
    """String values that start with a prefix, at any depth; not those directly in a list.

    A record is unfolded only if its text holds the prefix at all, or an escape that may spell it.
    """
    if not isinstance(df.schema[source].dataType, T.VariantType):
        text = as_column(source)
        df = df.filter(F.contains(text, F.lit(prefix)) | F.contains(text, F.lit("\\")))
    keep = [quoted(name) for name in df.columns if name != source]
    nodes = _opened_levels(df, source, "_", "", depth, True, prefix)
    leaves = _leaves(nodes, keep, "_", depth, True)
    wanted = (F.col("kind") == "str") & ~F.col("in_list") & F.startswith("value", F.lit(prefix))
    return leaves.filter(wanted)


def parse_or_skip(df: DataFrame, source: str) -> DataFrame:
    """Rows whose text is a JSON object or list with at least one leaf."""
    text = F.to_json(_as_variant(df, source))
    # without its keys, a record that holds any scalar has more than brackets and commas
    values = F.regexp_replace(text, JSON_KEY, "")
    return df.filter(text.rlike(r"^[\[{]") & values.rlike("[\"0-9a-z]"))


def distinct_paths(leaves: DataFrame) -> DataFrame:
    """The set of keys of flattened records."""
    return leaves.select("path").distinct()


def top_level_fields(record: Column) -> Column:
    """A flat ``VARIANT`` object as ``map<string,string>``; row-local, nothing is exploded."""
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    return F.transform_values(
        fields,
        lambda _, node: F.when(
            F.schema_of_variant(node).rlike("^(OBJECT|ARRAY)<"), F.to_json(node)
        ).otherwise(scalar_text(node)),
    )


def sorted_keys(df: DataFrame, fields: str) -> list[str]:
    """Sorted union of the keys of a map column: a column list, so it lives on the driver."""
    keys = df.select(F.explode(F.map_keys(fields)).alias("key")).distinct()
    return sorted(row.key for row in keys.collect())


def normalized_keys(df: DataFrame, source: str, depth: int | None = None) -> list[str]:
    """``sorted_keys`` of ``normalize_fields``, from one record of every shape.

    The keys of a record follow from its schema, so only one record per schema is unfolded. What kind
    of scalar a key holds does not matter; schemas with quoted names are compared as they are.
    """
    record = _as_variant(df, source)
    schema = F.schema_of_variant(record)
    plain = F.regexp_replace(schema, SCALAR_TYPE, ": S")
    shape = F.when(F.contains(schema, F.lit("`")), schema).otherwise(plain)
    shapes = df.select(shape.alias("shape"), F.to_json(record).alias("record")).groupBy("shape")
    one_each = shapes.agg(F.first("record").alias("record")).select("record")
    return sorted_keys(normalize_fields(one_each, "record", depth=depth), "fields")


def align_json_records(df: DataFrame, source: str, keys: list[str] | None = None) -> DataFrame:
    """Records as columns: sorted union of keys, null where a record lacks one."""
    others = [quoted(name) for name in df.columns if name != source]
    fields = df.select(*others, top_level_fields(_as_variant(df, source)).alias("_fields"))
    names = sorted_keys(fields, "_fields") if keys is None else keys
    cells = [F.col("_fields").getItem(name).alias(name) for name in names]
    return fields.select(*others, *cells)


def align_frames(frames: list[DataFrame]) -> DataFrame:
    """Frames with different columns as one: sorted union of columns, missing ones null."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return union.select(*[quoted(name) for name in sorted(union.columns)])


def row_to_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A row as one JSON object, null cells included."""
    cells = [F.col(quoted(name)) for name in (columns or df.columns)]
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})
