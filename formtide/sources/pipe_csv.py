"""Pipe-separated text tables. Layers hand over Parquet; these are imports and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from formtide.functions.columns import quoted
from formtide.functions.text import (
    fix_texts,
    missing_to_null,
    windows_1252_text,
)

CORRUPT = "_corrupt_record"


def read_pipe_csv(
    spark: SparkSession,
    path: str,
    charset: str = "windows-1252",
    repair: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """Pipe-separated table with a header, every column text, encodings repaired.

    Cells that a text table reader takes as missing become null. ``multiline`` allows line
    breaks inside quotes, at the price of one task per file.
    """
    latin = charset.lower() in ("windows-1252", "cp1252")
    reader = spark.read.options(header=True, sep="|", quote='"', escape='"', multiLine=multiline)
    table = reader.option("encoding", "ISO-8859-1" if latin else charset).csv(path)

    def cell(name: str):
        text = F.col(quoted(name))
        return missing_to_null(windows_1252_text(text) if latin else text).alias(name)

    cells = table.select(*[cell(name) for name in table.columns])
    return fix_texts(cells, cells.columns, decode_first=True) if repair else cells


def write_pipe_csv(df: DataFrame, path: str, quoting: bool = True) -> None:
    """Pipe-separated export with a header, UTF-8.

    Without quoting, separators and backslashes inside values are escaped with a backslash.
    """
    if quoting:
        options = {"sep": "|", "header": True, "quote": '"', "escape": '"', "emptyValue": ""}
        df.write.mode("overwrite").options(**options).csv(path)
        return
    special = F.lit(r"([\\|\n\r])")

    def cell(name: str):
        text = F.regexp_replace(F.col(quoted(name)).cast("string"), special, F.lit(r"\\$1"))
        return F.coalesce(text, F.lit(""))

    line = F.concat_ws("|", *map(cell, df.columns)).alias("|".join(df.columns))
    # one text column named like the header: the writer puts that name on top of every file
    options = {"sep": "\x01", "header": True, "quote": "", "escapeQuotes": False, "emptyValue": ""}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.select(line).write.mode("overwrite").options(**options).csv(path)


def read_silver_export(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Pipe-separated table; rows with too many fields are skipped, short ones padded.

    Types come from the schema; without one they are inferred, which reads the data twice.
    """
    options = {"header": True, "sep": "|", "quote": '"', "escape": '"'}
    reader = spark.read.options(**options)
    if schema is None:
        schema = reader.option("inferSchema", True).csv(path).schema
    fields = [StructField(field.name, field.dataType) for field in schema.fields]
    checked = spark.read.options(
        **options, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False
    ).schema(StructType([*fields, StructField(CORRUPT, StringType())]))
    unquoted = F.regexp_replace(CORRUPT, '"(?:[^"]|"")*+"', "")
    separators = F.length(unquoted) - F.length(F.replace(unquoted, F.lit("|"), F.lit("")))
    # mentioning a field keeps the check valid when a query needs no column but the check's own
    anchor = F.coalesce(F.length(F.col(quoted(fields[0].name)).cast("string")), F.lit(0)) >= 0
    fits = F.col(CORRUPT).isNull() | (separators < len(fields))
    return checked.csv(path).filter(fits & anchor).drop(CORRUPT)
