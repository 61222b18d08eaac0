"""Tables of any format Spark can read and write."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from formtide.operators.profile import counted
from formtide.session import ensure_checkpoint_dir


def table_format(uri: str, options: dict | None = None) -> str:
    """Format named in the options, else the extension of the path."""
    if options and "format" in options:
        return options["format"]
    return os.path.splitext(os.path.basename(urlparse(uri).path.rstrip("/")))[1][1:]


def _reader_options(options: dict | None) -> dict:
    return {key: value for key, value in (options or {}).items() if key != "format"}


def read_table(spark: SparkSession, uri: str, options: dict | None = None) -> DataFrame:
    """Load a table; other options go to the reader."""
    if not uri:
        raise ValueError("a table needs a path")
    reader = spark.read.format(table_format(uri, options))
    return reader.options(**_reader_options(options)).load(uri)


def write_table(
    df: DataFrame, uri: str, options: dict | None = None, overwrite: bool = True
) -> None:
    """Save a table; an existing one is replaced, or an error without ``overwrite``."""
    if not uri:
        raise ValueError("a table needs a path")
    writer = df.write.format(table_format(uri, options)).options(**_reader_options(options))
    writer.mode("overwrite" if overwrite else "errorifexists").save(uri)


def convert(
    spark: SparkSession,
    source: str,
    target: str,
    source_options: dict | None = None,
    target_options: dict | None = None,
) -> None:
    """Copy a table into the format of the target path (S3)."""
    write_table(read_table(spark, source, source_options), target, target_options)


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """No rows, given schema."""
    return spark.createDataFrame([], schema)


def read_parquet_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, None when there is none at the path."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a Parquet table, optionally split into one folder per key."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_unless_empty(df: DataFrame, path: str) -> int:
    """Replace a Parquet table and return its rows; a result without rows leaves it as it is.

    The result is computed once, into the shared checkpoint folder, and copied from there.
    """
    spark = df.sparkSession
    staged = f"{ensure_checkpoint_dir(spark)}/formtide-{uuid.uuid4().hex}/staged"
    result, count = counted(df)
    write_parquet(result, staged)
    rows = count.get["rows"]
    if rows:
        write_parquet(spark.read.parquet(staged), path)
    return rows
