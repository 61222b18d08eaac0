"""Registration of a query together with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide import configure
from formtide.session import ensure_checkpoint_dir
from formtide.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one scale factor: ``t.orders`` reads ``orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table over at least as many tasks as there are cores, none with much more than its share.

        Each small table is one file, hence one task. A large file is cut by bytes, but its row groups
        stay whole, so some tasks get several and others none; the rows of each task are counted from
        the footers, and rows that lie unevenly are dealt anew.
        """
        table = getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        if table.rdd.getNumPartitions() < cores:
            return table.repartition(cores)
        tasks = table.groupBy(F.spark_partition_id().alias("task")).count()
        load = tasks.agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
        uneven = (load.most or 0) * cores > 1.25 * (load.rows or 0)
        return table.repartition(4 * cores) if uneven else table

    def ranged(self, name: str, *keys: str) -> DataFrame:
        """A table by ranges of its keys, several per core, for writing a folder per key.

        Few tasks share a folder then, and many write at the same time.
        """
        return getattr(self, name).repartitionByRange(4 * self.spark.sparkContext.defaultParallelism, *keys)

    def scratch(self, name: str) -> str:
        """A new location in the shared checkpoint folder, for queries that write and read back."""
        return f"{ensure_checkpoint_dir(self.spark)}/formtide-{uuid.uuid4().hex}/{name}"


def query(sql: str | None = None, name: str | None = None):
    """Register a function of :class:`Tables` under its name, with its oracle."""

    def register(function: Callable[[Tables], DataFrame]):
        key = name or function.__name__
        QUERIES[key] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register
