"""Bounded samples of rows to fit a model on, and the hand-over of a fitted model."""

from __future__ import annotations

import pickle

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_column: str, divisor: int) -> Column:
    """``crc32(id as text) mod divisor``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % divisor


def first_by_hash(ids: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows (column ``doc_id`` first), those with the smallest hash of their id."""
    return ids.orderBy(F.xxhash64("doc_id"), *ids.columns).limit(n)


def texts_of(docs: DataFrame, chosen: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Whole texts of chosen ids, one row per row of ``chosen``; of a repeated id the least text.

    ``chosen`` has a proven bound, so it is broadcast and the texts of all other rows stay put.
    """
    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    found = narrow.join(F.broadcast(chosen), "doc_id")
    return found.groupBy(*chosen.columns).agg(F.min("text").alias("text"))


def fit_in_one_task(rows: DataFrame, fit):
    """What ``fit(list of Arrow batches)`` makes of a bounded frame in one executor task: arrays only."""

    def run(batches):
        model = fit([b for b in batches if b.num_rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0].model) if found else fit([])
