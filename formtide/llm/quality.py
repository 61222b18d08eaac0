"""Quality by positive-unlabelled learning (operator 5).

A linear model over binned measures of a text's form is fitted to trusted positives and unlabelled
texts by the non-negative risk; the share of positives among the unlabelled is estimated first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import Hasher, blocks, text_bytes
from formtide.llm.linear import Binner, estimate_prior, fit_positive_unlabelled, sigmoid, style
from formtide.llm.sampling import first_by_hash, fit_in_one_task, remainder, texts_of


class QualityModel:
    def __init__(self, binner: Binner, weights: np.ndarray, prior: float):
        self.binner, self.weights, self.prior = binner, weights, prior

    def score(self, column, hasher: Hasher) -> np.ndarray:
        data, offsets = text_bytes(column)
        codes = self.binner.of(style(data, offsets, hasher))
        return sigmoid(self.weights[:-1][codes].sum(1) + self.weights[-1])


def learn_quality(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, positives: int = 3000,
                  unlabelled: int = 6000, l2: float = 1e-4, steps: int = 400, id_column: str = "doc_id",
                  text_column: str = "text") -> QualityModel | None:
    """Fit on at most ``positives`` rows of quality 1 and ``unlabelled`` rows of any kind.

    Rows for which ``held_out`` (an expression over ``doc_id``) holds are used for neither. None
    without positives or unlabelled texts.
    """
    held = F.lit(False) if held_out is None else held_out
    good = labels.filter("doc_id IS NOT NULL AND quality = 1")
    good = good.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().filter(~held)
    ids = docs.select(F.col(id_column).cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").filter(~held)
    chosen = (
        first_by_hash(good, positives)
        .withColumn("positive", F.lit(True))
        .unionByName(first_by_hash(ids.distinct(), unlabelled).withColumn("positive", F.lit(False)))
    )

    def features(batches):
        hasher = Hasher()
        for batch in batches:
            for block in blocks(batch):
                x = style(*text_bytes(block.column("text")), hasher)
                cells = pa.array([row.tobytes() for row in x], pa.binary())
                columns = [block.column("doc_id"), block.column("positive"), cells]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "positive", "cells"])

    def fit(batches):
        if not batches:
            return None
        table = pa.Table.from_batches(batches).sort_by("doc_id")
        x = np.stack([np.frombuffer(c) for c in table.column("cells").to_pylist()])
        positive = table.column("positive").to_numpy()
        if positive.all() or not positive.any():
            return None
        binner = Binner.at_quantiles(x[~positive])
        p, u = binner.of(x[positive]), binner.of(x[~positive])
        prior = estimate_prior(p, u, binner.size, l2, steps // 2) if min(len(p), len(u)) > 1 else 0.5
        return binner.cuts, fit_positive_unlabelled(p, u, binner.size, prior, l2, steps), prior

    texts = texts_of(docs, chosen, id_column, text_column)
    state = fit_in_one_task(texts.mapInArrow(features, "doc_id long, positive boolean, cells binary"), fit)
    return state and QualityModel(Binner(state[0]), *state[1:])


def score_quality(docs: DataFrame, model: QualityModel | None, threshold: float = 0.3, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row, null ids and repeated rows included.

    Null counts as the empty text, which is scored like any other. Without a model every score is 0.5.
    """

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            for block in blocks(batch):
                column = block.column("text")
                score = model.score(column, hasher) if model else np.full(len(column), 0.5)
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double, predicted int")


def drop_low_quality(docs: DataFrame, model: QualityModel | None, threshold: float = 0.3,
                     text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with their columns as they are."""

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            for block in blocks(batch, text=text_column):
                column = block.column(text_column)
                keep = model.score(column, hasher) >= threshold if model else np.ones(len(column), bool)
                yield block.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


__all__ = ["QualityModel", "learn_quality", "score_quality", "drop_low_quality", "remainder"]
