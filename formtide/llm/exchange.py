"""Exchange of hashed keys between documents, in packed rows.

Documents send keys to the task of a key's bucket; that task answers each document, by the bucket of
its id, with the keys that were found. Documents then meet their answers in one cogroup. Answers name
content (a hash), never a row or position, so a task that runs again cannot mix them up.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import mix

PRIME = 1_000_003
# Bytes of text per bucket of keys and per bucket of documents.
KEY_BUCKET, DOC_BUCKET = 8 << 20, 4 << 20
SENT = "bucket int, docs binary, keys binary, marks binary"


class Sender:
    """Gathers (document, key, mark) triples and packs them into one row per bucket."""

    def __init__(self, n_buckets: int, by_doc: bool = False, most: int = 1 << 20):
        self.n, self.by_doc, self.most, self.parts, self.size = n_buckets, by_doc, most, [], 0

    def add(self, docs: np.ndarray, keys: np.ndarray, marks: np.ndarray):
        if len(docs):
            self.parts.append((docs, keys, marks))
            self.size += len(docs)
        if self.size >= self.most:
            yield from self.flush()

    def flush(self):
        if not self.parts:
            return
        docs, keys, marks = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.size = [], 0
        if self.by_doc:
            to = (docs % PRIME) % self.n
        else:
            to = (mix(keys) % np.uint64(self.n)).astype(np.int64)
        to = to.astype(np.uint16 if self.n <= 1 << 16 else np.int64)
        order = np.argsort(to, kind="stable")
        buckets, starts = np.unique(to[order], return_index=True)
        cut = lambda a: [x.tobytes() for x in np.split(a[order], starts[1:])]
        packed_marks = cut(marks) if len(marks) else [b""] * len(buckets)
        delta = [np.diff(x, prepend=0).tobytes() for x in np.split(docs[order], starts[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(buckets.astype(np.int32))] + [pa.array(x, pa.binary()) for x in (delta, cut(keys), packed_marks)],
            ["bucket", "docs", "keys", "marks"],
        )


def received(table: pa.Table, key=np.uint64, mark=np.uint8) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The packed rows of a table, one triple of arrays each."""
    columns = (table.column(c).to_pylist() for c in ("docs", "keys", "marks"))
    return [
        (np.cumsum(np.frombuffer(d, np.int64)), np.frombuffer(k, key), np.frombuffer(m, mark))
        for d, k, m in zip(*columns)
    ]


def exchange(sent: DataFrame, answer: Callable, n_doc_buckets: int, key=np.uint64) -> DataFrame:
    """Answers of every key bucket: ``answer(list of triples)`` gives documents, keys and marks."""

    def run(table: pa.Table) -> pa.Table:
        sender = Sender(n_doc_buckets, by_doc=True, most=1 << 62)
        batches = [*sender.add(*answer(received(table, key))), *sender.flush()]
        schema = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("docs", "keys", "marks")])
        return pa.Table.from_batches(batches, schema)

    return sent.groupBy("bucket").applyInArrow(run, SENT)


def owned_elsewhere(batches):
    """Answer for keys that a document with a smaller id holds too: the larger documents hear of it."""
    docs, keys, marks = (np.concatenate(x) for x in zip(*batches))
    order = np.lexsort((docs, keys))
    docs, keys, marks = docs[order], keys[order], marks[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = docs[new][np.cumsum(new) - 1]
    later = docs > first
    return docs[later], keys[later], marks[later]


def with_buckets(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, int, int]:
    """``doc_id, text, bucket`` of all rows, and the numbers of document and key buckets for their bytes."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_column)))).first()[0] or 0
    n_docs, n_keys = 1 + size // DOC_BUCKET, 4 + size // KEY_BUCKET
    doc_id = F.col(id_column).cast("long").alias("doc_id")
    narrow = docs.select(doc_id, F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    own = F.coalesce(F.pmod(F.pmod("doc_id", F.lit(PRIME)), F.lit(n_docs)), F.lit(0)).cast("int")
    return narrow.withColumn("bucket", own), n_docs, n_keys


def join_answers(docs: DataFrame, answers: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run(documents, answers)`` for every bucket of documents; both are Arrow tables."""
    return docs.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(run, schema)


class Heard:
    """Answers of a bucket, for look-ups by document and key."""

    def __init__(self, answers: pa.Table, mark: int | None = None):
        parts = received(answers)
        if mark is not None:
            parts = [(d[m == mark], k[m == mark], m[m == mark]) for d, k, m in parts]
        docs, keys = (np.concatenate(x) for x in list(zip(*parts))[:2]) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        self.cells = np.sort(self.cell(docs, keys))

    @staticmethod
    def cell(docs: np.ndarray, keys: np.ndarray) -> np.ndarray:
        return mix(keys ^ (docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))

    def has(self, docs: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not len(self.cells) or not len(keys):
            return np.zeros(len(keys), bool)
        cells = self.cell(docs, keys)
        at = np.minimum(np.searchsorted(self.cells, cells), len(self.cells) - 1)
        return self.cells[at] == cells


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in a window of ``width`` from one of ``starts``."""
    step = np.zeros(size + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:-1]) > 0
