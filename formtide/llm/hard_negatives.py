"""Hard negatives of anchors by a secondary-sort shuffle (operator 12).

Anchors meet all rows in blocks: a group of at most ``group`` anchors goes to the tasks that hold the
rows, which stay where they are. A task keeps, of every anchor, the best rows it has seen. What is left
travels under one packed key (anchor, descending score, positive before negative, id); Spark deals the
keys by anchor and sorts them within partitions, and an iterator reads them in order: a positive opens a
window of scores, a negative goes to the windows that are open. It holds the open windows of one anchor.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import materialise, partitions_of, shared_path
from formtide.llm.neighbours import usable

LEAST = np.iinfo(np.int64).min  # stands for "no score"; true scores are held above it
EXACT = 2.0**53
TILE = 1 << 21  # scores computed at once
POSITIVE, NEGATIVE = 0, 1
#: Big-endian, so that the order of the bytes is the order of the fields.
KEY = np.dtype([("anchor", ">u8"), ("below", ">u8"), ("kind", "u1"), ("id", ">u8")])
ROWS = "vec_id long, label long, anchor boolean, vector array<double>"


def unsigned(values: np.ndarray) -> np.ndarray:
    """Signed 64-bit integers as unsigned ones of the same order."""
    return values.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def signed(values: np.ndarray) -> np.ndarray:
    return (values.astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def packed(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> list[bytes]:
    keys = np.empty(len(ids), KEY)
    keys["anchor"], keys["below"] = unsigned(anchor), ~unsigned(score)
    keys["kind"], keys["id"] = kind, unsigned(ids)
    flat = keys.tobytes()
    return [flat[i : i + KEY.itemsize] for i in range(0, len(flat), KEY.itemsize)]


def unpacked(keys: list[bytes]) -> tuple[np.ndarray, ...]:
    cells = np.frombuffer(b"".join(keys), KEY)
    return signed(cells["anchor"]), signed(~cells["below"].astype(np.uint64)), cells["kind"], signed(cells["id"])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered rows as 64-bit integers; beyond that range its ends."""
    bound = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if bound < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in m] for m in (a, b)]
    out = [[sum(x * y for x, y in zip(p, q)) for q in whole[1]] for p in whole[0]]
    return np.array([[min(max(s, LEAST + 1), -LEAST - 1) for s in row] for row in out], np.int64).reshape(len(a), len(b))


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``scores`` the ``k`` highest, ties to the smaller id; ``ids`` are as ``scores`` or, ascending,
    those of the columns.

    ``LEAST`` marks cells that do not count; missing places hold it.
    """
    out, names = np.full((len(scores), k), LEAST), np.zeros((len(scores), k), np.int64)
    if not scores.size:
        return out, names
    reach = min(k, scores.shape[1])
    bar = np.partition(scores, scores.shape[1] - reach, axis=1)[:, scores.shape[1] - reach, None]
    wanted = scores >= bar
    if ids.ndim == 1:
        # of many equal scores only the first k can be among the best
        level = scores == bar
        wanted &= ~level | (np.cumsum(level, axis=1, dtype=np.int32) <= k)
        ids = np.broadcast_to(ids, scores.shape)
    rows, columns = np.nonzero(wanted & (scores > LEAST))
    found, named = scores[rows, columns], ids[rows, columns]
    order = np.lexsort((named, -found, rows))
    rows, found, named = rows[order], found[order], named[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = place < k
    out[rows[keep], place[keep]], names[rows[keep], place[keep]] = found[keep], named[keep]
    return out, names


class Best:
    """The ``k`` best rows so far for each of ``n`` anchors."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.id = k, np.full((n, k), LEAST), np.zeros((n, k), np.int64)

    def add(self, part: slice, scores: np.ndarray, ids: np.ndarray) -> None:
        new, named = best_of(scores, ids, self.k)
        both = np.concatenate((self.score[part], new), axis=1), np.concatenate((self.id[part], named), axis=1)
        self.score[part], self.id[part] = best_of(*both, self.k)

    def rows(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, place = np.nonzero(self.score > LEAST)
        return anchors[at], self.score[at, place], self.id[at, place]


class Anchors:
    """A group of anchors as arrays; vectors of one length each."""

    def __init__(self, rows: pa.Table):
        self.by_length = {length: arrays for length, *arrays in by_length(rows.combine_chunks())}

    def meet(self, batches):
        """Tiles of scores with all rows: length, slice of anchors, scores, ids (ascending), which labels are
        equal, which pairs are an anchor with itself."""
        for batch in batches:
            for length, ids, labels, y in by_length(batch):
                if length not in self.by_length:
                    continue
                names, own, x = self.by_length[length]
                step = max(1, TILE // len(y))
                for a in range(0, len(x), step):
                    part = slice(a, a + step)
                    yield length, part, products(x[part], y), ids, own[part, None] == labels, names[part, None] == ids


def by_length(rows):
    """For every length of vectors in Arrow rows: ids (ascending), labels and vectors as a matrix."""
    vectors = rows.column("vector")
    sizes = np.asarray(pa.compute.list_value_length(vectors))
    ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
    for length in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == length)
        own = own[np.argsort(ids[own], kind="stable")]
        flat = vectors.take(pa.array(own))
        flat = (flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat).flatten()
        yield length, ids[own], labels[own], flat.to_numpy(zero_copy_only=False).reshape(-1, length)


def mine_hard_negatives(vectors: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5,
                        negatives: int = 5, least_share: tuple[int, int] = (80, 100), scale: int = 256,
                        group: int = 8192, id_column: str = "vec_id", vector_column: str = "embedding",
                        label_column: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``; a score is the integer inner product (beyond 64 bits: the end
    of that range). An anchor's positives are its ``positives`` best other rows of its label; for each of
    them the ``negatives`` best rows of other labels with ``least_share`` of its score or more and not above
    it. Best means higher score, then smaller id.

    Rows without id, label or vector, with no component or with a null or non-finite one, take no part. Rows
    that share an id count once, with the least label and vector. Vectors of unequal length have no score
    with one another. Labels are compared as they are; they may be of any type that sorts.
    """
    label = F.col(label_column)
    integral = dict(vectors.dtypes)[label_column] in ("tinyint", "smallint", "int", "bigint")
    key = F.col(id_column).cast("long")
    whole = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    rows = vectors.filter(usable(vector_column) & key.isNotNull() & label.isNotNull()).select(
        key.alias("vec_id"),
        F.struct((label.cast("long") if integral else F.xxhash64(label)).alias("label"), whole.alias("vector")).alias("held"),
    )
    rows = rows.groupBy("vec_id").agg(F.min("held").alias("held"))
    floored = F.transform(F.col("held.vector"), lambda x: floor_of(x, scale))
    anchor = is_anchor(F.col("vec_id")).alias("anchor")
    rows = materialise(rows.select("vec_id", F.col("held.label").alias("label"), anchor, floored.alias("vector")), "vectors")
    spark = rows.sparkSession
    chosen = rows.filter("anchor")
    n_groups = -(-chosen.count() // group)
    number = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n_groups)))
    path = shared_path(spark, "keys")
    for g in range(n_groups):
        # a group has about ``group`` rows: a bounded side, whatever the number of anchors
        anchors = Anchors(chosen.filter(number == g).toArrow())
        kept = materialise(rows.mapInArrow(best_positives(anchors, positives), "key binary"), "positives")
        bounds = windows_of(kept, positives)
        found = rows.mapInArrow(best_negatives(anchors, bounds, positives, negatives, least_share), "key binary")
        kept.union(found).write.mode("append").parquet(path)
    keys = spark.read.schema("key binary").parquet(path) if n_groups else spark.createDataFrame([], "key binary")
    # dealt by the anchor in the key, ordered by the whole key: Spark's secondary sort
    dealt = keys.repartition(partitions_of(spark), F.substring("key", 1, 8)).sortWithinPartitions("key")
    kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return dealt.mapInArrow(emit(positives, negatives, least_share), kinds)


def floor_of(x: Column, scale: int) -> Column:
    """``floor(scale * x)`` as a double; from 2^53 on every double is whole already."""
    scaled = x * F.lit(float(scale))
    return F.when(F.abs(scaled) < F.lit(EXACT), F.floor(scaled).cast("double")).otherwise(scaled)


def key_batch(rows, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(packed(rows[0], rows[1], kind, rows[2]), pa.binary())], ["key"])


def best_positives(anchors: Anchors, k: int):
    """The ``k`` best rows of the anchor's label among the rows of a task."""

    def run(batches):
        best = {length: Best(len(x[0]), k) for length, x in anchors.by_length.items()}
        for length, part, scores, ids, equal, itself in anchors.meet(batches):
            best[length].add(part, np.where(equal & ~itself, scores, LEAST), ids)
        for length, held in best.items():
            yield key_batch(held.rows(anchors.by_length[length][0]), POSITIVE)

    return run


def windows_of(kept: DataFrame, k: int) -> dict[int, list[int]]:
    """Scores of the ``k`` best positives of every anchor of a group: at most ``k`` numbers for each."""
    anchor = F.substring("key", 1, 8)
    dealt = kept.repartition(partitions_of(kept.sparkSession), anchor).sortWithinPartitions("key")

    def first(batches):
        now, seen = None, 0
        for batch in batches:
            keys = batch.column("key").to_pylist()
            out = []
            for key in keys:
                now, seen = (now, seen + 1) if key[:8] == now else (key[:8], 1)
                if seen <= k:
                    out.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["key"])

    bounds: dict[int, list[int]] = {}
    found = [bytes(r.key) for r in dealt.mapInArrow(first, "key binary").collect()]
    if found:
        for anchor_id, score in zip(*(c.tolist() for c in unpacked(found)[:2])):
            bounds.setdefault(anchor_id, []).append(score)
    return bounds


def lower_end(score: int, share: tuple[int, int]) -> int:
    """Least whole number that is ``share`` of a score or more."""
    return -((-share[0] * score) // share[1])


def best_negatives(anchors: Anchors, bounds: dict[int, list[int]], positives: int, k: int, share: tuple[int, int]):
    """The ``k`` best rows of other labels in the window of each positive, among the rows of a task."""
    high, low = {}, {}
    for length, (names, _, _) in anchors.by_length.items():
        own = [(bounds.get(int(a), []) + [LEAST] * positives)[:positives] for a in names]
        high[length] = np.array(own)
        low[length] = np.array([[lower_end(s, share) if s > LEAST else 0 for s in row] for row in own])

    def run(batches):
        best = {length: [Best(len(x[0]), k) for _ in range(positives)] for length, x in anchors.by_length.items()}
        for length, part, scores, ids, equal, _ in anchors.meet(batches):
            other = np.where(equal, LEAST, scores)
            for j, held in enumerate(best[length]):
                inside = (other <= high[length][part, j, None]) & (other >= low[length][part, j, None])
                held.add(part, np.where(inside, other, LEAST), ids)
        for length, windows in best.items():
            rows = [held.rows(anchors.by_length[length][0]) for held in windows]
            # a row may stand in several windows; it travels once
            every = np.unique(np.stack([np.concatenate(c) for c in zip(*rows)]), axis=1)
            yield key_batch(every, NEGATIVE)

    return run


def emit(positives: int, negatives: int, share: tuple[int, int]):
    """Iterator over keys in order: opens the windows of an anchor and hands out negatives."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        now, opened, windows = None, 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            out = []
            for anchor, score, kind, row in zip(*(c.tolist() for c in unpacked(batch.column("key").to_pylist()))):
                if anchor != now:
                    now, opened, windows = anchor, 0, []
                if kind == POSITIVE:
                    if opened < positives:
                        opened += 1
                        windows.append([row, score, lower_end(score, share), 0])
                    continue
                # scores fall, so a window that is too high for this one stays so
                windows = [w for w in windows if w[2] <= score and w[3] < negatives]
                for window in windows:
                    if score <= window[1]:
                        window[3] += 1
                        out.append((anchor, window[0], window[3], row, window[1], score))
            columns = zip(*out) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    return run
