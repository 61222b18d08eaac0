import numpy as np
import pytest

from formtide.llm.hard_negatives import (
    LEAST,
    best_of,
    emit,
    key_batch,
    lower_end,
    mine_hard_negatives,
    packed,
    products,
    unpacked,
)
from formtide.llm.queries import ORACLES, QUERIES
from tests.compare import compare

SCHEMA = "vec_id long, embedding array<float>, label int, key int, kind int, score int, anchor int"


def vectors_of(spark, n=500, seed=4):
    """Ties, a vector that a third of the rows share, repeated ids, and rows that take no part."""
    rng = np.random.RandomState(seed)
    x = np.round(rng.normal(size=(n, 6)), 1).astype(np.float32)
    x[n // 3 : 2 * n // 3] = x[5]
    rows = [(int(i) - 20, [float(c) for c in v], int(i) % 4, 0, 0, 0, 0) for i, v in enumerate(x)]
    rows += [(7, [float(c) for c in x[9]], 9, 0, 0, 0, 0)] * 3  # another row of an id, repeated
    rows += [(900, None, 1, 0, 0, 0, 0), (910, [None] * 6, 1, 0, 0, 0, 0), (920, [float("nan")] * 6, 1, 0, 0, 0, 0)]
    rows += [(930, [], 1, 0, 0, 0, 0), (940, [1.0] * 6, None, 0, 0, 0, 0), (None, [1.0] * 6, 1, 0, 0, 0, 0)]
    rows += [(950, [1.0, 2.0], 1, 0, 0, 0, 0), (960, [2.0, 2.0], 1, 0, 0, 0, 0), (961, [2.0, 1.9], 2, 0, 0, 0, 0)]
    rows += [(970, [0.0] * 6, 1, 0, 0, 0, 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def brute_force(rows, is_anchor, positives=5, negatives=5):
    held = {}
    for r in rows:
        v = r.embedding
        if r.vec_id is None or r.label is None or not v or any(c is None or not np.isfinite(c) for c in v):
            continue
        held[r.vec_id] = min(held.get(r.vec_id, (r.label, v)), (r.label, v))
    whole = {i: (label, [int(np.floor(256.0 * c)) for c in v]) for i, (label, v) in held.items()}
    out = set()
    for a, (label, x) in whole.items():
        if not is_anchor(a):
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in whole.items() if i != a and len(x) == len(y)]
        best = sorted((s, i) for s, i, other in scored if other == label)[:positives]
        for s, p in best:
            window = sorted((t, i) for t, i, other in scored if other != label and 80 * -s <= 100 * -t <= 100 * -s)
            out |= {(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(window[:negatives])}
    return out


@pytest.mark.parametrize("group, positives, negatives", [(8192, 5, 5), (7, 5, 5), (30, 2, 9)])
def test_against_brute_force(spark, group, positives, negatives):
    vectors = vectors_of(spark)
    got = mine_hard_negatives(vectors, lambda i: i % 10 == 0, positives, negatives, group=group).collect()
    expected = brute_force(vectors.collect(), lambda i: i % 10 == 0, positives, negatives)
    assert {tuple(r) for r in got} == expected and len(got) == len(expected) and len(got) > 100


def test_labels_of_other_types(spark):
    vectors = vectors_of(spark)
    text = vectors.withColumn("label", vectors.label.cast("string"))
    a, b = (mine_hard_negatives(v, lambda i: i % 50 == 0).collect() for v in (vectors.filter("vec_id <> 7"), text.filter("vec_id <> 7")))
    assert {tuple(r) for r in a} == {tuple(r) for r in b} and a


def test_scores_beyond_doubles(spark):
    big = [(0, [1e7, 1.0], 1, 0, 0, 0, 0), (1, [1e7, 2.0], 1, 0, 0, 0, 0), (2, [1e7, 1.5], 2, 0, 0, 0, 0), (3, [0.9e7, 0.0], 2, 0, 0, 0, 0)]
    vectors = spark.createDataFrame(big, SCHEMA)
    got = {tuple(r) for r in mine_hard_negatives(vectors, lambda i: i == 0).collect()}
    assert got == brute_force(vectors.collect(), lambda i: i == 0) and got
    assert products(np.array([[1e12, 1.0]]), np.array([[1e12, 1.0], [-1e12, 0.0]])).tolist() == [[-LEAST - 1, LEAST + 1]]


def test_no_anchor_and_no_row(spark):
    vectors = vectors_of(spark)
    assert mine_hard_negatives(vectors, lambda i: i > 10_000).count() == 0
    assert mine_hard_negatives(vectors.limit(0), lambda i: i % 2 == 0).count() == 0


def test_keys_sort_by_anchor_then_falling_score_then_kind_then_id():
    rng = np.random.RandomState(1)
    a, s, i = (rng.randint(-3, 3, 500) for _ in range(3))
    s = s * 10**17
    keys = packed(a, s, 0, i) + packed(a, s, 1, i)
    cells = list(zip(*(c.tolist() for c in unpacked(keys))))
    in_order = sorted(range(len(keys)), key=lambda n: keys[n])
    assert [cells[n] for n in in_order] == sorted(cells, key=lambda c: (c[0], -c[1], c[2], c[3]))


def test_the_iterator_needs_no_more_than_the_order():
    """Any split of the sorted keys into batches gives the same rows, and a window closes by score."""
    a = np.array([5, 5, 5, 5, 5, 6, 6])
    positive = key_batch((a[:2], np.array([100, 90]), np.array([1, 2])), 0).column("key").to_pylist()
    negative = key_batch((a[:4], np.array([100, 81, 79, 72]), np.array([7, 8, 9, 10])), 1).column("key").to_pylist()
    keys = sorted(positive + negative)
    import pyarrow as pa

    def rows(cuts):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[x:y], pa.binary())], ["key"]) for x, y in zip([0, *cuts], [*cuts, len(keys)])]
        return [tuple(r.values()) for b in emit(5, 5, (80, 100))(iter(batches)) for r in b.to_pylist()]

    expected = [(5, 1, 1, 7, 100, 100), (5, 1, 2, 8, 100, 81), (5, 2, 1, 8, 90, 81), (5, 2, 2, 9, 90, 79), (5, 2, 3, 10, 90, 72)]
    assert rows([]) == expected and rows([1, 2, 3, 4, 5]) == expected and rows([0, 3]) == expected


def test_best_of_ties():
    scores = np.array([[5, 5, 5, 1, 5], [LEAST] * 5, [1, 2, 3, 4, 5]])
    found, ids = best_of(scores, np.array([2, 3, 5, 7, 11]), 3)
    assert found.tolist() == [[5, 5, 5], [LEAST] * 3, [5, 4, 3]]
    assert ids.tolist() == [[2, 3, 5], [0, 0, 0], [11, 7, 5]]
    assert lower_end(101, (80, 100)) == 81 and lower_end(-101, (80, 100)) == -80


def test_query_equals_its_sql(spark):
    name = "op12_secondary_sort"
    assert compare(spark, "/root/testdata/sf0.01", QUERIES[name], ORACLES[name])[0] is None
