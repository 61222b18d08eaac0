import numpy as np
import pytest

from formtide.llm.graph import components
from formtide.llm.neighbours import near_duplicates, top_k
from formtide.llm.queries import ORACLES, QUERIES
from tests.compare import compare

SCHEMA = "vec_id long, embedding array<float>, label int, v int, rep int, pivot int, times int"


def awkward_vectors(spark, n=400, seed=3):
    rng = np.random.RandomState(seed)
    x = rng.normal(size=(n, 16)).astype(np.float32)
    x[200:260] = x[:60] + rng.normal(scale=0.05, size=(60, 16))  # near copies
    x[260:300] = x[7]  # ties
    rows = [(i, [float(c) for c in v], i % 3 if i % 11 else 1, 0, 0, 0, 0) for i, v in enumerate(x)]
    rows += [(900, None, 1, 0, 0, 0, 0), (901, [0.0] * 16, 1, 0, 0, 0, 0), (902, [None] * 16, 1, 0, 0, 0, 0)]
    rows += [(950, [float("nan")] * 16, 1, 0, 0, 0, 0), (904, [float("inf")] * 16, 1, 0, 0, 0, 0)]
    rows += [(905, [float(c) for c in x[7]], None, 0, 0, 0, 0), (None, [float(c) for c in x[7]], 1, 0, 0, 0, 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def linked(rows, threshold):
    """Brute force: links and components."""
    def fit(r):
        v = r.embedding
        return r.vec_id is not None and r.label is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)

    good = [r for r in rows if fit(r)]
    x = np.array([r.embedding for r in good], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r.label for r in good])
    near = (x @ x.T >= threshold) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    root = np.arange(len(good))
    ids = np.array([r.vec_id for r in good])
    comp = ids.copy()
    for _ in root:
        new = np.array([min([comp[i], *comp[near[i]]]) for i in range(len(good))])
        if (new == comp).all():
            break
        comp = new
    return {int(i): (int(n), int(c)) for i, n, c in zip(ids, near.sum(1), comp)}


@pytest.mark.parametrize("limit", [1024, 20])
def test_near_duplicates_against_brute_force(spark, limit):
    vectors = awkward_vectors(spark)
    rows = vectors.collect()
    got = near_duplicates(vectors, limit=limit, prefix=6, shared=1).collect()
    assert len(got) == len(rows)
    expected = linked(rows, 0.93)
    total = sum(n for n, _ in expected.values())
    found = {r.vec_id: r for r in got}
    assert all(found[i].n_links <= n for i, (n, _) in expected.items())
    assert sum(r.n_links for r in got) >= 0.97 * total
    same = sum(found[i].component_id == c for i, (_, c) in expected.items())
    assert same >= 0.97 * len(expected)
    for i in (900, 901, 902, 950, 904, 905):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert (found[None].n_links, found[None].component_id, found[None].kept) == (0, None, False)


def test_recall_on_the_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    expected = linked(vectors.collect(), 0.93)
    got = {r.vec_id: r for r in near_duplicates(vectors).collect()}
    total = sum(n for n, _ in expected.values())
    assert sum(r.n_links for r in got.values()) >= 0.97 * total
    assert all(got[i].n_links <= n for i, (n, _) in expected.items())


def test_top_k_against_brute_force(spark):
    vectors = awkward_vectors(spark)
    got = top_k(vectors, lambda c: c % 10 == 0, n_pivots=8, block_rows=30, query_rows=16).collect()
    good = [(r.vec_id, np.floor(256.0 * np.array(r.embedding, float)).astype(int)) for r in vectors.collect()
            if r.vec_id is not None and r.embedding and all(c is not None and np.isfinite(c) for c in r.embedding)]
    expected = set()
    for q, x in good:
        if q % 10 == 0:
            best = sorted((-int(x @ y), i) for i, y in good if i != q)[:5]
            expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(empty).count() == 0
    assert top_k(empty, lambda c: c % 50 == 0).count() == 0


def test_query_equals_its_sql(spark):
    assert compare(spark, "/root/testdata/sf0.001", QUERIES["op8_pivot_distances"], ORACLES["op8_pivot_distances"])[0] is None


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 60), (61, 100), (7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 60, 60: 60, 61: 60}


@pytest.mark.parametrize("share, cosine", [(0.34, 0.95), (0.5, 0.95), (0.5, 0.997), (1.0, 0.95)])
def test_recall_with_one_large_group(spark, share, cosine):
    rng = np.random.RandomState(6)
    n, dim = 1500, 32
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[700:800] = x[600:700] + 0.15 * x[800:900]  # small groups
    size = int(n * share)
    noise = rng.normal(size=(size, dim)) / np.sqrt(dim)
    center = rng.normal(size=dim)
    x[:size] = center / np.linalg.norm(center) * np.sqrt(cosine) + noise * np.sqrt(1 - cosine)
    rows = [(i, [float(c) for c in v], 1, 0, 0, 0, 0) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    y = np.array([r.embedding for r in vectors.collect()], float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.93
    np.fill_diagonal(near, False)
    got = {r.vec_id: r.n_links for r in near_duplicates(vectors).collect()}
    assert all(got[i] <= k for i, k in enumerate(near.sum(1)))
    assert sum(got.values()) >= 0.97 * near.sum()
