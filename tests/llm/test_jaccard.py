import random
import re

import numpy as np
import pytest

from formtide.llm.common import mix
from formtide.llm.jaccard import paths, runs_needed, similarity_classes
from tests.llm.cases import awkward_docs, empty_docs


def near_copies(spark, seed=4):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 400)}"
    texts = [[word() for _ in range(rng.randint(20, 120))] for _ in range(40)]
    for base in texts[:12]:
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(copy)
    group = [word() for _ in range(80)]
    for i in range(70):  # one large group of near copies
        texts.append([*group, f"x{i}"])
    texts += [texts[0]] * 5 + [["a", "b"]] * 3 + [[]] * 2
    ids = rng.sample(range(5000), len(texts))
    rows = [(i, " ".join(t)) for i, t in zip(ids, texts)] + [(None, " ".join(texts[0])), (9000, None), (9001, "a  b")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def brute(rows, threshold=0.8, n=5):
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    links = [[] for _ in rows]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and rows[i].doc_id is not None and rows[j].doc_id is not None:
                if len(a & b) / len(a | b) >= threshold:
                    links[i].append(j)
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = [k for k in links[todo.pop()] if k not in seen]
            seen.update(new)
            todo += new
        class_id = min((rows[k].doc_id for k in seen), default=None) if r.doc_id is not None else None
        out.append((r.doc_id, len(links[i]), class_id, r.doc_id is not None and r.doc_id == class_id))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [256, 16])
def test_classes_against_brute_force(spark, limit):
    docs = near_copies(spark)
    got = sorted((tuple(r) for r in similarity_classes(docs, limit=limit, tile=limit).collect()), key=repr)
    expected = brute(docs.collect())
    assert sum(r[1] for r in expected) > 5000
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in expected)
    assert all(a[1] <= b[1] for a, b in zip(got, expected))
    assert [r[0] for r in got] == [r[0] for r in expected]
    assert sum(a[2] == b[2] for a, b in zip(got, expected)) >= 0.99 * len(expected)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    got = sorted((tuple(r) for r in similarity_classes(docs).collect()), key=repr)
    assert got == brute(docs.collect())


def test_empty_table_and_runs(spark):
    assert similarity_classes(empty_docs(spark)).count() == 0
    assert runs_needed(0.8, 1.3, 1, 1e-3) < runs_needed(0.8, 1.3, 3, 1e-3) < 20


def test_contained_pairs_meet_on_the_last_level():
    """Pairs at the threshold of which one set contains the other, in nodes that are split to the end."""
    n, large, small = 6000, 50, 40
    missed = 0
    for seed in range(4):
        tokens = mix(np.arange(1, n * large + 1, dtype=np.uint64) + np.uint64(seed << 40)).reshape(n, large)
        rows = np.repeat(np.arange(n), large)
        runs = runs_needed(0.8, 1.3, 3, 1e-3)
        whole = paths(rows, np.sort(tokens, axis=1).ravel(), n, runs, 3, 1.3)[2]
        part = paths(np.repeat(np.arange(n), small), np.sort(tokens[:, :small], axis=1).ravel(), n, runs, 3, 1.3)[2]
        both = set(zip(*(x.tolist() for x in whole))) & set(zip(*(x.tolist() for x in part)))
        missed += n - len({r for r, _ in both})
    assert missed <= 1.3e-3 * 4 * n
