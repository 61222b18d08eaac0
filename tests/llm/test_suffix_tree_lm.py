import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from formtide.llm.suffix_tree_lm import expanded, from_pieces, in_pieces, numbered, places_in_order, score_texts, squeezed
from tests.llm.cases import awkward_docs, empty_docs


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["\x00end"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def check_base(docs, rows):
    texts = docs.collect()
    c = Counter(t for r in texts if not held(r.doc_id) for t in tokens(r.text))
    n, v = sum(c.values()), len(c)
    expected = []
    for r in texts:
        own = tokens(r.text)
        base = sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own)
        expected.append((r.doc_id, held(r.doc_id), len(own), sum(c[t] > 0 for t in own), n, round(base, 6)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_base_model_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr("formtide.llm.exchange.DOC_BUCKET", 3000)
    docs = awkward_docs(spark)
    rows = score_texts(docs, least_share=0.01).collect()
    check_base(docs, rows)
    assert all(r.score < 0 for r in rows)


def test_tree_beats_the_base_on_unseen_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = score_texts(docs).collect()
    check_base(docs, rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_order_and_numbers_of_hashes():
    rng = np.random.RandomState(3)
    few = rng.randint(0, 50, 1000)
    for limit in (50, 1 << 62):  # with places in 64 bits, and without
        assert (places_in_order(few, limit) == np.argsort(few, kind="stable")).all()
    near = np.array([5, 3, 9, 3, 2**63 + 1, 2**63, 5], np.uint64)  # differ in their last bits
    far = rng.randint(0, 1 << 62, 500).astype(np.uint64)[rng.randint(0, 500, 3000)]
    for keys in (near, far, far[:1], far[:0]):
        words, number = numbered(keys)
        assert (words == np.unique(keys)).all() and (words[number] == keys).all()


def test_squeezed_numbers_come_back():
    for values in (np.arange(5, dtype=np.int64), np.array([np.nan, -1.5], np.float32), np.zeros(0, np.uint8), np.array([2.5])):
        assert np.array_equal(expanded(squeezed(values), values.dtype), values, equal_nan=values.dtype.kind == "f")


def test_scores_of_states_that_are_distributions(spark):
    words = ["a", "b", "c", "d"]
    docs = [(7 * i, "x y a" if i % 2 else "z y b") for i in range(200)] + [(10_000 + i, f"x y {w}") for i, w in enumerate(words)]
    docs = spark.createDataFrame(docs + [(20_000, "x y"), (20_001, "y"), (20_002, "x"), (20_003, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in score_texts(docs, least_count=2, divisor=1 << 30, held=-1).collect()}
    texts = [(tokens(r.text), False) for r in docs.collect()]
    expected, kept = brute_scores(texts, 2, 2)
    assert kept[2] > 0
    assert [rows[r.doc_id].score for r in docs.collect()] == pytest.approx(expected, abs=1e-4)


def test_texts_are_cut_into_words_once(spark):
    scores = score_texts(awkward_docs(spark))
    plan = scores._jdf.queryExecution().executedPlan().toString()
    words = plan.partition("FlatMapCoGroupsInArrow")[2].partition("Exchange")[0]
    assert "Bucketed: true" in words and "piece" in words  # the saved words come first, without a shuffle
    assert not re.search(r"\btext#", plan) and plan.count("Exchange") == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("llm_")]
    assert scores.count() == awkward_docs(spark).count()


def test_state_comes_back_from_its_pieces(monkeypatch):
    monkeypatch.setattr("formtide.llm.suffix_tree_lm.PIECE", 3)
    cells = [b"", b"abc", bytes(range(100)), b"x"]
    table = in_pieces(7, cells)
    assert table.num_rows == 1 + 1 + 34 + 1 and set(table.column("bucket").to_pylist()) == {7}
    assert from_pieces(table.take(np.random.RandomState(1).permutation(table.num_rows))) == cells


def test_empty_table(spark):
    assert score_texts(empty_docs(spark)).count() == 0


def brute_scores(texts, least, depth, evidence=4.0, discount=0.75):
    """Score of every text by a tree in dictionaries; texts are (tokens, held out)."""
    c = Counter(t for own, out in texts if not out for t in own)
    scale = sum(c.values()) + len(c) + 1
    after = defaultdict(Counter)
    for own, out in texts:
        for i in range(0 if out else len(own)):
            for length in range(1, min(depth, i) + 1):
                after[tuple(own[i - length : i])][own[i]] += 1
    kept = {}

    def p(context, t):
        while context and context not in kept:
            context = context[1:]
        if not context:
            return (c[t] + 1) / scale
        n = after[context]
        total, free = sum(n.values()), discount * len(n)
        return (n[t] - min(n[t], discount) + free * p(context[1:], t)) / total

    for length in range(1, depth + 1):
        for context, n in [x for x in after.items() if len(x[0]) == length]:
            total = sum(n.values())
            if total >= least:
                g = 2 * sum(k * math.log(k / total / p(context[1:], t)) for t, k in n.items())
                if g >= evidence * len(n):
                    kept[context] = True
    if len(c) < 20:  # what a state gives all words and one never seen sums to one
        assert all(sum(p(state, t) for t in [*c, "never seen"]) == pytest.approx(1) for state in [(), *kept])
    scores = [sum(math.log10(p(tuple(own[max(0, i - depth) : i]), t)) for i, t in enumerate(own)) for own, _ in texts]
    return scores, Counter(map(len, kept))


@pytest.mark.parametrize("hot", [1e-3, 0.05, 1.0])
def test_rare_words_and_long_contexts_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr("formtide.llm.exchange.DOC_BUCKET", 20000)
    monkeypatch.setattr("formtide.llm.exchange.KEY_BUCKET", 20000)
    rng = random.Random(8)
    phrases = [[f"w{rng.randint(0, 3000)}" for _ in range(4)] for _ in range(1500)]  # no word has a share of 0.1 %
    rows = [(i, " ".join(w for _ in range(20) for w in [*rng.choice(phrases), "of"])) for i in range(300)]
    rows += [(None, "of of " + rows[0][1]), (900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = [(tokens(t), held(i)) for i, t in rows]
    expected, kept = brute_scores(texts, 3, 3)
    assert kept[1] > 1000 and kept[3] > 100  # more than a thousand contexts
    got = {r.doc_id: r for r in score_texts(docs, least_count=3, depth=3, hot=hot).collect()}
    assert len(got) == len(rows)
    for (i, _), score in zip(rows, expected):
        assert got[i].score == pytest.approx(score, abs=1e-3, rel=1e-5)
