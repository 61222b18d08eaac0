import hashlib
import random
import re

import numpy as np
import pytest

from formtide.llm import cover_dedup, suffix_dedup
from tests.llm.cases import awkward_docs, empty_docs


def shared_passages(spark, seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "größe", "the", "of"]
    passage = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(6)]
    texts = []
    for _ in range(50):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        parts += [rng.choice(passage)[rng.randint(0, 20) :] for _ in range(2)]
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    texts += ["a" * 500, "a" * 300, "b a" * 100, texts[3], texts[3] + "!", "", "x " * 60, "y z " * 40 + "x " * 30]
    ids = rng.sample(range(1000), len(texts))
    rows = [(i, t) for i, t in zip(ids, texts)] + [(None, texts[3]), (2000, None), (ids[0], texts[5])]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def brute_words(rows, width):
    """Rows that share an id do not see each other."""
    docs = [(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows]
    first = {}
    for doc, w in docs:
        for i in range(len(w) - width + 1):
            if doc is not None:
                key = tuple(w[i : i + width])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, w in docs:
        gone, seen = set(), set()
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            if key in seen or (doc is not None and first[key] < doc):
                gone.update(range(i, i + width))
            seen.add(key)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def brute_bytes(rows, width):
    docs = [(r.doc_id, (r.text or "").encode()) for r in rows]
    first = {}
    for doc, b in docs:
        for i in range(len(b) - width + 1):
            if doc is not None:
                first[b[i : i + width]] = min(first.get(b[i : i + width], doc), doc)
    out = []
    for doc, b in docs:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if doc is not None and first[b[i : i + width]] < doc:
                gone[i : i + width] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("make", [shared_passages, awkward_docs])
def test_words_against_brute_force(spark, make, monkeypatch):
    docs = make(spark)
    expected = plain(brute_words(docs.collect(), 20))
    assert sum(r[2] for r in expected) > 100
    assert plain(cover_dedup.remove_repeats(docs).collect()) == expected
    monkeypatch.setattr("formtide.llm.exchange.DOC_BUCKET", 3000)
    monkeypatch.setattr("formtide.llm.exchange.KEY_BUCKET", 3000)
    for width, period in ((20, 7), (9, 3)):
        got = plain(cover_dedup.remove_repeats(docs, width, period).collect())
        assert got == plain(brute_words(docs.collect(), width))


@pytest.mark.parametrize("make", [shared_passages, awkward_docs])
def test_bytes_against_brute_force(spark, make, monkeypatch):
    docs = make(spark)
    expected = plain(brute_bytes(docs.collect(), 50))
    assert sum(r[2] for r in expected) > 100
    assert plain(suffix_dedup.remove_repeats(docs).collect()) == expected
    monkeypatch.setattr("formtide.llm.exchange.DOC_BUCKET", 3000)
    monkeypatch.setattr("formtide.llm.exchange.KEY_BUCKET", 3000)
    got = plain(suffix_dedup.remove_repeats(docs, 30, 8).collect())
    assert got == plain(brute_bytes(docs.collect(), 30))


def test_text_that_is_left(spark):
    docs = shared_passages(spark)
    for run in (cover_dedup.remove_repeats, suffix_dedup.remove_repeats):
        for r in run(docs, with_text=True).collect():
            assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 or "�" in r.kept or "é" in r.kept or "ö" in r.kept


def test_empty_table(spark):
    assert cover_dedup.remove_repeats(empty_docs(spark)).count() == 0
    assert suffix_dedup.remove_repeats(empty_docs(spark)).count() == 0


def test_family_merges_geometrically():
    family = suffix_dedup.Family()
    rng = np.random.RandomState(1)
    for i in range(40):
        family.add(rng.randint(0, 1 << 40, 100).astype(np.uint64), rng.randint(0, 9, 100).astype(np.uint64), np.full(100, i))
    assert len(family.levels) <= 7 and sum(len(k) for k, _, _ in family.levels) == 4000
