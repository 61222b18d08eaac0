import numpy as np
import pytest
from pyspark.sql import functions as F

from formtide.llm.language import (
    STRETCH,
    Network,
    gradients,
    learn_languages,
    predict_languages,
    stretches,
)
from formtide.llm.sampling import remainder
from tests.llm.cases import awkward_docs, empty_docs

FOLDER = "/root/testdata/sf0.1"


def plain_gates(x):
    return x / (1 + abs(x))


def plain_run(side, codes):
    """The recurrence, byte by byte and unit by unit."""
    h = side.back.shape[1]
    state, out = [0.0] * h, []
    for code in codes:
        past = [sum(float(side.back[r, k]) * state[k] for k in range(h)) for r in range(3 * h)]
        new = []
        for k in range(h):
            keep = 0.5 * (1 + plain_gates(float(side.byte[k, code]) + past[k]))
            reset = 1 + plain_gates(float(side.byte[h + k, code]) + past[h + k])
            fresh = plain_gates(float(side.byte[2 * h + k, code]) + reset * past[2 * h + k])
            new.append(keep * state[k] + (1 - keep) * fresh)
        state = new
        out.append([sum(float(side.out[c, k]) * state[k] for k in range(h)) for c in range(len(side.out))])
    return np.array(out)


def plain_probabilities(net, data):
    rows = []
    for start in range(0, len(data), STRETCH):
        codes = data[start : start + STRETCH]
        scores = plain_run(net.forth, codes) + plain_run(net.back, codes[::-1])[::-1] + net.bias.T
        likely = np.exp(scores - scores.max(axis=1, keepdims=True))
        rows.append(likely / likely.sum(axis=1, keepdims=True))
    return np.concatenate(rows).T if rows else np.zeros((len(net.labels), 0))


def test_every_position_as_by_the_plain_recurrence():
    net = Network.random(["a", "b", "c"], 5, 1)
    texts = [b"", b"x", bytes(range(256)) * 2, b"abc" * 100, b""]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    likely, best = net.probabilities(data, offsets)
    plain = np.concatenate([plain_probabilities(net, np.frombuffer(t, np.uint8)) for t in texts], axis=1)
    assert np.abs(likely - plain).max() < 1e-4
    assert (best == likely.argmax(axis=0)).all()


def test_stretches_cover_every_byte_once():
    starts, lengths = stretches(np.array([0, 0, 1, 130, 130 + 2 * STRETCH]))
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(starts, lengths)])
    assert sorted(covered) == list(range(130 + 2 * STRETCH)) and lengths.max() <= STRETCH


def test_gradients_against_differences():
    net = Network.random(["a", "b", "c"], 4, 1)
    rng = np.random.RandomState(0)
    codes, label = rng.randint(0, 256, (5, 9)), np.array([0, 1, 2, 1, 0])
    weights = [*net.forth.weights, *net.back.weights, net.bias]
    for w, g in zip(weights, gradients(net, codes, label)[1]):
        for cell in np.argsort(-np.abs(g).ravel())[:4]:
            i = np.unravel_index(cell, g.shape)
            before, ends = w[i], []
            for step in (0.01, -0.01):
                w[i] = before + np.float32(step)
                ends.append(gradients(net, codes, label)[0])
            w[i] = before
            assert abs((ends[0] - ends[1]) / 0.02 - g[i]) < 1e-3


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = remainder("doc_id", 5) == 0
    return docs, held, learn_languages(docs, held)


def test_held_out_accuracy(learned):
    docs, held, model = learned
    rows = predict_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    ok = rows.filter(held).agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.min("score"), F.max("score")).first()
    assert ok[0] >= 0.995 and ok[1] >= 0 and ok[2] <= 1


def test_awkward_rows(spark, learned):
    docs = awkward_docs(spark)
    rows = predict_languages(docs, learned[2], with_spans=True).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.dropDuplicates(["doc_id"]).collect() if r.doc_id != 3}
    plain = {}
    for r in rows:
        assert 0 <= r.score <= 1 and r.n_agree <= r.n_bytes
        assert sum(s.end - s.start for s in r.spans) == r.n_bytes
        assert [s.start for s in r.spans] == [0, *[s.end for s in r.spans]][: len(r.spans)]
        text = texts.get(r.doc_id)
        if r.doc_id in texts:
            letters = any(c.isalpha() for c in text or "")
            assert (r.lang_pred == "und") == (not letters)
            assert r.n_bytes == len((text or "").encode())
            if letters:
                assert r.n_agree == sum(s.end - s.start for s in r.spans if s.lang == r.lang_pred)
                # equal texts have equal results
                assert plain.setdefault(text, (r.lang_pred, round(r.score, 4))) == (r.lang_pred, round(r.score, 4))


def test_spans_and_score_of_one_text(spark, learned):
    model = learned[2]
    text = "Et le chat de la maison. " * 9
    row = predict_languages(spark.createDataFrame([(1, text)], "doc_id long, text string"), model, True).first()
    likely = plain_probabilities(model, np.frombuffer(text.encode(), np.uint8))
    best = likely.argmax(axis=0)
    assert [model.labels[b] for b in best] == [s.lang for s in row.spans for _ in range(s.start, s.end)]
    assert row.lang_pred == model.labels[likely.mean(axis=1).argmax()]
    assert abs(row.score - likely.mean(axis=1).max()) < 1e-3


def test_without_labels_and_without_rows(spark, learned):
    docs = awkward_docs(spark)
    none = learn_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert none is None
    rows = predict_languages(docs, none, with_spans=True)
    assert {(r.lang_pred, r.score) for r in rows.collect()} == {("und", 0.0)} and rows.count() == docs.count()
    assert learn_languages(empty_docs(spark).withColumn("lang", F.lit("en"))) is None
    assert predict_languages(empty_docs(spark), learned[2]).count() == 0


def test_held_out_rows_and_other_columns_are_not_read(spark):
    rows = [(i, ("the and of " if i % 2 else "der und die ") * 20, "en" if i % 2 else "de", "s") for i in range(40)]
    wrong = [(i + 1000, t, "en" if lang == "de" else "de", "s") for i, t, lang, _ in rows]
    docs = spark.createDataFrame(rows + wrong, "doc_id long, text string, lang string, source string")
    model = learn_languages(docs, F.col("doc_id") >= 1000, texts=40, epochs=20)
    found = predict_languages(docs.drop("lang", "source"), model).filter("doc_id < 1000").collect()
    assert all(r.lang_pred == ("en" if r.doc_id % 2 else "de") for r in found)
