import random

import numpy as np
from pyspark.sql import functions as F

from formtide.llm.linear import Binner, estimate_prior, fit_positive_unlabelled, sigmoid
from formtide.llm.quality import drop_low_quality, learn_quality, remainder, score_quality
from formtide.llm.toxicity import drop_toxic, fit_chain, learn_toxicity, score_toxicity, word_hashes
from tests.llm.cases import awkward_docs, empty_docs

FOLDER = "/root/testdata/sf0.1"


def test_chain_feeds_out_of_fold_probabilities():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    hashes, toxic = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = rng.sample(words, 20) + ([rng.choice(["idiot", "scum"])] if bad else [])
        hashes.append(np.unique(word_hashes(" ".join(text))))
        toxic.append(float(bad))
    chain = fit_chain(hashes, np.array(toxic), {"insult": "idiot", "contempt": "scum"}, 1000)
    assert [len(w) - 3 * len(chain.words) for w in chain.models] == [1, 2, 3, 4]  # intercept and earlier ones
    rows = np.repeat(np.arange(400), [len(h) for h in hashes])
    p = chain.predict(chain.columns(rows, np.concatenate(hashes), 400))
    assert ((p[:, 3] >= 0.5) == (np.array(toxic) == 1)).mean() > 0.99
    assert fit_chain(hashes, np.zeros(400), {}, 10) is None


def test_toxic_documents_are_caught_and_clean_ones_kept(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    learned = labels.filter(remainder("doc_id", 3) > 0)
    scores = score_toxicity(docs, learn_toxicity(docs, learned)).join(labels, "doc_id")
    unseen = scores.filter(remainder("doc_id", 3) == 0).select("rejected", labels.toxic.alias("label"))
    counts = {(r.rejected, r.label): r["count"] for r in unseen.groupBy("rejected", "label").count().collect()}
    assert counts.get((True, 0), 0) <= 0.005 * counts[(False, 0)]
    assert counts.get((False, 1), 0) <= 0.06 * counts[(True, 1)]


def test_quality_of_unseen_documents(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    held = remainder("doc_id", 5) == 0
    scores = score_quality(docs, learn_quality(docs, labels, held, positives=1500, unlabelled=3000))
    unseen = scores.join(labels, "doc_id").filter(held).groupBy("predicted", "quality").count().collect()
    counts = {(r.predicted, r.quality): r["count"] for r in unseen}
    assert counts[(0, 0)] >= 0.75 * (counts[(0, 0)] + counts.get((1, 0), 0))
    assert counts.get((0, 1), 0) <= 0.005 * counts[(1, 1)]


def test_prior_and_risk_on_two_known_classes():
    rng = np.random.RandomState(0)
    good, bad = rng.normal(2, 1, (3000, 2)), rng.normal(-2, 1, (1500, 2))
    unlabelled = np.vstack([good[:1500], bad])
    binner = Binner.at_quantiles(unlabelled)
    p, u = binner.of(good[1500:]), binner.of(unlabelled)
    prior = estimate_prior(p, u, binner.size, 1e-4, 100)
    assert abs(prior - 0.5) < 0.06
    w = fit_positive_unlabelled(p, u, binner.size, prior, 1e-4, 200)
    score = sigmoid(w[:-1][u].sum(1) + w[-1])
    assert (score[:1500] > 0.5).mean() > 0.97 and (score[1500:] < 0.5).mean() > 0.97


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward_docs(spark)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), F.lit(1).alias("quality"))
    labels = labels.unionByName(labels)
    n = docs.count()
    chain, model = learn_toxicity(docs, labels), learn_quality(docs, labels)
    assert score_toxicity(docs, chain).count() == n
    scores = score_quality(docs, model).collect()
    assert len(scores) == n and all(0 <= r.score <= 1 for r in scores)
    assert drop_toxic(docs, chain, threshold=2).exceptAll(docs).count() == 0
    assert drop_low_quality(docs, model, threshold=0).count() == n
    nothing = labels.filter("false")
    assert learn_toxicity(docs, nothing) is None and learn_quality(docs, nothing) is None
    assert score_toxicity(docs, None).filter("rejected").count() == 0
    assert score_quality(docs, None).filter("score = 0.5").count() == n
    empty = empty_docs(spark)
    assert learn_toxicity(empty, labels) is None and score_toxicity(empty, chain).count() == 0
    assert score_quality(empty, model).count() == 0
