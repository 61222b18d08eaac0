"""Toxicity by a classifier chain (operator 2).

Each category has a logistic model over the words of a text and their beginnings, which stand for
stems in any language, each with whether it occurs once, twice or more. The models stand in a chain:
a later one also reads the probabilities of the earlier ones. While it is fitted, these are
out-of-fold predictions, so that it sees them as they come out for unseen texts. The categories come
from weak labels, what none of them covers is ``other``, and the label ``toxic`` is the last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import Hasher, blocks, text_bytes
from formtide.llm.linear import Sparse, bag_of_words, fit_logistic, sigmoid
from formtide.llm.sampling import first_by_hash, fit_in_one_task, texts_of

# Weak labels: a toxic text that holds one of its words belongs to the category.
CATEGORIES = {
    "insult": "idiot moron stupid loser clown fool dumb jerk dumbass imbecile",
    "contempt": "scum trash worthless pathetic disgusting garbage filth vermin",
}


# Bytes of a longer word that count as a feature of their own, and how often a feature counts.
STEMS = (4, 5, 6, 7)
TIERS = 3


def features_of(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word and stem, by row."""
    rows, starts, ends = bag_of_words(data, offsets, hasher)
    all_rows, hashes = [rows], [hasher.of(starts, ends)]
    for size in STEMS:
        longer = ends - starts > size
        all_rows.append(rows[longer])
        hashes.append(~hasher.of(starts[longer], starts[longer] + size))
    rows = np.concatenate(all_rows)
    order = np.argsort(rows, kind="stable")
    return rows[order], np.concatenate(hashes)[order]


def word_hashes(words: str) -> np.ndarray:
    data, hasher = np.frombuffer(words.encode(), np.uint8), Hasher()
    _, starts, ends = bag_of_words(data, np.array([0, len(data)]), hasher)
    return hasher.of(starts, ends)


class Chain:
    """Sorted hashes of the known words and, per category, their weights."""

    def __init__(self, words: np.ndarray, models: list[np.ndarray]):
        self.words, self.models = words, models

    def columns(self, rows: np.ndarray, hashes: np.ndarray, n: int) -> Sparse:
        size = len(self.words)
        if not size or not len(hashes):
            return Sparse(np.zeros(0, np.int64), np.zeros(0, np.int64), (n, TIERS * size))
        at = np.minimum(np.searchsorted(self.words, hashes), size - 1)
        known = self.words[at] == hashes
        cells, times = np.unique(rows[known] * size + at[known], return_counts=True)
        r, c = np.divmod(cells, size)
        tiers = [(r[times > t], c[times > t] + t * size) for t in range(TIERS)]
        return Sparse(*(np.concatenate(x) for x in zip(*tiers)), (n, TIERS * size))

    def predict(self, x: Sparse) -> np.ndarray:
        """One column of probabilities per category."""
        d, earlier = x.shape[1], np.zeros((x.shape[0], 0))
        for w in self.models:
            p = sigmoid(x.times(w[:d]) + earlier @ w[d:-1] + w[-1])
            earlier = np.column_stack([earlier, p])
        return earlier


def fit_chain(hashes: list[np.ndarray], toxic: np.ndarray, categories: dict[str, str], most_words: int,
              folds: int = 3, l2: float = 1e-4, steps: int = 60) -> Chain | None:
    """Chain over the features that at least three sample texts hold; None without both labels.

    ``hashes`` has the features of each text, repeated as often as they occur.
    """
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    own = [np.unique(h) for h in hashes]
    words, counts = np.unique(np.concatenate(own), return_counts=True)
    words, counts = words[counts >= 3], counts[counts >= 3]
    # those whose share differs most between toxic and clean texts, in standard errors
    bad = np.concatenate([h for h, t in zip(own, toxic) if t])
    at = np.searchsorted(words, bad)
    at = at[(at < len(words)) & (words[np.minimum(at, len(words) - 1)] == bad)] if len(words) else at[:0]
    inside, share = np.bincount(at, minlength=len(words)), toxic.mean()
    contrast = np.abs(inside - counts * share) / np.sqrt(counts * share * (1 - share))
    words = words[np.sort(np.lexsort((words, -contrast))[:most_words])]
    rows = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    chain = Chain(words, [])
    x = chain.columns(rows, np.concatenate(hashes), len(hashes))
    has = lambda names: np.array([np.isin(word_hashes(names), h).any() for h in hashes])
    targets = [toxic * has(names) for names in categories.values()]
    targets += [toxic * (np.sum(targets, axis=0) == 0) if targets else toxic, toxic]
    fold = np.arange(len(toxic)) % folds
    earlier = np.zeros((len(toxic), 0))
    for y in targets:
        chain.models.append(fit_logistic(x, earlier, y, l2, steps))
        unseen = np.zeros(len(toxic))
        for f in range(folds):
            own = fold == f
            w = fit_logistic(x.part(~own), earlier[~own], y[~own], l2, steps)
            unseen[own] = sigmoid(x.part(own).times(w[: x.shape[1]]) + earlier[own] @ w[x.shape[1] : -1] + w[-1])
        earlier = np.column_stack([earlier, unseen])
    return chain


def learn_toxicity(docs: DataFrame, labels: DataFrame, positives: int = 1500, negatives: int = 3000,
                   most_words: int = 1 << 14, id_column: str = "doc_id", text_column: str = "text",
                   categories: dict[str, str] = CATEGORIES) -> Chain | None:
    """Fit the chain on at most ``positives`` toxic and ``negatives`` clean labelled texts.

    The models see the ``most_words`` features that tell the two apart best.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = first_by_hash(known.filter("toxic > 0"), positives).unionByName(
        first_by_hash(known.filter("toxic <= 0"), negatives)
    )

    def features(batches):
        hasher = Hasher()
        for batch in batches:
            for block in blocks(batch):
                data, offsets = text_bytes(block.column("text"))
                rows, hashes = features_of(data, offsets, hasher)
                cuts = np.searchsorted(rows, np.arange(1, block.num_rows))
                words = [h.tobytes() for h in np.split(hashes, cuts)]
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), block.column("toxic").cast(pa.int32()), pa.array(words, pa.binary())],
                    ["doc_id", "toxic", "words"],
                )

    def fit(batches):
        if not batches:
            return None
        table = pa.Table.from_batches(batches).sort_by("doc_id")
        hashes = [np.frombuffer(h, np.uint64) for h in table.column("words").to_pylist()]
        toxic = (table.column("toxic").to_numpy() > 0).astype(float)
        chain = fit_chain(hashes, toxic, categories, most_words)
        return chain and (chain.words, chain.models)

    texts = texts_of(docs, chosen, id_column, text_column)
    state = fit_in_one_task(texts.mapInArrow(features, "doc_id long, toxic int, words binary"), fit)
    return state and Chain(*state)


def _probabilities(column, chain: Chain | None, hasher: Hasher, n_categories: int) -> np.ndarray:
    if chain is None:
        return np.zeros((len(column), n_categories))
    data, offsets = text_bytes(column)
    rows, hashes = features_of(data, offsets, hasher)
    return chain.predict(chain.columns(rows, hashes, len(column)))


def score_toxicity(docs: DataFrame, chain: Chain | None, threshold: float = 0.5, id_column: str = "doc_id",
                   text_column: str = "text", categories: dict[str, str] = CATEGORIES) -> DataFrame:
    """``doc_id``, a probability per category, ``toxic`` and ``rejected`` for every row.

    Null and empty texts hold no word and get the models' base rate; null ids are kept; without a
    chain (no labels of both kinds) all probabilities are 0 and nothing is rejected.
    """
    names = [*categories, "other", "toxic"]
    schema = ", ".join(["doc_id long", *(f"`{n}` double" for n in names), "rejected boolean"])

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            for block in blocks(batch):
                p = _probabilities(block.column("text"), chain, hasher, len(names))
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), *(pa.array(c) for c in p.T), pa.array(p[:, -1] >= threshold)],
                    ["doc_id", *names, "rejected"],
                )

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, chain: Chain | None, threshold: float = 0.5, text_column: str = "text",
               categories: dict[str, str] = CATEGORIES) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns as they are."""

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            for block in blocks(batch, text=text_column):
                p = _probabilities(block.column(text_column), chain, hasher, len(categories) + 2)
                yield block.filter(pa.array(p[:, -1] < threshold))

    return docs.mapInArrow(run, docs.schema)
