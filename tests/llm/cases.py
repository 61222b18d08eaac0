"""Small tables with every awkward case: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start long, key long, n long"
EMPTY = "doc_id long, text string"


def awkward_docs(spark, seed=5, n=60, words=40):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "größe", "Ça", "x", "idiot", "lorem", "ipsum,", "a", "　wide", "end."]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, words))) for _ in range(n)]
    texts = base + base[: n // 3]  # ties
    texts += ["", " ", "\n\t ", None, "x" * 3000, "two  spaces   three\n\n\nlines   end <|endoftext|> it's 12's"]
    texts += ["long " + " ".join(rng.choice(vocabulary) for _ in range(20000))]
    rows = [(i, t, None if i % 7 else "en", "s", i, i, 1, 2) for i, t in enumerate(texts)]
    rows += [(3, "repeated id", None, None, None, None, None, None)] * 2  # repeated rows
    rows += [(None, "no id at all", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], EMPTY)
