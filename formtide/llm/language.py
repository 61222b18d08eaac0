"""Language of texts by a bidirectional gated recurrent network over bytes (operator 11).

The network labels every byte of a text with probabilities of the learned languages; a document's
probabilities are their mean over its bytes. It is trained in numpy by backpropagation through time.
Texts are read in stretches of ``STRETCH`` bytes that start from an empty state in both directions, so
the stretches of a block advance together, whatever the lengths of its documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formtide.llm.common import blocks, spans, text_bytes
from formtide.llm.sampling import fit_in_one_task, texts_of

STRETCH = 128
UNDETERMINED = "und"
LETTER = r"\p{L}"
ONE, HALF = np.float32(1), np.float32(0.5)


def squash(x: np.ndarray, spare: np.ndarray) -> None:
    """``x / (1 + |x|)`` in place: the sigmoid of this network, between -1 and 1."""
    np.abs(x, out=spare)
    spare += ONE
    x /= spare


def slope(y: np.ndarray) -> np.ndarray:
    """Derivative of ``squash`` by its value."""
    return np.square(ONE - np.abs(y))


class Direction:
    """One direction: input weights per byte value, recurrent weights, output weights.

    Rows of ``byte`` and ``back`` are keep gate, reset gate and candidate state, ``hidden`` rows each.
    The reset gate counts from 0 to 2; halving it would only double the candidate's weights.
    """

    def __init__(self, byte: np.ndarray, back: np.ndarray, out: np.ndarray):
        self.byte, self.back, self.out = byte, back, out

    @classmethod
    def random(cls, rng, hidden: int, n_labels: int) -> Direction:
        def draw(*shape, width):
            return (rng.normal(size=shape) / np.sqrt(width)).astype(np.float32)

        return cls(
            draw(3 * hidden, 256, width=4), draw(3 * hidden, hidden, width=hidden),
            draw(n_labels, hidden, width=hidden),
        )

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.byte, self.back, self.out]

    def step(self, codes: np.ndarray, state: np.ndarray, gates: np.ndarray, past: np.ndarray, spare: np.ndarray):
        """Advance ``state`` (hidden x texts) by one byte each, in place. Leaves keep gate, reset gate and
        candidate in ``gates`` and the recurrent part in ``past``."""
        h = len(state)
        np.take(self.byte, codes, axis=1, out=gates, mode="clip")
        np.dot(self.back, state, out=past)
        both, fresh = gates[: 2 * h], gates[2 * h :]
        both += past[: 2 * h]
        squash(both, spare)
        keep, reset = gates[:h], gates[h : 2 * h]
        reset += ONE
        fresh += past[2 * h :] * reset
        squash(fresh, spare[:h])
        keep += ONE
        keep *= HALF
        state -= fresh
        state *= keep
        state += fresh


class Network:
    """Both directions and the labels they tell apart."""

    def __init__(self, labels: list[str], forth: Direction, back: Direction, bias: np.ndarray):
        self.labels, self.forth, self.back, self.bias = labels, forth, back, bias

    @classmethod
    def random(cls, labels: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.RandomState(seed)
        sides = [Direction.random(rng, hidden, len(labels)) for _ in range(2)]
        return cls(labels, *sides, np.zeros((len(labels), 1), np.float32))

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Evidence for every label (rows) at every byte (columns) of texts laid end to end."""
        starts, lengths = stretches(offsets)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        scores = np.empty((len(self.labels), len(data)), np.float32)
        scores[:] = self.bias
        hidden = self.forth.back.shape[1]
        alive = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
        for side, first, way in ((self.forth, starts, 1), (self.back, starts + lengths - 1, -1)):
            state = np.zeros((hidden, len(starts)), np.float32)
            for t, n in enumerate(alive):
                if n < state.shape[1]:
                    state = np.ascontiguousarray(state[:, :n])
                if not t or n != gates.shape[1]:
                    gates, past, spare = (np.empty((k * hidden, n), np.float32) for k in (3, 3, 2))
                at = first[:n] + way * t
                side.step(data[at], state, gates, past, spare)
                scores[:, at] += side.out @ state
        return scores

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of every label at every byte, and the index of the likeliest one."""
        scores = self.logits(data, offsets)
        best = scores.argmax(axis=0)
        scores -= scores.max(axis=0)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=0)
        return scores, best


def stretches(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the stretches of at most ``STRETCH`` bytes of all texts."""
    sizes = np.diff(offsets)
    counts = -(-sizes // STRETCH)
    place = spans(counts) * STRETCH
    starts = np.repeat(offsets[:-1], counts) + place
    return starts, np.minimum(STRETCH, np.repeat(sizes, counts) - place)


# -- training -----------------------------------------------------------------------------------


def forward(side: Direction, codes: np.ndarray) -> dict:
    """States over ``codes`` (steps x texts) and what backpropagation needs of every step."""
    steps, n = codes.shape
    hidden = side.back.shape[1]
    kept = {
        "states": np.zeros((steps + 1, hidden, n), np.float32),
        "gates": np.empty((steps, 3 * hidden, n), np.float32),
        "past": np.empty((steps, 3 * hidden, n), np.float32),
    }
    spare = np.empty((2 * hidden, n), np.float32)
    for t in range(steps):
        state = kept["states"][t + 1]
        state[:] = kept["states"][t]
        side.step(codes[t], state, kept["gates"][t], kept["past"][t], spare)
    return kept


def backward(side: Direction, codes: np.ndarray, kept: dict, slopes: np.ndarray) -> list[np.ndarray]:
    """Gradients of the weights for ``slopes`` (steps x labels x texts) of the loss by the output."""
    steps, n = codes.shape
    hidden = side.back.shape[1]
    inputs = np.empty((steps, 3 * hidden, n), np.float32)
    d_back = np.zeros_like(side.back)
    d_state = np.zeros((hidden, n), np.float32)
    for t in range(steps - 1, -1, -1):
        before = kept["states"][t]
        keep, reset, fresh = np.split(kept["gates"][t], 3)
        d_state = d_state + side.out.T @ slopes[t]
        d_fresh = d_state * (ONE - keep) * slope(fresh)
        d_keep = d_state * (before - fresh) * HALF * slope(2 * keep - ONE)
        d_reset = d_fresh * kept["past"][t][2 * hidden :] * slope(reset - ONE)
        inputs[t] = np.concatenate((d_keep, d_reset, d_fresh))
        d_past = np.concatenate((d_keep, d_reset, d_fresh * reset))
        d_back += d_past @ before.T
        d_state = d_state * keep + side.back.T @ d_past
    flat = codes.ravel()
    d_byte = np.stack([np.bincount(flat, inputs[:, k].ravel(), 256) for k in range(3 * hidden)])
    d_out = np.einsum("tcn,thn->ch", slopes, kept["states"][1:], optimize=True)
    return [d_byte.astype(np.float32), d_back, d_out]


def gradients(net: Network, codes: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all bytes of stretches of one length (texts x bytes), and its gradients."""
    forth = np.ascontiguousarray(codes.T)
    back = np.ascontiguousarray(forth[::-1])
    f, b = forward(net.forth, forth), forward(net.back, back)
    scores = np.einsum("ch,thn->tcn", net.forth.out, f["states"][1:], optimize=True)
    scores += np.einsum("ch,thn->tcn", net.back.out, b["states"][1:], optimize=True)[::-1]
    scores += net.bias
    scores -= scores.max(axis=1, keepdims=True)
    likely = np.exp(scores)
    likely /= likely.sum(axis=1, keepdims=True)
    at = (slice(None), label, np.arange(len(label)))
    loss = -np.log(np.maximum(likely[at], 1e-30)).mean()
    likely[at] -= ONE
    likely /= np.float32(likely.shape[0] * likely.shape[2])
    bias = likely.sum(axis=(0, 2))[:, None]
    return float(loss), [*backward(net.forth, forth, f, likely), *backward(net.back, back, b, likely[::-1]), bias]


def train(codes: np.ndarray, label: np.ndarray, labels: list[str], hidden: int, epochs: int, rate: float,
          batch: int = 128, seed: int = 7) -> Network:
    """Adam over stretches ``codes`` (stretches x ``STRETCH`` bytes); the rate falls to zero."""
    net = Network.random(labels, hidden, seed)
    weights = [*net.forth.weights, *net.back.weights, net.bias]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    rng = np.random.RandomState(seed)
    total, now = epochs * -(-len(codes) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            _, found = gradients(net, codes[chosen], label[chosen])
            now += 1
            fade = rate * (1 - (now - 1) / total)
            for w, g, m, s in zip(weights, found, mean, square):
                m += 0.1 * (g - m)
                s += 0.01 * (np.square(g) - s)
                w -= np.float32(fade) * (m / (1 - 0.9**now)) / (np.sqrt(s / (1 - 0.99**now)) + np.float32(1e-8))
    return net


# -- over tables --------------------------------------------------------------------------------


def learn_languages(docs: DataFrame, held_out: Column | None = None, texts: int = 1200, per_text: int = 16,
                    hidden: int = 12, epochs: int = 3, rate: float = 0.02, id_column: str = "doc_id",
                    text_column: str = "text", lang_column: str = "lang") -> Network | None:
    """Fit on at most ``texts`` labelled texts, the same number for every language, smallest id hash first.

    Of a text, at most ``per_text`` whole stretches spread evenly over its length are used (a shorter text
    is repeated to one stretch). Rows without id, text bytes or language, and rows for which ``held_out``
    (an expression over ``doc_id``) holds, take no part; of a repeated id, each language counts once, with
    the least text of that id. None without any such row.
    """
    held = F.lit(False) if held_out is None else held_out
    known = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(lang_column).cast("string").alias("lang"),
        F.col(text_column).alias("text"),
    )
    known = known.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND octet_length(text) > 0").filter(~held)
    ids = known.select("doc_id", "lang").distinct()
    n_languages = ids.agg(F.count_distinct("lang")).first()[0]
    if not n_languages:
        return None
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = ids.withColumn("place", F.row_number().over(by_hash))
    chosen = chosen.filter(F.col("place") <= max(1, texts // n_languages)).select("doc_id", "lang")

    def cut(batches):
        for batch in batches:
            for block in blocks(batch):
                data, offsets = text_bytes(block.column("text"))
                rows = []
                for lang, a, b in zip(block.column("lang").to_pylist(), offsets[:-1], offsets[1:]):
                    whole = (b - a) // STRETCH
                    at = a + np.unique(np.linspace(0, whole - 1, min(per_text, whole)).astype(int)) * STRETCH
                    pieces = [data[i : i + STRETCH] for i in at] if whole else [np.resize(data[a:b], STRETCH)]
                    rows += [(lang, p.tobytes()) for p in pieces]
                langs, pieces = zip(*rows) if rows else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(pieces, pa.binary())], ["lang", "piece"])

    def fit(batches):
        rows = sorted((lang, piece) for b in batches for lang, piece in zip(*(c.to_pylist() for c in b.columns)))
        if not rows:
            return None
        labels = sorted({lang for lang, _ in rows})
        index = {lang: i for i, lang in enumerate(labels)}
        codes = np.frombuffer(b"".join(p for _, p in rows), np.uint8).reshape(len(rows), STRETCH)
        label = np.array([index[lang] for lang, _ in rows])
        net = train(codes.astype(np.intp), label, labels, hidden, epochs, rate)
        return labels, net.forth.weights, net.back.weights, net.bias

    pieces = texts_of(known, chosen, "doc_id", "text").mapInArrow(cut, "lang string, piece binary")
    state = fit_in_one_task(pieces, fit)
    return state and Network(state[0], Direction(*state[1]), Direction(*state[2]), state[3])


def language_rows(block: pa.RecordBatch, model: Network) -> tuple:
    """Of every text: index of the language, its probability, number of bytes, bytes that say the same."""
    data, offsets = text_bytes(block.column("text"))
    sizes = np.diff(offsets)
    n = len(sizes)
    likely, best = model.probabilities(data, offsets)
    full = np.flatnonzero(sizes)
    mean = np.zeros((len(model.labels), n))
    agree = np.zeros((len(model.labels), n), np.int64)
    if len(full):
        at = offsets[:-1][full]
        mean[:, full] = np.add.reduceat(likely, at, axis=1, dtype=np.float64) / sizes[full]
        for k in range(len(model.labels)):
            agree[k, full] = np.add.reduceat(best == k, at, dtype=np.int64)
    chosen = mean.argmax(axis=0)
    every = np.arange(n)
    return chosen, np.minimum(mean[chosen, every], 1.0), sizes, agree[chosen, every], best, offsets


def predict_languages(docs: DataFrame, model: Network | None, with_spans: bool = False,
                      id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, n_bytes, n_agree`` for every row, null ids and repeated rows included.

    ``score`` is the mean probability of the predicted language over all bytes, ``n_agree`` the bytes for
    which it is the likeliest one. A null text, or one without a letter, is ``und`` with score 0; so is
    every text without a model. ``with_spans`` adds the labels of all positions as runs
    ``struct<start, end, lang>`` of byte offsets.
    """
    kinds = {"doc_id": "long", "lang_pred": "string", "score": "double", "n_bytes": "long", "n_agree": "long"}
    if with_spans:
        kinds["spans"] = "array<struct<start: long, end: long, lang: string>>"

    def runs(best: np.ndarray, offsets: np.ndarray) -> list:
        out = []
        for a, b in zip(offsets[:-1], offsets[1:]):
            cut = np.flatnonzero(np.diff(best[a:b])) + 1
            edges = [0, *cut.tolist(), int(b - a)] if b > a else []
            out.append([{"start": s, "end": e, "lang": model.labels[best[a + s]]} for s, e in zip(edges, edges[1:])])
        return out

    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                n = block.num_rows
                if model:
                    chosen, score, sizes, agree, best, offsets = language_rows(block, model)
                else:
                    sizes = np.diff(text_bytes(block.column("text"))[1])
                    chosen, score, agree = np.zeros(n, int), np.zeros(n), np.zeros(n, int)
                known = block.column("lettered").to_numpy(zero_copy_only=False) & (model is not None)
                names = [model.labels[c] if k else UNDETERMINED for c, k in zip(chosen, known)]
                columns = [
                    block.column("doc_id"), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)),
                    pa.array(sizes.astype(np.int64)), pa.array(np.where(known, agree, 0)),
                ]
                if with_spans:
                    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
                    columns.append(pa.array(runs(best, offsets) if model else [[] for _ in range(n)], kind))
                yield pa.RecordBatch.from_arrays(columns, list(kinds))

    text = F.col(text_column)
    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), text.alias("text"),
        F.coalesce(text.rlike(LETTER), F.lit(False)).alias("lettered"),
    )
    return narrow.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in kinds.items()))
