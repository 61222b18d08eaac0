"""Features of texts and linear models over them; plain numpy on arrays that one task holds."""

from __future__ import annotations

import numpy as np

from formtide.llm.common import LOWER, Hasher, words_of

# Letters, digits and all bytes beyond ASCII make up a word of the bag; the rest separates.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
# Byte classes of the style features: every ASCII mark for itself, then whole ranges.
BYTE_CLASS = np.zeros(256, np.int64)
MARKS = [b for b in range(33, 127) if not LETTERS[b]]
BYTE_CLASS[MARKS] = np.arange(1, len(MARKS) + 1)
for _k, _range in enumerate(
    (range(48, 58), range(65, 91), range(97, 123), range(128, 256), [10], [32], [9, 11, 12, 13])
):
    BYTE_CLASS[[*_range]] = len(MARKS) + 1 + _k
N_CLASSES = int(BYTE_CLASS.max()) + 1
UPPER = np.zeros(256, bool)
UPPER[65:91] = True


def bag_of_words(data: np.ndarray, offsets: np.ndarray, hasher: Hasher):
    """Row, start and end of every lower-case word of letters; ``hasher`` then holds the text."""
    letters = np.where(LETTERS[data], LOWER[data], np.uint8(32))
    starts, ends, rows = words_of(letters, offsets)
    hasher.load(letters)
    return rows, starts, ends


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Sparse:
    """Rows of a 0/1 matrix as the columns that are set."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int]):
        self.rows, self.columns, self.shape = rows, columns, shape

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.columns], self.shape[0])

    def transposed_times(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, v[self.rows], self.shape[1])

    def part(self, keep: np.ndarray) -> Sparse:
        number = np.cumsum(keep) - 1
        own = keep[self.rows]
        return Sparse(number[self.rows[own]], self.columns[own], (int(keep.sum()), self.shape[1]))


def descend(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    """Adam from zero over the whole sample; deterministic."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def fit_logistic(x: Sparse, dense: np.ndarray, y: np.ndarray, l2: float, steps: int) -> np.ndarray:
    """Weights of the columns, of the dense inputs, and the intercept.

    A column enters scaled by the log-ratio of its shares among positives and negatives, so that what
    both hold alike stays out. Accelerated gradient steps of a length that the largest eigenvalue bounds.
    """
    n, d, e = len(y), x.shape[1], dense.shape[1]
    held = [np.bincount(x.columns, flags[x.rows], d) for flags in (y, 1 - y)]
    ratio = np.log((held[0] + 1) / (y.sum() + 2)) - np.log((held[1] + 1) / (n - y.sum() + 2))
    forward = lambda w: x.times(w[:d] * ratio) + dense @ w[d : d + e] + w[-1]
    back = lambda g: np.concatenate((x.transposed_times(g) * ratio, dense.T @ g, [g.sum()]))
    probe = np.ones(d + e + 1)
    for _ in range(8):
        probe = back(forward(probe / np.linalg.norm(probe)))
    step = 1 / (0.3 * np.linalg.norm(probe) / n + l2)
    w = before = np.zeros(d + e + 1)
    for t in range(1, steps + 1):
        ahead = w + (t - 1) / (t + 2) * (w - before)
        g = back(sigmoid(forward(ahead)) - y) / n + l2 * np.append(ahead[:-1], 0)
        before, w = w, ahead - step * g
    return np.concatenate((w[:d] * ratio, w[d:]))


def style(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> np.ndarray:
    """Language-independent measures of form, one row per text; an empty text has zeros."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n), sizes)
    length = np.maximum(sizes, 1)[:, None]
    counts = np.bincount(row * N_CLASSES + BYTE_CLASS[data], minlength=n * N_CLASSES).reshape(n, -1)
    starts, ends, rows = words_of(data, offsets)
    words = np.bincount(rows, minlength=n)
    some = np.maximum(words, 1)
    hasher.load(data)
    hashes = hasher.of(starts, ends)
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(r)))
    top = np.zeros(n)
    np.maximum.at(top, r[new], runs)
    distinct = np.bincount(r[new], minlength=n)
    lengths = ends - starts
    upper = np.concatenate(([0], np.cumsum(UPPER[data])))
    uppers = upper[ends] - upper[starts]
    marked = ~LETTERS[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    share = lambda flags: np.bincount(rows, flags, minlength=n) / some
    lines = counts[:, BYTE_CLASS[10]] + 1
    mean_length = np.bincount(rows, lengths, minlength=n) / some
    own = [
        np.log1p(sizes), np.log1p(words), mean_length,
        np.sqrt(np.maximum(0, np.bincount(rows, lengths.astype(float) ** 2, minlength=n) / some - mean_length**2)),
        share(lengths == 1), share(lengths > 15), share(uppers == lengths), share(uppers > 0), share(marked),
        share(again),        distinct / some, distinct / np.sqrt(some), top / some, words / lines,
    ]
    return np.column_stack([counts / length, *own])


class Binner:
    """One-hot bins at quantiles of each measure, so that a linear model can bend."""

    def __init__(self, cuts: list[np.ndarray]):
        self.cuts = cuts
        self.first = np.cumsum([0] + [len(c) + 1 for c in cuts])

    @classmethod
    def at_quantiles(cls, sample: np.ndarray, bins: int = 10) -> Binner:
        cuts = np.quantile(sample, np.linspace(0, 1, bins + 1)[1:-1], axis=0)
        return cls([np.unique(np.append(c, 0.0)) for c in cuts.T])

    def of(self, x: np.ndarray) -> np.ndarray:
        """Column numbers, one per row and measure."""
        return np.column_stack(
            [f + np.searchsorted(c, x[:, j], side="left") for j, (f, c) in enumerate(zip(self.first, self.cuts))]
        )

    @property
    def size(self) -> int:
        return int(self.first[-1])


def fit_positive_unlabelled(
    positive: np.ndarray, unlabelled: np.ndarray, size: int, prior: float, l2: float, steps: int
) -> np.ndarray:
    """Weights per bin and intercept that minimise the non-negative risk with the logistic loss.

    risk = prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]); while the bracket is
    negative, its gradient is followed upwards, as the non-negative estimator asks for.
    """

    def spread(codes, v):
        return np.bincount(codes.ravel(), np.repeat(v, codes.shape[1]), size)

    def gradient(w):
        p = sigmoid(w[:size][positive].sum(1) + w[-1])
        u = sigmoid(w[:size][unlabelled].sum(1) + w[-1])
        near = -prior * (1 - p) / len(p)  # of prior * E_P[loss(+)]
        bracket = -np.log1p(-np.minimum(u, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(p, 1 - 1e-12)).mean()
        sign = 1.0 if bracket >= 0 else -1.0
        gp = near * (sign > 0) - sign * prior * p / len(p)
        gu = sign * u / len(u)
        g = spread(positive, gp) + spread(unlabelled, gu)
        return np.append(g + l2 * w[:-1], gp.sum() + gu.sum())

    return descend(gradient, size + 1, steps, 0.05)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, size: int, l2: float, steps: int) -> float:
    """Share of positives among the unlabelled: best bin of a positive-unlabelled classifier.

    Half of each sample fits it, the other half measures: the least ratio of the shares above a
    threshold, over thresholds that at least a fifth of the positives pass.
    """

    def spread(codes, v):
        return np.bincount(codes.ravel(), np.repeat(v, codes.shape[1]), size)

    p, u = positive[::2], unlabelled[::2]

    def gradient(w):
        gp = -(1 - sigmoid(w[:size][p].sum(1) + w[-1])) / (2 * len(p))
        gu = sigmoid(w[:size][u].sum(1) + w[-1]) / (2 * len(u))
        return np.append(spread(p, gp) + spread(u, gu) + l2 * w[:-1], gp.sum() + gu.sum())

    w = descend(gradient, size + 1, steps, 0.05)
    sp, su = (np.sort(w[:size][x[1::2]].sum(1)) for x in (positive, unlabelled))
    cuts = np.quantile(sp, np.linspace(0, 0.8, 33))
    above_p = 1 - np.searchsorted(sp, cuts) / len(sp)
    above_u = 1 - np.searchsorted(su, cuts) / len(su)
    noise = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(su)) + 1 / np.sqrt(len(sp)))
    best = np.argmin((above_u + noise) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))
