"""Suffix-array dedup with a logarithmic family of indexes (operator 3).

A match of ``width`` bytes always holds the same anchor: the position whose next ``gram`` bytes hash
least within the window. So a sparse suffix array is enough: per batch of texts, the suffixes at
anchors, sorted by a fingerprint of their first ``gram`` bytes, then of the whole stretch of windows that
share the anchor. Suffixes are dealt to tasks by the first fingerprint. There, batches enter a
logarithmic family: a new array is a level of its own, levels of equal size merge, so each suffix is
merged a logarithmic number of times. A scan of the batches against the levels finds stretches that a
smaller document has in full, and those that share only the anchor; the windows of the latter are
compared one by one in a second exchange.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from formtide.llm.common import Hasher, blocks, materialise, mix, text_bytes
from formtide.llm.exchange import (
    SENT,
    Heard,
    Sender,
    covered,
    exchange,
    join_answers,
    owned_elsewhere,
    with_buckets,
)

FULL, PARTLY = 1, 2
GRAM = 26


class Stretches:
    """Stretches of window starts that share an anchor, for all texts of a block."""

    def __init__(self, block: pa.RecordBatch, hasher: Hasher, width: int, gram: int):
        self.data, self.offsets = text_bytes(block.column("text"))
        self.ids = block.column("doc_id").fill_null(-1).to_numpy()
        known = block.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        n = len(self.data) - width + 1
        self.first = self.last = self.rows = np.zeros(0, np.int64)
        self.key = self.whole = self.windows = np.zeros(0, np.uint64)
        if n < 1:
            return
        hasher.load(self.data)
        at = np.arange(len(self.data) - gram + 1)
        grams = hasher.of(at, at + gram)
        # least hash of every window: high bits order, low bits tell the place, the leftmost wins
        low = np.uint64((1 << max(1, int(len(at)).bit_length())) - 1)
        least = (grams & ~low) | at.astype(np.uint64)
        size, span = 1, width - gram + 1
        while size * 2 <= span:
            least = np.minimum(least[: len(least) - size], least[size:])
            size *= 2
        if size < span:
            least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
        anchor = (least & low).astype(np.int64)
        starts = np.arange(n)
        row = np.repeat(np.arange(len(self.ids)), np.diff(self.offsets))[:n]
        inside = (starts + width <= self.offsets[row + 1]) & known[row]
        starts, anchor, row = starts[inside], anchor[inside], row[inside]
        if not len(starts):
            return
        new = np.ones(len(starts), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(new)
        self.first, self.last = starts[begin], starts[np.append(begin[1:], len(starts)) - 1]
        self.rows = row[begin]
        anchor = anchor[begin]
        self.key = grams[anchor] >> np.uint64(16)
        ends = hasher.of(self.first, self.first + width), hasher.of(self.last, self.last + width)
        lengths = (self.last - self.first).astype(np.uint64)
        # the place of the anchor follows from the stretch, whose two ends overlap
        self.whole = mix(ends[0] + mix(ends[1] + lengths)) >> np.uint64(16)
        self.hasher, self.width = hasher, width

    def both(self) -> np.ndarray:
        return mix(self.key * np.uint64(0x9E3779B97F4A7C15) + self.whole)

    def windows_of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, row and hash of every window of the chosen stretches."""
        sizes = (self.last - self.first + 1)[chosen]
        ends = np.cumsum(sizes)
        starts = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        starts = starts + np.repeat(self.first[chosen], sizes)
        rows = np.repeat(self.rows[chosen], sizes)
        hashes = self.hasher.of(starts, starts + self.width) if len(starts) else np.zeros(0, np.uint64)
        return starts, rows, hashes


class Family:
    """Logarithmic family of sorted suffix arrays: (key, whole, least document)."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    @staticmethod
    def sort(key, whole, docs):
        """One row per suffix fingerprint, with the smallest document that has it."""
        order = np.lexsort((docs, whole, key))
        key, whole, docs = key[order], whole[order], docs[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])
        return key[new], whole[new], docs[new]

    def add(self, key, whole, docs) -> None:
        level = self.sort(key, whole, docs)
        while self.levels and len(self.levels[-1][0]) <= 2 * len(level[0]):
            level = self.sort(*(np.concatenate(x) for x in zip(self.levels.pop(), level)))
        self.levels.append(level)

    def seal(self) -> None:
        """Order every level by its full fingerprint too, once, for the scans."""
        self.sealed = []
        for k, w, d in self.levels:
            cells = mix(k * np.uint64(0x9E3779B97F4A7C15) + w)
            order = np.argsort(cells)
            self.sealed.append((k, cells[order], d[order]))

    def scan(self, key, whole, docs) -> tuple[np.ndarray, np.ndarray]:
        """Of a sorted batch: is the suffix in a smaller document; do others share its first bytes only?"""
        full, variants = np.zeros(len(key), bool), np.zeros(len(key), np.int64)
        both = mix(key * np.uint64(0x9E3779B97F4A7C15) + whole)
        by_cell = np.argsort(both)
        ordered = both[by_cell]
        for k, cells, d in self.sealed:
            at = np.minimum(np.searchsorted(cells, ordered), len(cells) - 1)
            same = cells[at] == ordered
            full[by_cell] |= same & (d[at] < docs[by_cell])
            variants += np.searchsorted(k, key, "right") - np.searchsorted(k, key, "left")
            variants[by_cell] -= same
        return full, variants > 0


def remove_repeats(docs: DataFrame, width: int = 50, gram: int = GRAM, id_column: str = "doc_id",
                   text_column: str = "text", with_text: bool = False, with_input: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, ``input_sha256``) for every row.

    Texts count as UTF-8 bytes. A byte goes if a string of ``width`` bytes over it also starts in a row
    with a smaller id; strings are judged on the input. Null counts as empty. A null id neither finds
    nor is found; rows that share an id do not see each other. ``kept`` loses a character of which a
    byte was removed.
    """
    parted, n_docs, n_keys = with_buckets(docs, id_column, text_column)

    def split(whole: np.ndarray) -> np.ndarray:
        """48 bits as six bytes."""
        return whole.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]

    def send(batches):
        hasher, sender = Hasher(), WideSender(n_keys)
        for batch in batches:
            for block in blocks(batch):
                s = Stretches(block, hasher, width, gram)
                ids = s.ids[s.rows]
                new = np.ones(len(ids), bool)  # a stretch that repeats at once is sent once
                new[1:] = (s.key[1:] != s.key[:-1]) | (s.whole[1:] != s.whole[:-1]) | (ids[1:] != ids[:-1])
                yield from sender.add(ids[new], s.key[new], split(s.whole[new]))
        yield from sender.flush()

    class WideSender(Sender):
        def flush(self):
            for batch in super().flush():
                keys = [split(np.frombuffer(k, np.uint64)).tobytes() for k in batch.column("keys").to_pylist()]
                yield batch.set_column(2, "keys", pa.array(keys, pa.binary()))

    def join48(raw: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(raw) // 6, 8), np.uint8)
        wide[:, :6] = raw.reshape(-1, 6)
        return wide.view("<u8").ravel()

    def answer(table_rows):
        batches = [(d, join48(k), join48(w)) for d, k, w in table_rows]
        family = Family()
        for d, k, w in batches:
            family.add(k, w, d)
        family.seal()
        found = []
        for d, k, w in batches:
            order = np.argsort(k)  # in step with the levels
            d, k, w = d[order], k[order], w[order]
            full, near = family.scan(k, w, d)
            told = full | near
            both = mix(k[told] * np.uint64(0x9E3779B97F4A7C15) + w[told])
            found.append((d[told], both, np.where(full[told], FULL, PARTLY).astype(np.uint8)))
        return tuple(np.concatenate(x) for x in zip(*found))

    suffixes = parted.select("doc_id", "text").mapInArrow(send, SENT)
    answers = materialise(exchange(suffixes, answer, n_docs, key=np.uint8), "stretches")

    def send_windows(texts: pa.Table, heard: pa.Table) -> pa.Table:
        hasher, sender, partly, out = Hasher(), Sender(n_keys), Heard(heard, PARTLY), []
        for batch in texts.combine_chunks().to_batches():
            for block in blocks(batch):
                s = Stretches(block, hasher, width, gram)
                chosen = partly.has(s.ids[s.rows], s.both())
                _, rows, hashes = s.windows_of(chosen)
                out += sender.add(s.ids[rows], hashes, np.zeros(0, np.uint8))
        out += sender.flush()
        schema = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("docs", "keys", "marks")])
        return pa.Table.from_batches(out, schema)

    def smaller(received_):
        return owned_elsewhere([(d, k, np.zeros(len(d), np.uint8)) for d, k, _ in received_])

    windows = exchange(join_answers(parted, answers, send_windows, SENT), smaller, n_docs)
    heard_both = answers.unionByName(windows)

    def finish(texts: pa.Table, heard: pa.Table) -> pa.Table:
        hasher, out = Hasher(), []
        full, partly, single = Heard(heard, FULL), Heard(heard, PARTLY), Heard(heard, 0)
        for batch in texts.combine_chunks().to_batches():
            for block in blocks(batch):
                s = Stretches(block, hasher, width, gram)
                ids, both = s.ids[s.rows], s.both()
                whole = full.has(ids, both)
                starts = [s.windows_of(whole)[0]]
                some, rows, hashes = s.windows_of(~whole & partly.has(ids, both))
                starts.append(some[single.has(s.ids[rows], hashes)])
                removed = covered(np.concatenate(starts), width, len(s.data))
                rows = []
                for a, b in zip(s.offsets[:-1], s.offsets[1:]):
                    gone = removed[a:b]
                    kept = s.data[a:b][~gone].tobytes()
                    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    row = (int(b - a), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
                    row += (kept.decode("utf-8", "ignore"),) * with_text
                    rows.append(row + (hashlib.sha256(s.data[a:b].tobytes()).hexdigest(),) * with_input)
                columns = [pa.array(c) for c in zip(*rows)]
                out.append(pa.RecordBatch.from_arrays([block.column("doc_id"), *columns], names))
        types = [pa.int64()] * 4 + [pa.string()] * 3
        return pa.Table.from_batches(out, pa.schema(list(zip(names, types))))

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    names += ["input_sha256"] * with_input
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept string" * with_text + ", input_sha256 string" * with_input
    return join_answers(parted, heard_both, finish, schema)
