"""Substring dedup by difference-cover anchors (operator 9).

Words at positions whose remainder modulo a period lies in a difference cover start an anchor, a
shorter window. For any two positions some shift below the period takes both onto the cover, so two
equal windows always hold equal anchors at the same place. Anchors go to their bucket; those that two
documents hold come back, and only windows around them are extended to full length and compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from formtide.llm.common import Hasher, blocks, chain_hash, materialise, text_bytes, words_of
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

# Perfect difference sets: every remainder is a difference of two members.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9)}


class Words:
    """Words of a block of documents and the hash of every run of n words within one document."""

    def __init__(self, block: pa.RecordBatch, hasher: Hasher):
        self.data, offsets = text_bytes(block.column("text"))
        self.ids = block.column("doc_id").fill_null(-1).to_numpy()
        self.known = block.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        self.starts, self.ends, self.rows = words_of(self.data, offsets)
        hasher.load(self.data)
        self.hashes = hasher.of(self.starts, self.ends)
        self.firsts = np.searchsorted(self.rows, np.arange(len(self.ids) + 1))

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of the first word and hash of every run of ``n`` words."""
        found = chain_hash(self.hashes, n)
        at = np.arange(len(found))
        inside = self.rows[at] == self.rows[at + n - 1] if len(at) else np.zeros(0, bool)
        return at[inside], found[inside]

    def anchors(self, n: int, width: int, period: int) -> tuple[np.ndarray, np.ndarray]:
        """Anchors that a window of ``width`` words can hold."""
        at, found = self.runs(n)
        row = self.rows[at]
        on_cover = np.isin((at - self.firsts[row]) % period, COVERS[period])
        long_enough = np.diff(self.firsts)[row] >= width
        keep = on_cover & long_enough & self.known[row]
        return at[keep], found[keep]


def remove_repeats(docs: DataFrame, width: int = 20, period: int = 13, id_column: str = "doc_id",
                   text_column: str = "text", with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``kept``) for every row.

    A word goes if a window of ``width`` words over it also starts earlier: in a document with a smaller
    id, or at an earlier word of its own. Windows are judged on the input. Null and empty texts have no
    words. Rows without an id, and rows that share one, are compared with smaller ids only or not at
    all: a null id neither finds nor is found; rows of one id do not see each other.
    """
    anchor = width - period + 1
    if anchor < 1:
        raise ValueError("the window must be at least as wide as the period")
    parted, n_docs, n_keys = with_buckets(docs, id_column, text_column)

    def send_anchors(batches):
        hasher, sender = Hasher(), Sender(n_keys)
        for batch in batches:
            for block in blocks(batch):
                words = Words(block, hasher)
                at, keys = words.anchors(anchor, width, period)
                ids = words.ids[words.rows[at]]
                new = np.ones(len(keys), bool)  # a key that repeats at once is sent once
                new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
                yield from sender.add(ids[new], keys[new], np.zeros(0, np.uint8))
        yield from sender.flush()

    def shared(received_):
        """Keys that at least two documents hold, for all of them."""
        ids, keys, _ = (np.concatenate(x) for x in zip(*received_))
        order = np.lexsort((ids, keys))
        ids, keys = ids[order], keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        last = np.append(np.flatnonzero(new)[1:], len(keys)) - 1
        group = np.cumsum(new) - 1
        many = (ids[new] != ids[last])[group]
        again = np.zeros(len(keys), bool)
        again[1:] = (keys[1:] == keys[:-1]) & (ids[1:] == ids[:-1])
        many &= ~again
        return ids[many], keys[many], np.zeros(0, np.uint8)

    anchors = parted.select("doc_id", "text").mapInArrow(send_anchors, SENT)
    answers = materialise(exchange(anchors, shared, n_docs), "anchors")

    def windows_near(words: Words, heard: Heard) -> tuple[np.ndarray, np.ndarray]:
        """Windows that hold an anchor of another document."""
        at, keys = words.anchors(anchor, width, period)
        hit = at[heard.has(words.ids[words.rows[at]], keys)]
        near = np.zeros(len(words.hashes) + period, bool)
        if len(hit):
            step = np.zeros(len(near) + 1, np.int32)
            np.add.at(step, np.maximum(hit - period + 1, 0), 1)
            np.add.at(step, hit + 1, -1)
            near = np.cumsum(step[:-1]) > 0
        start, found = words.runs(width)
        keep = near[start] & words.known[words.rows[start]]
        return start[keep], found[keep]

    def send_windows(texts: pa.Table, heard: pa.Table) -> pa.Table:
        hasher, sender, answer, out = Hasher(), Sender(n_keys), Heard(heard), []
        for batch in texts.combine_chunks().to_batches():
            for block in blocks(batch):
                words = Words(block, hasher)
                start, found = windows_near(words, answer)
                ids = words.ids[words.rows[start]]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (ids[1:] != ids[:-1])
                out += sender.add(ids[new], found[new], np.zeros(0, np.uint8))
        out += sender.flush()
        schema = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("docs", "keys", "marks")])
        return pa.Table.from_batches(out, schema)

    def no_marks(received_):
        return owned_elsewhere([(d, k, np.zeros(len(d), np.uint8)) for d, k, _ in received_])

    windows = join_answers(parted, answers, send_windows, SENT)
    removed = exchange(windows, no_marks, n_docs)

    def finish(texts: pa.Table, heard: pa.Table) -> pa.Table:
        hasher, answer, out = Hasher(), Heard(heard), []
        for batch in texts.combine_chunks().to_batches():
            for block in blocks(batch):
                words = Words(block, hasher)
                start, found = words.runs(width)
                row = words.rows[start]
                order = np.lexsort((found, row))
                again = np.zeros(len(found), bool)
                same = (found[order][1:] == found[order][:-1]) & (row[order][1:] == row[order][:-1])
                again[order[1:]] = same  # stable: the first of a row stays
                gone = again | (answer.has(words.ids[row], found) & words.known[row])
                removed = covered(start[gone], width, len(words.hashes))
                raw = words.data.tobytes()
                starts, ends = words.starts.tolist(), words.ends.tolist()
                rows = []
                for i in range(block.num_rows):
                    a, b = words.firsts[i], words.firsts[i + 1]
                    own = (np.flatnonzero(~removed[a:b]) + a).tolist()
                    kept = b" ".join([raw[starts[j] : ends[j]] for j in own])
                    digest = hashlib.sha256(kept).hexdigest()
                    row_ = (int(b - a), int(b - a) - len(own), digest)
                    rows.append(row_ + (kept.decode("utf-8", "replace"),) if with_text else row_)
                columns = [pa.array(c) for c in zip(*rows)]
                out.append(pa.RecordBatch.from_arrays([block.column("doc_id"), *columns], names))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.Table.from_batches(out, pa.schema(list(zip(names, types))))

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    return join_answers(parted, removed, finish, schema)
