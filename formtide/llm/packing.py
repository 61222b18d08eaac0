"""Harmonic packing of token sequences (operator 10).

A document's ids are cut into pieces whose lengths are powers of two from ``capacity`` down to
``smallest``; what remains is one piece shorter than ``smallest``. Lengths fall into classes by
the reciprocal of the capacity: class k takes lengths in (capacity/(k+1), capacity/k], and each of
its bins holds exactly k pieces, whichever they are. So every worker fills the bins of every class
by itself, by counting. Pieces left when a worker ends (under k of class k) go to a second pass of the same kind, one task
for ``GROUP`` workers; only what that leaves shares bins across classes. Power-of-two pieces fill
their bins to the brim, the others leave at most a share of smallest/capacity free.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import blocks, materialise, partitions_of, spans

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int,"
    " sequence_id long, offset long"
)
# A space between two non-spaces always starts a new token of the byte-level pattern.
BORDER = re.compile(r"(?<=\S) (?=\S)")
GROUP = 16


DOUBLE_SPACE = re.compile(r"\s\s")


def chunks(text: str) -> list[str]:
    """A text cut at the spaces between two non-spaces, without those spaces."""
    if text[0].isspace() or text[-1].isspace() or DOUBLE_SPACE.search(text):
        return BORDER.split(text)
    return text.split(" ")


class Codes(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = code = len(self)
        return code


class ChunkEncoder:
    """Ids of texts by a byte-level tokenizer, each distinct chunk encoded once per worker.

    Texts are cut where a token border is certain, and the distinct chunks of a block go through the
    tokenizer as one text; the bytes that each id stands for tell where a chunk ends. Chunks are kept
    up to ``most`` of them or ``most_bytes`` characters; then the worker begins anew.
    """

    def __init__(self, path: str, most: int = 500_000, most_bytes: int = 32 << 20):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.most_bytes = Tokenizer.from_file(path), most, most_bytes
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)  # one character stands for one byte
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            self.width[i] = len(token.content.encode())
        self.reset()

    def reset(self) -> None:
        self.known, self.held = Codes(), 0
        self.counts, self.begin = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def learn(self) -> None:
        """Encode the chunks that were numbered since the last call; all begin with a space."""
        news = list(islice(self.known, len(self.counts), None))
        self.held += sum(map(len, news))
        counts, pieces, order, alone = np.zeros(len(news), np.int64), [], [], []
        for i in range(0, len(news), 512):
            own = np.arange(i, min(i + 512, len(news)))
            group = [" " + chunk for chunk in news[i : i + 512]]
            ids = np.array(self.tokenizer.encode("".join(group), add_special_tokens=False).ids, np.uint32)
            ends = np.cumsum(self.width[ids])
            borders = np.cumsum([len(chunk.encode()) for chunk in group])
            cuts = np.minimum(np.searchsorted(ends, borders), len(ends) - 1)
            irregular = any(chunk[1:2].isspace() or chunk[-1].isspace() for chunk in group)
            if irregular or ends[-1] != borders[-1] or (ends[cuts] != borders).any():
                alone += own.tolist()
                continue
            counts[own] = np.diff(np.concatenate(([0], cuts + 1)))
            pieces.append(ids)
            order.append(own)
        for i in range(0, len(alone), 4096):
            group = alone[i : i + 4096]
            texts = [" " + news[j] for j in group]
            for j, found in zip(group, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
                counts[j] = len(found.ids)
                pieces.append(np.array(found.ids, np.uint32))
                order.append(np.array([j]))
        if news:
            order = np.concatenate(order)
            begin = np.zeros(len(news), np.int64)
            begin[order] = len(self.ids) + np.cumsum(counts[order]) - counts[order]
            self.begin, self.counts = np.append(self.begin, begin), np.append(self.counts, counts)
            self.ids = np.concatenate([self.ids, *pieces])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        if len(self.known) > self.most or self.held > self.most_bytes:
            self.reset()
        codes: list[int] = []
        firsts: list[str] = []
        number = self.known.__getitem__
        sizes = np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts):
            if text:
                first, *rest = chunks(text)
                firsts.append(first)
                codes.append(-len(firsts))
                codes.extend(map(number, rest))
                sizes[row] = 1 + len(rest)
        if not codes:
            return np.zeros(0, np.uint32), sizes
        self.learn()
        # a text's first chunk has no space before it: it is encoded for itself
        own = [
            np.array(found.ids, np.uint32)
            for found in self.tokenizer.encode_batch(firsts, add_special_tokens=False)
        ]
        own_counts = np.array([len(ids) for ids in own], np.int64)
        ids = np.concatenate([self.ids, *own])
        begin = np.append(self.begin, len(self.ids) + np.cumsum(own_counts) - own_counts)
        counts = np.append(self.counts, own_counts)
        codes = np.array(codes)
        codes = np.where(codes < 0, len(self.counts) - 1 - codes, codes)
        ids = ids[np.repeat(begin[codes], counts[codes]) + spans(counts[codes])]
        chunk_ends = np.concatenate(([0], np.cumsum(counts[codes])))
        text_ends = np.concatenate(([0], np.cumsum(sizes)))
        return ids, np.diff(chunk_ends[text_ends])


def slices(text: str, size: int):
    """A long text in parts that begin at certain token borders."""
    start = 0
    while len(text) - start > size:
        border = BORDER.search(text, start + size)
        if not border:
            break
        yield text[start : border.start()]
        start = border.start()
    yield text[start:]


PIECE = np.dtype([(n, np.int64) for n in ("doc", "start", "length", "crc", "total")])


def cut_all(totals: np.ndarray, capacity: int, smallest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of the pieces of all documents: whole capacities, then falling powers of
    two down to ``smallest``, then what remains."""
    whole, rest = np.divmod(totals, capacity)
    rows, starts, lengths = [np.repeat(np.arange(len(totals)), whole)], [spans(whole) * capacity], [np.full(whole.sum(), capacity)]
    start, size = whole * capacity, capacity // 2
    while size >= smallest:
        has = np.flatnonzero(rest >= size)
        rows, starts, lengths = [*rows, has], [*starts, start[has]], [*lengths, np.full(len(has), size)]
        start[has] += size
        rest[has] -= size
        size //= 2
    has = np.flatnonzero(rest)
    rows, starts, lengths = (np.concatenate(x) for x in ([*rows, has], [*starts, start[has]], [*lengths, rest[has]]))
    order = np.lexsort((starts, rows))
    return rows[order], starts[order], lengths[order]


class Bins:
    """Bins of one worker. A class is dealt by counting: its pieces ``k*i`` to ``k*i + k - 1`` are a bin."""

    def __init__(self, capacity: int, worker: int):
        self.capacity, self.next_bin, self.left = capacity, worker << 32, np.zeros(0, PIECE)

    def add(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of the bins that are full now, with class, bin and offset; the others wait."""
        pieces = np.concatenate([self.left, pieces])
        kind = self.capacity // pieces["length"]
        order = np.argsort(kind, kind="stable")
        pieces, kind = pieces[order], kind[order]
        classes, first, counts = np.unique(kind, return_index=True, return_counts=True)
        number = np.arange(len(kind)) - np.repeat(first, counts)
        full = counts // classes
        inside = number < np.repeat(full * classes, counts)
        bins = np.repeat(np.cumsum(full) - full, counts) + number // kind
        self.left = pieces[~inside]
        pieces, kind, bins, number = (x[inside] for x in (pieces, kind, bins, number % kind))
        ends = np.cumsum(pieces["length"])
        begin = (ends - pieces["length"])[number == 0]
        offset = ends - pieces["length"] - np.repeat(begin, kind[number == 0])
        bins += self.next_bin
        self.next_bin += int(full.sum())
        return pieces, kind, bins, offset

    def close_rest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First fit by falling length of what the classes have left: under k pieces of class k."""
        pieces = self.left[np.argsort(-self.left["length"], kind="stable")]
        bins, offset, free = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), []
        for at, length in enumerate(pieces["length"].tolist()):
            i = next((i for i, f in enumerate(free) if f >= length), len(free))
            free += [self.capacity] * (i == len(free))
            bins[at], offset[at] = i, self.capacity - free[i]
            free[i] -= length
        bins += self.next_bin
        self.next_bin += len(free)
        self.left = self.left[:0]
        return pieces, self.capacity // pieces["length"], bins, offset


#: Stands for a null id among the ids of pieces.
NO_ID = np.iinfo(np.int64).min


def _rows(pieces: np.ndarray, kind: np.ndarray, bins: np.ndarray, offset: np.ndarray | None, names: list[str],
          types: list) -> pa.RecordBatch:
    columns = [pa.array(pieces["doc"], mask=pieces["doc"] == NO_ID)]
    columns += [pa.array(np.ascontiguousarray(pieces[c])) for c in ("start", "length", "crc", "total")]
    columns += [pa.array(kind.astype(np.int32)), pa.array(bins)]
    columns.append(pa.nulls(len(pieces), pa.int64()) if offset is None else pa.array(offset))
    return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types)], names)


def release() -> None:
    """Hand memory that earlier tasks of a reused worker have freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    smallest: int = 64,
    separator: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of all documents with their place: ``doc_id, start, length, ids_crc32, doc_tokens,
    class, sequence_id, offset`` (offset: place in the sequence).

    A document is its ids followed by ``separator``. Null text counts as empty (one id), a null id is
    kept as null, repeated rows are packed each for itself, an empty table gives no rows, other columns
    are not read. The pieces are written once to the shared folder, so texts are tokenised once.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "sequence_id", "offset"]
    types = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.int64()]

    def first_pass(batches):
        release()
        encoder, worker = ChunkEncoder(tokenizer_path), TaskContext.get().partitionId()
        bins = Bins(capacity, worker)
        for batch in batches:
            for block in blocks(batch, 2 << 20):
                parts = [
                    (row, part)
                    for row, text in enumerate(block.column("text").to_pylist())
                    for part in slices(text or "", 2 << 20)
                ]
                # several parts of one long text are encoded one by one
                step = len(parts) if len(parts) == block.num_rows else 1
                found = [encoder.encode([part for _, part in parts[i : i + step]]) for i in range(0, len(parts), step)]
                sizes = np.bincount([row for row, _ in parts], np.concatenate([n for _, n in found]), block.num_rows)
                totals = sizes.astype(np.int64) + 1
                raw = np.full(totals.sum(), separator, "<u4")
                own = np.ones(len(raw), bool)
                own[np.cumsum(totals) - 1] = False
                raw[own] = np.concatenate([ids for ids, _ in found])
                rows, starts, lengths = cut_all(totals, capacity, smallest)
                pieces = np.zeros(len(rows), PIECE)
                docs_of = block.column("doc_id").fill_null(NO_ID).to_numpy()
                pieces["doc"], pieces["start"], pieces["length"], pieces["total"] = docs_of[rows], starts, lengths, totals[rows]
                ends = np.cumsum(lengths) * 4
                view = memoryview(raw.tobytes())
                pieces["crc"] = [zlib.crc32(view[a:b]) for a, b in zip([0, *ends.tolist()], ends.tolist())]
                yield _rows(*bins.add(pieces), names, types)
        left, group = bins.left, np.full(len(bins.left), -1 - worker // GROUP)
        yield _rows(left, capacity // left["length"], group, None, names, types)
        del encoder
        release()

    def second_pass(batches):
        """Rows of a group of workers stand together."""
        bins, now = None, None
        for batch in batches:
            groups = batch.column("sequence_id").to_numpy()
            pieces = np.zeros(len(groups), PIECE)
            pieces["doc"] = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            for at, name in enumerate(names[1:5], 1):
                pieces[PIECE.names[at]] = batch.column(name).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
            for a, b in zip(edges, edges[1:]):
                if b == a:
                    continue
                if groups[a] != now:
                    if bins:
                        yield _rows(*bins.close_rest(), names, types)
                    now = int(groups[a])
                    bins = Bins(capacity, (1 << 30) - now)
                yield _rows(*bins.add(pieces[a:b]), names, types)
        if bins:
            yield _rows(*bins.close_rest(), names, types)

    spark = docs.sparkSession
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    pieces = materialise(narrow.mapInArrow(first_pass, PIECES), "pieces")
    packed = pieces.filter("offset IS NOT NULL")
    rest = pieces.filter("offset IS NULL").repartition(partitions_of(spark), "sequence_id")
    rest = rest.sortWithinPartitions("sequence_id", "class", "doc_id", "start")
    return packed.unionByName(rest.mapInArrow(second_pass, PIECES))
