"""SentencePiece encoding and decoding by a batched search (operator 1).

A text is cut where no piece can reach across: between two characters that stand side by side in no
piece. Distinct parts of equal length advance together: hashes of their substrings probe the sorted
hashes of the pieces. Of a unigram model, a maximum over lengths at every end keeps the best score and a
back pointer (Viterbi): the segmentation of the highest total score. Of a merge model, every step joins
in each part the two neighbours whose piece has the highest score, the leftmost of equal ones, until no
two make a piece. Either is the model's own segmentation; merges never cross a cut. Characters that no piece covers become byte pieces.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import BASE, BASE_INVERSE, blocks, mix, powers, spans

SPACE = "▁"


class Pieces:
    """Arrays of a vocabulary: texts, scores, ids of bytes, and what may be adjacent in a piece."""

    def __init__(self, texts: list[str], scores: np.ndarray, ids: np.ndarray, byte_ids: np.ndarray, raw: list[bytes],
                 merges: bool = False):
        self.texts, self.scores, self.ids, self.byte_ids, self.raw = texts, scores, ids, byte_ids, raw
        self.merges = merges

    @classmethod
    def read(cls, path: str) -> Pieces:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        own = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        raw = [b""] * n
        for i in own:
            raw[i] = model.id_to_piece(i).replace(SPACE, " ").encode()
        for b, i in enumerate(byte_ids.tolist()):
            raw[i] = bytes([b])
        texts = [model.id_to_piece(i) for i in own]
        spec = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto()).trainer_spec
        merges = spec.model_type == spec.BPE
        return cls(texts, np.array([model.get_score(i) for i in own]), np.array(own), byte_ids, raw, merges)


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Encoder:
    """Encodes texts in bulk; keeps up to ``most`` distinct parts and their ids."""

    def __init__(self, pieces: Pieces, most: int = 400_000):
        self.pieces, self.most = pieces, most
        self.up, self.down = powers(BASE, 1 << 12), powers(BASE_INVERSE, 1 << 12)
        lengths = np.array([len(t) for t in pieces.texts])
        self.longest = int(lengths.max())
        flat = points("".join(pieces.texts))
        sums = self.sums(flat)
        ends = np.cumsum(lengths)
        hashes = self.hash(sums, ends - lengths, ends)
        order = np.argsort(hashes)
        self.hashes, self.scores, self.ids = hashes[order], pieces.scores[order], pieces.ids[order]
        self.unknown = pieces.scores.min() - 10
        # characters by number, and which pairs occur within a piece
        self.characters = np.unique(flat)
        number = np.searchsorted(self.characters, flat)
        inner = np.ones(len(flat), bool)
        inner[ends - 1] = False
        at = np.flatnonzero(inner)
        self.pairs = np.zeros((len(self.characters) + 1,) * 2, bool)
        self.pairs[number[at], number[at + 1]] = True
        self.number_of = np.full(0x110000, len(self.characters), np.int32)
        self.number_of[self.characters] = np.arange(len(self.characters))
        self.reset()

    def reset(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin = self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def sums(self, values: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(values):
            self.up, self.down = powers(BASE, len(values) + 1), powers(BASE_INVERSE, len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values.astype(np.uint64) + np.uint64(7)) * self.up[: len(values)], out=out[1:])
        return out

    def hash(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def viterbi(self, flat: np.ndarray, sums: np.ndarray, starts: np.ndarray, length: int):
        """Ids (or -1 - character) of parts of one length: flattened, and their number per part."""
        m, reach = len(starts), min(length, self.longest)
        gain = np.full((m, length + 1, reach), -np.inf)  # by end and length - 1
        piece = np.zeros((m, length + 1, reach), np.int64)
        for size in range(1, reach + 1):
            first = starts[:, None] + np.arange(length - size + 1)[None, :]
            hashes = self.hash(sums, first, first + size)
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes
            gain[:, size:, size - 1] = np.where(hit, self.scores[at], -np.inf)
            piece[:, size:, size - 1] = np.where(hit, self.ids[at], -1)
            if size == 1:
                alone = ~hit
                gain[:, 1:, 0][alone] = self.unknown
                piece[:, 1:, 0][alone] = -1 - flat[first[alone]].astype(np.int64)
        best = np.full((m, length + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((m, length + 1), np.int64)
        for end in range(1, length + 1):
            sizes = np.arange(min(end, reach))
            total = best[:, end - 1 - sizes] + gain[:, end, sizes]
            back[:, end] = total.argmax(axis=1)
            best[:, end] = total[np.arange(m), back[:, end]]
        taken = np.full((m, length), -1, np.int64)
        used = np.zeros((m, length), bool)
        place, rows = np.full(m, length), np.arange(m)
        while len(rows):
            size = back[rows, place[rows]]
            begin = place[rows] - size - 1
            taken[rows, begin] = piece[rows, place[rows], size]
            used[rows, begin] = True
            place[rows] = begin
            rows = rows[begin > 0]
        return taken[used], used.sum(axis=1)

    segment = viterbi

    def learn(self, hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, flat: np.ndarray, sums: np.ndarray):
        """Encode parts that are not known yet."""
        news, counts, order = [], [], []
        for length in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == length)
            step = max(1, (1 << 20) // (length * min(length, self.longest)))
            for i in range(0, len(own), step):
                part = own[i : i + step]
                ids, count = self.segment(flat, sums, starts[part], length)
                news.append(ids)
                counts.append(count)
                order.append(part)
        ids, count, order = np.concatenate(news), np.concatenate(counts), np.concatenate(order)
        bad = np.flatnonzero(ids < 0)
        if len(bad):
            raw = [chr(-1 - c).encode() for c in ids[bad].tolist()]
            width = np.ones(len(ids), np.int64)
            width[bad] = [len(r) for r in raw]
            owner = np.repeat(np.arange(len(count)), count)
            count = np.bincount(owner, width, len(count)).astype(np.int64)
            wide = np.repeat(ids, width)
            wide[wide < 0] = self.pieces.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
            ids = wide
        begin = len(self.flat) + np.cumsum(count) - count
        self.flat = np.append(self.flat, ids.astype(np.int32))
        known = np.append(self.known, hashes[order])
        sort = np.argsort(known)
        self.known = known[sort]
        self.begin, self.count = np.append(self.begin, begin)[sort], np.append(self.count, count)[sort]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and their number per text."""
        if len(self.known) > self.most:
            self.reset()
        ready = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        sizes = np.array([len(t) for t in ready], np.int64)
        flat = points("".join(ready))
        if not len(flat):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        number = self.number_of[flat]
        border = np.ones(len(flat), bool)
        border[1:] = ~self.pairs[number[:-1], number[1:]]
        row_ends = np.cumsum(sizes)
        border[(row_ends - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(border)
        ends = np.append(starts[1:], len(flat))
        sums = self.sums(flat)
        hashes, first, part = np.unique(self.hash(sums, starts, ends), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = self.known[at] != hashes if len(self.known) else np.ones(len(hashes), bool)
        if new.any():
            own = first[new]
            self.learn(hashes[new], starts[own], (ends - starts)[own], flat, sums)
        at = np.searchsorted(self.known, hashes)[part]
        count = self.count[at]
        ids = self.flat[np.repeat(self.begin[at], count) + spans(count)]
        rows = np.searchsorted(row_ends, starts, side="right")
        return ids, np.bincount(rows, count, len(texts)).astype(np.int64)


class MergeEncoder(Encoder):
    """Encodes by the merges of the pieces, in the order of their scores."""

    def __init__(self, pieces: Pieces, most: int = 400_000, longest_batched: int = 256):
        super().__init__(pieces, most)
        self.longest_batched = longest_batched
        self.by_text = {t: (-s, i) for t, s, i in zip(pieces.texts, pieces.scores.tolist(), pieces.ids.tolist())}

    def look_up(self, sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the pieces between two places; no piece has the score of minus infinity."""
        hashes = self.hash(sums, first, last)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes
        return np.where(hit, self.scores[at], -np.inf), np.where(hit, self.ids[at], -1)

    def segment(self, flat: np.ndarray, sums: np.ndarray, starts: np.ndarray, length: int):
        """Ids (or -1 - character) of parts of one length: flattened, and their number per part."""
        if length > self.longest_batched:
            found = [self.segment_long(flat[s : s + length]) for s in starts.tolist()]
            return np.concatenate(found), np.array([len(f) for f in found])
        m = len(starts)
        places = starts[:, None] + np.arange(length)[None, :]
        _, piece = self.look_up(sums, places, places + 1)
        piece = np.where(piece < 0, -1 - flat[places].astype(np.int64), piece)
        end = np.tile(np.arange(1, length + 1), (m, 1))  # of the symbol that begins here
        before = end - 2  # where the symbol before it begins
        used = np.ones((m, length), bool)
        gain, joined = np.full((m, length), -np.inf), np.zeros((m, length), np.int64)
        gain[:, :-1], joined[:, :-1] = self.look_up(sums, places[:, :-1], places[:, :-1] + 2)
        rows = np.arange(m)
        while len(rows):
            left = gain[rows].argmax(axis=1)
            able = gain[rows, left] > -np.inf
            rows, left = rows[able], left[able]
            right = end[rows, left]
            stop = end[rows, right]
            end[rows, left], piece[rows, left] = stop, joined[rows, left]
            used[rows, right] = False
            gain[rows, right] = gain[rows, left] = -np.inf
            more = stop < length
            r, a, b = rows[more], left[more], stop[more]
            before[r, b] = a
            gain[r, a], joined[r, a] = self.look_up(sums, starts[r] + a, starts[r] + end[r, b])
            more = left > 0
            r, b = rows[more], stop[more]
            a = before[r, left[more]]
            gain[r, a], joined[r, a] = self.look_up(sums, starts[r] + a, starts[r] + b)
        return piece[used], used.sum(axis=1)

    def segment_long(self, values: np.ndarray) -> np.ndarray:
        """The same for one part, with a heap: its steps do not look at the whole part."""
        text = values.astype(np.uint32).tobytes().decode("utf-32-le")
        n = len(text)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(a):
            if a >= 0 and end[a] < n:
                found = self.by_text.get(text[a : end[end[a]]]) if end[end[a]] - a <= self.longest else None
                if found:
                    heapq.heappush(heap, (found[0], a, end[a], end[end[a]]))

        for a in range(n - 1):
            offer(a)
        while heap:
            _, a, middle, stop = heapq.heappop(heap)
            if end[a] != middle or end[middle] != stop:
                continue  # one of the two was joined before
            end[a], end[middle] = stop, -1
            if stop < n:
                before[stop] = a
            offer(a)
            offer(before[a])
        out, a = [], 0
        while a < n:
            found = self.by_text.get(text[a : end[a]])
            out.append(found[1] if found else -1 - ord(text[a]))
            a = end[a]
        return np.array(out, np.int64)


class Decoder:
    """Bytes of ids; the space before a text goes."""

    def __init__(self, pieces: Pieces):
        self.widths = np.array([len(r) for r in pieces.raw])
        self.begins = np.cumsum(self.widths) - self.widths
        self.bytes = np.frombuffer(b"".join(pieces.raw), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        width = self.widths[ids]
        data = self.bytes[np.repeat(self.begins[ids], width) + spans(width)].tobytes()
        ends = np.append(0, np.cumsum(width))[np.append(0, np.cumsum(counts))].tolist()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
        return [t[1:] if t.startswith(" ") else t for t in texts]


def encode_texts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids array<int>, restored`` for every row; ``restored``: the ids decode to the text again.

    Null and empty texts have no ids (null counts as empty); null and repeated ids are kept; a text that
    holds the mark U+2581 itself decodes to a space there, as the format has it.
    """
    pieces = Pieces.read(path)

    def run(batches):
        encoder, decoder = (MergeEncoder if pieces.merges else Encoder)(pieces), Decoder(pieces)
        for batch in batches:
            for block in blocks(batch):
                texts = [t or "" for t in block.column("text").to_pylist()]
                ids, counts = encoder.encode(texts)
                back = decoder.decode(ids, counts)
                same = [a == b.replace(SPACE, " ") for a, b in zip(back, texts)]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), lists, pa.array(same)], ["doc_id", "ids", "restored"]
                )

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, ids array<int>, restored boolean")


def decode_ids(rows: DataFrame, path: str, ids_column: str = "ids") -> DataFrame:
    """The rows' ids as ``text``, beside ``doc_id``; null ids count as none."""
    pieces = Pieces.read(path)

    def run(batches):
        decoder = Decoder(pieces)
        for batch in batches:
            column = batch.column("ids").fill_null([])
            counts = np.diff(column.offsets.to_numpy())
            texts = decoder.decode(column.flatten().to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", F.col(ids_column).alias("ids")).mapInArrow(run, "doc_id long, text string")
