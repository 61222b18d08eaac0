"""Language-model scores by a probabilistic suffix tree (operator 6).

Every word and the end of a text are symbols. A context of up to ``depth`` symbols is tested if it occurs
``least_count`` times in the training rows, so that the tree grows with the data: it stays if its next
symbols diverge from those of its suffix (G-test against a threshold per degree of freedom).
Distributions are smoothed by discounting towards the suffix's; a text is scored with the longest
context in the tree before every token. All probabilities of a state sum to one.

No task holds the tree. Texts become numbers of words once, by bucket; these files lie by bucket, so that
no later step reads, cuts or shuffles a text. Buckets send their distinct runs (context and next symbol) with their
number and the suffix's probability to the task of the context, which counts, tests and answers
with the probability in the order of the question; one round per length. Only runs whose context is
frequent go out: that is known from the round before, since a context was a run there. A context with
more than the share ``hot`` of all tokens (at most ``1/hot`` of a length) is dealt over all tasks by its
next symbols; its sums meet on the driver. Probabilities travel as 32-bit logarithms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import LOWER, Hasher, blocks, mix, settled, settled_by, text_bytes, words_of
from formtide.llm.exchange import join_answers, with_buckets
from formtide.llm.sampling import remainder

END = np.uint64(1)
PACKED = "bucket int, source int, keys binary, counts binary"
NAMES = ["bucket", "source", "keys", "counts"]
ASKED = "bucket int, source int, contexts binary, runs binary, symbols binary, n binary, p binary"
ASKED_NAMES = ["bucket", "source", "contexts", "runs", "symbols", "n", "p"]
STATE = "bucket int, kind int, place int, piece binary"
STATE_NAMES = ["bucket", "kind", "place", "piece"]
# Bytes of a row of a bucket's state: a writer holds at least 100 rows.
PIECE = 1 << 18
ODD = np.uint64(0x9E3779B97F4A7C15)


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as bytes, those of one place together, compressed; hashes would not get smaller."""
    places = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + (pa.compress(places.tobytes(), "zstd", asbytes=True) if len(values) else b"")


def expanded(raw: bytes, kind) -> np.ndarray:
    n, size = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    places = np.frombuffer(pa.decompress(raw[8:], n * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(places.reshape(size, n).T).view(kind).ravel()


def tokens_of(block: pa.RecordBatch, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every token; each row ends with ``END``."""
    data, offsets = text_bytes(block.column("text"))
    data = LOWER[data]
    starts, ends, rows = words_of(data, offsets)
    hasher.load(data)
    count = block.num_rows
    rows = np.append(rows, np.arange(count))
    order = np.argsort(rows, kind="stable")  # the end follows the words of its row
    tokens = np.append(hasher.of(starts, ends) | np.uint64(2), np.full(count, END))
    return rows[order], tokens[order]


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (mix(keys) % np.uint64(n)).astype(np.int64)


def packed(to: np.ndarray, source: int, keys: np.ndarray, counts: np.ndarray | None) -> pa.RecordBatch:
    order = np.argsort(to, kind="stable")
    buckets, starts = np.unique(to[order], return_index=True)
    cut = lambda a: np.split(a[order], starts[1:]) if len(buckets) else []
    counted = [squeezed(c) for c in cut(counts)] if counts is not None else [b""] * len(buckets)
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array([source] * len(buckets), pa.int32()),
         pa.array([k.tobytes() for k in cut(keys)], pa.binary()), pa.array(counted, pa.binary())], NAMES,
    )


def schema_of_packed() -> pa.Schema:
    return pa.schema(list(zip(NAMES, [pa.int32(), pa.int32(), pa.binary(), pa.binary()])))


def places_in_order(numbers: np.ndarray, limit: int) -> np.ndarray:
    """Places of integers from 0 to below ``limit``, by value and place.

    Where 64 bits hold a value with its place, these are sorted as one, several times faster than places alone.
    """
    bits = max(len(numbers), 2).bit_length()
    if int(limit).bit_length() + bits > 63:
        return np.argsort(numbers, kind="stable")
    cells = np.sort((numbers << np.int64(bits)) | np.arange(len(numbers)))
    return cells & np.int64((1 << bits) - 1)


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and for every hash its number among them."""
    bits = np.uint64(max(len(keys), 2).bit_length())
    cells = np.sort((keys >> bits << bits) | np.arange(len(keys), dtype=np.uint64))
    order = (cells & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():  # hashes that differ in their last bits only
        return np.unique(keys, return_inverse=True)
    new = np.append(True, ordered[1:] != ordered[:-1])[: len(keys)]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], number


def state_of(table: pa.Table) -> list[bytes]:
    """A bucket of documents as numbers: ids, which are null, which are held out, tokens of each row,
    distinct words by falling number, and the place of every token among these."""
    hasher, counts, tokens = Hasher(), [], []
    for batch in table.combine_chunks().to_batches():
        for block in blocks(batch):
            rows, own = tokens_of(block, hasher)
            counts.append(np.bincount(rows, minlength=block.num_rows).astype(np.uint32))
            tokens.append(own)
    words, word = numbered(np.concatenate(tokens))
    order = np.argsort(-np.bincount(word, minlength=len(words)), kind="stable")  # small numbers compress
    place = np.empty(len(words), np.uint32)
    place[order] = np.arange(len(words), dtype=np.uint32)
    ids = table.column("doc_id").combine_chunks()
    null, held = (c.to_numpy(zero_copy_only=False).astype(np.uint8) for c in (ids.is_null(), table.column("held_out").combine_chunks()))
    ids = ids.fill_null(0).to_numpy()
    return [*map(squeezed, (ids, null, held, np.concatenate(counts))), words[order].tobytes(), squeezed(place[word])]


def in_pieces(bucket: int, cells: list[bytes]) -> pa.Table:
    rows = [
        (bucket, kind, place, cell[at : at + PIECE])
        for kind, cell in enumerate(cells)
        for place, at in enumerate(range(0, max(len(cell), 1), PIECE))
    ]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=STATE_NAMES)


def from_pieces(table: pa.Table) -> list[bytes]:
    rows = sorted(zip(*(table.column(c).to_pylist() for c in STATE_NAMES[1:])))
    cells: dict[int, list[bytes]] = {}
    for kind, _, piece in rows:
        cells.setdefault(kind, []).append(piece)
    return [b"".join(pieces) for pieces in cells.values()]


class Runs:
    """The tokens of a bucket of documents with what is known of the runs of symbols that end there."""

    def __init__(self, table: pa.Table):
        ids, null, held, counts, words, word = from_pieces(table)
        self.ids = pa.array(expanded(ids, np.int64), mask=expanded(null, np.uint8).astype(bool))
        self.held, counts = expanded(held, np.uint8).astype(bool), expanded(counts, np.uint32)
        self.n = len(counts)
        self.rows = np.repeat(np.arange(self.n), counts)
        self.train = np.repeat(~self.held, counts)
        self.words, self.word = np.frombuffer(words, np.uint64), expanded(word, np.uint32).astype(np.int64)
        self.tokens = self.words[self.word]

    def start(self, number: np.ndarray, scale: float, limits: tuple[float, float]) -> None:
        """Length 0: counts of ``words``."""
        self.number = number[self.word]
        self.base = np.log10((number + 1) / scale)[self.word]
        self.score = self.base.copy()
        self.run, self.runs = self.word, self.words
        self.often = (self.number >= limits[0]).astype(np.uint8) + (self.number >= limits[1])

    def ask(self, length: int, n_keys: int) -> None:
        """Distinct runs of ``length`` symbols and a next one whose context is frequent, by bucket."""
        size = len(self.tokens)
        at = np.arange(length, size) if size > length else np.zeros(0, np.int64)
        at = at[(self.rows[at] == self.rows[at - length]) & (self.often[at - 1] > 0)]
        size = len(self.words)
        cells = self.run[at - 1] * size + self.word[at]
        order = places_in_order(cells, len(self.runs) * size)
        at, cells = at[order], cells[order]
        new = np.append(True, cells[1:] != cells[:-1])[: len(at)]
        run = np.cumsum(new) - 1
        first = at[new]
        self.times = np.bincount(run, self.train[at], len(first)).astype(np.uint32)
        self.context, self.symbol = self.runs[self.run[first - 1]], self.tokens[first]
        self.before = self.score[first].astype(np.float32)
        hot = self.often[first - 1] > 1
        to = np.where(hot, n_keys + bucket_of(run_keys(self.context, self.symbol), n_keys), bucket_of(self.context, n_keys))
        self.order = np.argsort(to.astype(np.uint16 if 2 * n_keys <= 1 << 16 else np.int64), kind="stable")
        self.to, self.at, self.of = to[self.order], at, run

    def questions(self, source: int, part: int, parts: int) -> pa.RecordBatch:
        """One row per bucket; those of a remainder."""
        buckets, starts = np.unique(self.to, return_index=True)
        ends = np.append(starts[1:], len(self.to))
        mine = buckets % parts == part
        buckets, columns = buckets[mine], [[] for _ in range(5)]
        for a, b in zip(starts[mine], ends[mine]):
            own = self.order[a:b]
            context = self.context[own]
            new = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
            runs = np.diff(np.append(new, len(own))).astype(np.uint32)
            cells = (context[new].tobytes(), squeezed(runs), self.symbol[own].tobytes())
            cells += (squeezed(self.times[own]), squeezed(self.before[own]))
            for column, cell in zip(columns, cells):
                column.append(cell)
        return pa.RecordBatch.from_arrays(
            [pa.array(buckets, pa.int32()), pa.array([source] * len(buckets), pa.int32())]
            + [pa.array(c, pa.binary()) for c in columns], ASKED_NAMES,
        )

    def hear(self, heard: dict, length: int, n_keys: int, hot: tuple, limits: tuple, discount: float) -> None:
        """Answers by bucket, in the order of the questions: the scores and runs of the next length."""
        value, often = np.full(len(self.to), np.nan), np.zeros(len(self.to), np.uint8)
        buckets, starts = np.unique(self.to, return_index=True)
        for bucket, a, b in zip(buckets.tolist(), starts, np.append(starts[1:], len(self.to))):
            flags, told = heard[bucket]
            if bucket < n_keys:
                value[a:b], often[a:b] = expanded(told, np.float32), expanded(flags, np.uint8)
                continue
            own, n = self.order[a:b], expanded(told, np.float64)
            keys, total, free, kept = hot
            place = np.searchsorted(keys, self.context[own])
            before = 10.0 ** self.before[own].astype(float)
            after = (n - np.minimum(n, discount) + free[place] * before) / total[place]
            value[a:b] = np.where(kept[place], np.log10(after), np.nan)
            often[a:b] = (n >= limits[0]).astype(np.uint8) + (n >= limits[1])
        back = np.empty(len(self.order), np.int64)
        back[self.order] = np.arange(len(self.order))
        value, often = value[back][self.of], often[back][self.of]
        known = ~np.isnan(value)
        self.score[self.at[known]] = value[known]
        self.often = np.zeros(len(self.tokens), np.uint8)
        self.often[self.at] = often
        self.run = np.zeros(len(self.tokens), np.int64)
        self.run[self.at] = self.of
        self.runs = run_keys(self.context, self.symbol)


def run_keys(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mix(context * ODD + symbol)


def answers(table: pa.Table, n_keys: int, limits: tuple, evidence: float, discount: float) -> pa.Table:
    """Probabilities after the contexts of a bucket; counts and sums (bucket -1) for a part of hot ones."""
    kinds = (np.uint64, np.uint32, np.uint64, np.uint32, np.float32)
    reads = (np.frombuffer, expanded, np.frombuffer, expanded, expanded)
    columns = [
        [read(x, kind) for x in table.column(c).to_pylist()] for c, kind, read in zip(ASKED_NAMES[2:], kinds, reads)
    ]
    context = np.concatenate([np.repeat(c, r) for c, r in zip(*columns[:2])])
    cuts = np.cumsum([len(x) for x in columns[2]])[:-1]
    symbol, n, p = (np.concatenate(c) for c in columns[2:])
    (contexts, context), (symbols, symbol) = numbered(context), numbered(symbol)
    cells = context * len(symbols) + symbol
    order = places_in_order(cells, len(contexts) * len(symbols))
    context, cells = context[order], cells[order]
    other = np.append(True, context[1:] != context[:-1])
    new = np.append(True, cells[1:] != cells[:-1])
    firsts = np.flatnonzero(new)
    times = np.add.reduceat(n[order].astype(float), firsts)
    before = p[order][firsts].astype(float)
    edges = np.flatnonzero(other[firsts])
    some = times > 0
    total, distinct, free, gain = (
        np.add.reduceat(x, edges)
        for x in (times, some.astype(float), np.minimum(times, discount),
                  times * (np.log(np.maximum(times, 1)) - before * np.log(10)))
    )
    own = np.empty(len(order), np.int64)
    own[order] = np.cumsum(new) - 1
    bucket, sources = table.column("bucket")[0].as_py(), table.column("source").to_pylist()
    rows = []
    if bucket >= n_keys:
        flags, told = None, times[own]
        sums = np.stack([total, distinct, free, gain], axis=1)
        rows.append((-1, bucket, contexts[context[firsts][edges]].tobytes(), sums.tobytes()))
    else:
        kept = stays(total, distinct, gain, evidence)
        place = np.cumsum(other[firsts]) - 1
        after = (times - np.minimum(times, discount) + free[place] * 10.0**before) / np.maximum(total, 1)[place]
        told = np.where(kept[place], np.log10(np.maximum(after, 1e-300)), np.nan).astype(np.float32)[own]
        flags = ((times >= limits[0]).astype(np.uint8) + (times >= limits[1]).astype(np.uint8))[own]
    flags = np.split(flags, cuts) if flags is not None else [np.zeros(0, np.uint8)] * len(sources)
    rows += [(s, bucket, squeezed(f), squeezed(t)) for s, f, t in zip(sources, flags, np.split(told, cuts))]
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema_of_packed())], schema=schema_of_packed())


def stays(total: np.ndarray, distinct: np.ndarray, gain: np.ndarray, evidence: float) -> np.ndarray:
    """Contexts that occur and diverge from their suffix; ``gain``: the sum of n (log n - log p)."""
    return (total > 0) & (2 * (gain - total * np.log(np.maximum(total, 1))) >= evidence * distinct)


def score_texts(docs: DataFrame, least_count: int = 8, depth: int = 2, evidence: float = 4.0,
                discount: float = 0.75, divisor: int = 7, held: int = 2, id_column: str = "doc_id",
                text_column: str = "text", least_share: float = 0.0, hot: float = 1e-3,
                passes: tuple[int, ...] = (2, 2)) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Learns from rows with ``crc32(id) mod divisor <> held``, rows without an id included. Null counts as
    the empty text, which has one token, its end. Contexts that occur ``least_count`` times are tested;
    a ``least_share`` of the training tokens asks for more. Runs of a length are
    exchanged in its number of ``passes`` over the key buckets (the last holds for all beyond), since disk
    holds one pass at a time. Without training rows every token has the base probability 1.
    """
    parted, n_docs, n_keys = with_buckets(docs, id_column, text_column)
    held_out = F.coalesce(remainder("doc_id", divisor) == held, F.lit(False)).alias("held_out")
    ready = parted.select("doc_id", "text", "bucket", held_out)
    cut = lambda table: in_pieces(table.column("bucket")[0].as_py(), state_of(table))
    texts = settled_by(ready.groupBy("bucket").applyInArrow(cut, STATE), "tokens", "bucket")

    def ask(table: pa.Table) -> pa.Table:
        """The distinct words of a bucket of documents with their training counts, by their bucket, in order."""
        runs, source = Runs(table), table.column("bucket")[0].as_py()
        counts = np.bincount(runs.word, runs.train, len(runs.words)).astype(np.uint32)
        return pa.Table.from_batches([packed(bucket_of(runs.words, n_keys), source, runs.words, counts)], schema_of_packed())

    def tell(asked: pa.Table) -> pa.Table:
        """Counts of a bucket's words for all that asked, in their order; tokens and words (bucket -1)."""
        keys = [np.frombuffer(k, np.uint64) for k in asked.column("keys").to_pylist()]
        words, number = numbered(np.concatenate(keys))
        own = np.concatenate([expanded(c, np.uint32) for c in asked.column("counts").to_pylist()])
        counts = np.bincount(number, own, len(words)).astype(np.int64)
        cuts = np.split(counts[number], np.cumsum([len(k) for k in keys])[:-1])
        sums = np.array([counts.sum(), np.count_nonzero(counts)])
        told = [sums.tobytes(), *map(squeezed, cuts)]
        bucket = asked.column("bucket")[0].as_py()
        return pa.table(
            [pa.array([-1, *asked.column("source").to_pylist()], pa.int32()), pa.array([bucket] * len(told), pa.int32()),
             pa.array([b""] * len(told), pa.binary()), pa.array(told, pa.binary())],
            schema=schema_of_packed(),
        )

    def sums(batches):
        for batch in batches:
            parts = np.array([np.frombuffer(c, np.int64) for c in batch.column("counts").to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in parts.T.copy()], ["tokens", "words"])

    asked = texts.groupBy("bucket").applyInArrow(ask, PACKED)
    told = settled(asked.groupBy("bucket").applyInArrow(tell, PACKED), "words")
    parts = told.filter("bucket < 0").mapInArrow(sums, "tokens long, words long")
    total, distinct = parts.agg(F.sum("tokens"), F.sum("words")).first()
    total, distinct = total or 0, distinct or 0
    scale = float(total + distinct + 1)
    limits = (max(least_share * total, least_count, 1), max(hot * total, 1))

    def runs_of(texts: pa.Table, heard: pa.Table, length: int, hots: list) -> Runs:
        """The runs of a bucket after the answers of all lengths below ``length``."""
        runs, told = Runs(texts), {}
        columns = (heard.column(c).to_pylist() for c in ("source", "keys", "counts"))
        for source, keys, counts in zip(*columns):
            told.setdefault(source // (2 * n_keys), {})[source % (2 * n_keys)] = (keys, counts)
        number = np.zeros(len(runs.words), np.int64)
        to = bucket_of(runs.words, n_keys)
        for source, (_, counts) in told.get(0, {}).items():
            number[to == source] = expanded(counts, np.int64)
        runs.start(number, scale, limits)
        for i in range(1, length):
            runs.ask(i, n_keys)
            runs.hear(told.get(i, {}), i, n_keys, hots[i - 1], limits, discount)
        return runs

    def ask_runs(length: int, hots: list, part: int, parts: int):
        def run(texts: pa.Table, heard: pa.Table) -> pa.Table:
            runs = runs_of(texts, heard, length, hots)
            runs.ask(length, n_keys)
            batch = [] if not texts.num_rows else [runs.questions(texts.column("bucket")[0].as_py(), part, parts)]
            kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
            return pa.Table.from_batches(batch, pa.schema(list(zip(ASKED_NAMES, kinds))))

        return run

    def finish(texts: pa.Table, heard: pa.Table, hots: list) -> pa.Table:
        runs = runs_of(texts, heard, depth + 1, hots)
        count = runs.n
        per_row = [np.bincount(runs.rows, w, count) for w in (runs.number > 0, runs.base, runs.score)]
        types = [pa.int64(), pa.bool_()] + [pa.int64()] * 3 + [pa.float64()] * 2
        return pa.table(
            [runs.ids, pa.array(runs.held), pa.array(np.bincount(runs.rows, minlength=count)),
             pa.array(per_row[0].astype(np.int64)), pa.array(np.full(count, total, np.int64)),
             pa.array(per_row[1]), pa.array(per_row[2])], schema=pa.schema(list(zip(names, types))),
        )

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    heard, hots = told.filter("bucket >= 0"), []
    for length in range(1, depth + 1):
        told, parts = None, passes[min(length, len(passes)) - 1]
        for part in range(parts):
            asked = join_answers(texts, heard, ask_runs(length, list(hots), part, parts), ASKED)
            tell_runs = lambda table: answers(table, n_keys, limits, evidence, discount)
            more = settled(asked.groupBy("bucket").applyInArrow(tell_runs, PACKED), f"runs{length}_{part}")
            told = more if told is None else told.unionByName(more)
        hots.append(hot_contexts(told.filter("bucket < 0"), evidence))
        moved = F.col("source") + F.lit(length * 2 * n_keys).cast("int")
        heard = heard.unionByName(told.filter("bucket >= 0").withColumn("source", moved))
    return join_answers(texts, heard, lambda texts, heard: finish(texts, heard, hots), schema)


def hot_contexts(parts: DataFrame, evidence: float) -> tuple[np.ndarray, ...]:
    """Contexts dealt over many tasks, of which a length has a bounded number: count, free mass, if it stays."""

    def unpack(batches):
        for batch in batches:
            for keys, sums in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                sums = np.frombuffer(sums).reshape(-1, 4)
                columns = [np.frombuffer(keys, np.int64), *sums.T.copy()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "a", "b", "c", "d"])

    sums = parts.mapInArrow(unpack, "key long, a double, b double, c double, d double").groupBy("key")
    found = sums.agg(*[F.sum(c).alias(c) for c in "abcd"]).collect()
    keys = np.array([r.key for r in found], np.int64).view(np.uint64)
    total, distinct, free, gain = np.array([r[1:] for r in found], float).reshape(-1, 4)[np.argsort(keys)].T
    return np.sort(keys), total, free, stays(total, distinct, gain, evidence)
