"""N-gram Jaccard join by chosen paths (operator 7).

In every run a set walks down a random tree: at a node it chooses each of its shingles with
probability ``breadth / |set|`` by a hash of node and shingle, and follows those it chose. Similar sets
choose the same shingles and meet again below. A node with few sets is a bucket and is compared by
brute force; a larger one is split one level further, down to ``depth``, where it is tiled. Runs are
repeated until a pair at the threshold is missed with probability below ``miss``. A pair is compared in
the smallest bucket that both share, by the exact similarity of their shingle sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import Hasher, blocks, mix, settled, spans, text_bytes, words_of
from formtide.llm.graph import components, local_roots, tiled
from formtide.llm.neighbours import by_group


LOW = np.uint64(0xFFFFFFFF)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct run of ``n`` words; a text of fewer words is one shingle."""
    starts, ends, rows = words_of(data, offsets)
    hasher.load(data)
    words = mix(hasher.of(starts, ends))
    firsts = np.searchsorted(rows, np.arange(len(offsets)))
    counts = np.diff(firsts)
    # words to take from every position on, and whether a shingle starts there
    left = firsts[rows + 1] - np.arange(len(rows))
    begins = (left >= n) | ((counts[rows] < n) & (np.arange(len(rows)) == firsts[rows]))
    at = np.flatnonzero(begins)
    found = np.zeros(len(at), np.uint64)
    for i in range(n):
        more = i < left[at]
        found[more] = found[more] * np.uint64(0x9E3779B97F4A7C13) + words[at[more] + i]
    found = mix(found + np.minimum(left[at], n).astype(np.uint64))
    order = np.lexsort((found, rows[at]))
    r, h = rows[at][order], found[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return r[new], h[new]


def runs_needed(threshold: float, breadth: float, depth: int, miss: float) -> int:
    """Runs after which a pair at the threshold has not met with probability < ``miss``, whatever its sizes.

    Both sets follow a common shingle with chance ``breadth / larger size``, and at the threshold they share
    at least ``threshold * larger size`` shingles: exactly that if the larger contains the smaller.
    """
    shared = breadth * threshold
    meet = 1.0
    for _ in range(depth):
        meet = 1 - math.exp(-shared * meet)
    return math.ceil(math.log(miss) / math.log(1 - meet))


def paths(rows: np.ndarray, tokens: np.ndarray, n: int, runs: int, depth: int, breadth: float):
    """For every level the row and key of all nodes that sets reach.

    Below the first level the high half of a key is the low half of its parent's.
    """
    sizes = np.bincount(rows, minlength=n)
    firsts = np.cumsum(sizes) - sizes
    chance = np.minimum(breadth / np.maximum(sizes, 1), 1.0)
    limit = (chance * (2.0**64 - 2049)).astype(np.uint64)
    levels = [[] for _ in range(depth)]
    for run in range(runs):
        seed = mix(np.array([run + 1], np.uint64))
        chosen = tokens * (seed | np.uint64(1)) <= limit[rows]
        row, parent = rows[chosen], np.broadcast_to(seed, int(chosen.sum()))
        key = mix(parent + mix(tokens[chosen]))
        levels[0].append((row, key))
        for level in range(1, depth):
            # every node looks at all shingles of its set
            count = sizes[row]
            node = np.repeat(np.arange(len(row)), count)
            at = firsts[row][node] + spans(count)
            chosen = tokens[at] * (mix(key)[node] | np.uint64(1)) <= limit[row][node]
            parent = key[node[chosen]]
            own = mix(parent + mix(tokens[at[chosen]])) & LOW
            row, key = row[node[chosen]], ((parent & LOW) << np.uint64(32)) | own
            levels[level].append((row, key))
    return [tuple(np.concatenate(x) for x in zip(*level)) for level in levels]


def lists(rows: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    order = np.argsort(rows, kind="stable")
    ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n))))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[order].view(np.int64)))


def similarity_classes(docs: DataFrame, threshold: float = 0.8, n: int = 5, breadth: float = 1.3, depth: int = 3,
                       miss: float = 1e-3, limit: int = 256, tile: int = 1024, id_column: str = "doc_id",
                       text_column: str = "text") -> DataFrame:
    """``doc_id, n_links, class_id, kept`` for every row: links to other rows, smallest linked id.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a text of fewer than ``n`` words is one shingle. Rows with
    equal shingle sets enter once with their number. Nodes above ``limit`` sets are split; on the last level
    they are compared in tiles of parts of ``tile`` sets. Empty and null texts have no shingle and link with
    nothing; so does a row without an id, whose class is null and which is not kept.
    """
    runs = runs_needed(threshold, breadth, depth, miss)
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    fields = [f"keys{i}" for i in range(1, depth + 1)]
    schema = "doc_id long, set long, size long, " + ", ".join(f"{f} array<long>" for f in fields)

    def digest(tokens, rows, count):
        """Identity of a set: the sum of its mixed hashes."""
        ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=count))))
        sums = np.append(np.zeros(1, np.uint64), np.cumsum(mix(tokens)))
        return mix(sums[ends[1:]] - sums[ends[:-1]]).view(np.int64)

    def walk(batches):
        hasher = Hasher()
        for batch in batches:
            for block in blocks(batch):
                rows, tokens = shingles(*text_bytes(block.column("text")), n, hasher)
                count = block.num_rows
                levels = paths(rows, tokens, count, runs, depth, breadth)
                columns = [pa.array(digest(tokens, rows, count)), pa.array(np.bincount(rows, minlength=count))]
                columns += [lists(row, key, count) for row, key in levels]
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), *columns], ["doc_id", "set", "size", *fields]
                )

    walked = settled(narrow.mapInArrow(walk, schema), "walks")
    able = walked.filter("doc_id IS NOT NULL AND size > 0")
    classes = able.groupBy("set").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("times"), *[F.first(f).alias(f) for f in fields]
    )
    classes = settled(classes, "classes")

    level = classes.select("set", F.explode("keys1").alias("key")).distinct()
    buckets = []
    for i in range(1, depth + 1):
        nodes = level.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("set")).alias("sig"))
        nodes = nodes.filter("n > 1")
        if i == depth:
            buckets.append(level.join(nodes, "key"))
            break
        buckets.append(level.join(nodes.filter(F.col("n") <= limit), "key"))
        split = level.join(nodes.filter(F.col("n") > limit).select("key"), "key")
        own = f"filter(keys{i + 1}, k -> shiftrightunsigned(k, 32) = (key & 4294967295L))"
        level = classes.join(split, "set").select("set", F.explode(F.expr(own)).alias("key")).distinct()
    members = buckets[0]
    for more in buckets[1:]:
        members = members.unionByName(more)
    members = settled(members, "members")
    # of buckets with the same sets one is enough
    chosen = members.groupBy("n", "sig").agg(F.min("key").alias("key")).select("key")
    members = members.join(chosen, "key").select("key", "set")
    keys = members.groupBy("set").agg(F.collect_set("key").alias("keys"))
    rows = members.join(keys, "set").join(classes.select("set", "rep", "times"), "set")
    group = ["key", "tile_i", "tile_j"]
    dealt = tiled(rows, ["key"], "set", tile)
    dealt = dealt.join(narrow.withColumnRenamed("doc_id", "rep"), "rep")
    dealt = dealt.repartition(*group).sortWithinPartitions(*group)

    def verify(batches):
        hasher = Hasher()
        for (key, i, j), table in by_group(batches, group):
            table = table.combine_chunks()
            size = table.num_rows
            rows, tokens = shingles(*text_bytes(table.column("text")), n, hasher)
            sets, identity = table.column("set").to_numpy(), digest(tokens, rows, size)
            # of a repeated id, the text that belongs to the class, once
            _, first = np.unique(np.where(identity == sets, sets, 0), return_index=True)
            own = np.zeros(size, bool)
            own[first] = True
            own &= identity == sets
            ids = np.flatnonzero(own)
            if len(ids) < 2:
                continue
            place = np.cumsum(own) - 1
            inside = own[rows]
            rows, tokens = place[rows[inside]], tokens[inside]
            sizes = np.bincount(rows, minlength=len(ids)).astype(float)
            common = products(rows, tokens, len(ids))
            linked = common / (sizes[:, None] + sizes[None, :] - common) >= threshold
            all_keys = table.column("keys").combine_chunks().take(pa.array(ids))
            smaller = all_keys.flatten().to_numpy()
            key_rows = np.repeat(np.arange(len(ids)), np.diff(all_keys.offsets.to_numpy()))
            before = smaller < key
            linked &= products(key_rows[before], smaller[before], len(ids)) == 0
            part = table.column("part").to_numpy()[ids]
            if i != j:
                linked &= part[:, None] != part[None, :]
            np.fill_diagonal(linked, False)
            some = linked.any(axis=1)
            if not some.any():
                continue
            sets, times = sets[ids], table.column("times").to_numpy()[ids]
            links = (linked @ times.astype(float)).astype(np.int64)
            roots = sets[local_roots(linked)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[some]) for a in (sets, links, roots)], ["set", "links", "root"]
            )

    found = settled(dealt.mapInArrow(verify, "set long, links long, root long"), "found")
    links = found.groupBy("set").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("set").alias("a"), F.col("root").alias("b")))
    joined = joined.withColumnRenamed("node", "set")
    least = joined.join(classes.select("set", "rep"), "set").groupBy("component").agg(F.min("rep").alias("class_id"))
    per_set = (
        classes.select("set", "rep", "times")
        .join(links, "set", "left")
        .join(joined.join(least, "component").select("set", "class_id"), "set", "left")
        .select("set", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("class_id", "rep").alias("class_id"))
    )
    own = F.when(F.col("doc_id").isNotNull() & (F.col("size") > 0), F.col("set"))
    result = walked.select("doc_id", own.alias("set")).join(per_set, "set", "left")
    class_id = F.coalesce("class_id", "doc_id")
    return result.select(
        "doc_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), class_id.alias("class_id"),
        F.coalesce(F.col("doc_id") == class_id, F.lit(False)).alias("kept"),
    )


def products(rows: np.ndarray, tokens: np.ndarray, n: int, width: int = 4096) -> np.ndarray:
    """Number of common tokens of every two rows, from blocks of tokens that at least two rows hold."""
    out = np.zeros((n, n))
    _, code, times = np.unique(tokens, return_inverse=True, return_counts=True)
    rows, code = rows[times[code] > 1], code[times[code] > 1]
    if not len(rows):
        return out
    order = np.argsort(code, kind="stable")
    rows, code = rows[order], code[order]
    code = np.cumsum(np.append(0, code[1:] != code[:-1]))
    cuts = np.searchsorted(code, np.arange(0, code[-1] + 1, width))
    for a, b in zip(cuts, np.append(cuts[1:], len(code))):
        held = np.zeros((n, int(code[b - 1] - code[a]) + 1), np.float32)
        held[rows[a:b], code[a:b] - code[a]] = 1
        out += held @ held.T
    return out
