"""Prefix trie of conversations by truncation peeling (operator 13).

A conversation is a path: one entry of fixed size per turn, its digest and its code points. Peeling goes
from the greatest depth to the root. At depth d the conversations that end there meet the nodes that are
left of depth d + 1 without their last entry; grouping by path gives the nodes of depth d with their
members, children, leaves and savings, all in that one grouping. Every depth is one Spark job over what
survives, written to the shared folder.

Depths at the top of a few very long conversations hold few paths each. As many of them as hold at most
``band`` entries together are peeled in one job, the same way, each subtree in a task of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from formtide.llm.common import materialise, partitions_of

DIGEST = 16
ENTRY = DIGEST + 4  # MD5 of role and text, code points of the text as big-endian integer
PATHS = "conv_id long, depth int, path binary"
NODES = (
    "node binary, parent binary, path binary, depth int, n_convs long, conv_id long, n_children long, "
    "n_leaves long, saved_tokens long"
)
SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def turn_entry(role: Column, text: Column) -> Column:
    """Fixed-size entry of a turn; equal turns have equal entries."""
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    points = F.lpad(F.hex(F.length(text)), 8, "0")
    return F.unhex(F.concat(F.md5(content.cast("binary")), points))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, entry``: turns from 1 by turn number (null first), then role, then text.

    Null role and text are empty; rows without a conversation id belong to none and are left out.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return turns.select(
        "conv_id", F.row_number().over(order).cast("long").alias("place"), turn_entry(F.col("role"), F.col("text")).alias("entry")
    )


def taken_over(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from the first one of its hundred."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("long")


def rebuilt_turns(turns: DataFrame, borrowed: int = 5) -> DataFrame:
    """``conv_id, place, entry`` of rebuilt conversations: the first h turns of ``conv_id - conv_id % 100``,
    then the own turns after the first h. A row without entry stands before the turns of each."""
    own = turns.filter(F.col("place") > taken_over(F.col("conv_id")))
    ids = turns.filter("place = 1").select("conv_id")
    base = turns.filter(f"conv_id % 100 = 0 AND place <= {borrowed}")
    base = base.select(F.col("conv_id").alias("_base"), "place", "entry")
    heads = ids.withColumn("_base", F.col("conv_id") - F.col("conv_id") % 100).join(base, "_base")
    heads = heads.filter(F.col("place") <= taken_over(F.col("conv_id")))
    starts = ids.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("entry"))
    return starts.unionByName(heads.select("conv_id", "place", "entry")).unionByName(own)


def as_paths(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, path`` of turns ``conv_id, place, entry``: entries end to end, in order of place.

    Turns are dealt by conversation and sorted, so a task reads one after another and holds a path of
    20 bytes a turn.
    """

    def run(batches):
        now, entries = None, []
        for batch in batches:
            done = []
            for conv, entry in zip(batch.column("conv_id").to_pylist(), batch.column("entry").to_pylist()):
                if conv != now:
                    if now is not None:
                        done.append((now, len(entries), b"".join(entries)))
                    now, entries = conv, []
                if entry is not None:
                    entries.append(entry)
            yield path_batch(done)
        if now is not None:
            yield path_batch([(now, len(entries), b"".join(entries))])

    dealt = turns.repartition(partitions_of(turns.sparkSession), "conv_id")
    return dealt.sortWithinPartitions("conv_id", "place").mapInArrow(run, PATHS)


def path_batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], []]
    kinds = [pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "depth", "path"])


def prefix(path: Column, depth: int) -> Column:
    return F.substring(path, 1, ENTRY * depth)


def last_points(path: Column) -> Column:
    """Code points of the last turn of a path."""
    return F.conv(F.hex(F.substring(path, -4, 4)), 16, 10).cast("long")


def peel_level(ended: DataFrame, above: DataFrame | None, depth: int) -> DataFrame:
    """Nodes of one depth: distinct paths that end there and the nodes above without their last entry."""
    path, none = F.col("path"), F.lit(0).cast("long")
    rows = ended.filter(F.col("depth") == depth).select(
        "path", "n_convs", "conv_id", none.alias("n_children"), none.alias("n_leaves"), none.alias("saved_tokens")
    )
    if above is not None:
        lifted = above.select(
            prefix(path, depth).alias("path"), "n_convs", "conv_id", F.lit(1).cast("long").alias("n_children"),
            "n_leaves", "saved_tokens",
        )
        rows = rows.unionByName(lifted)
    nodes = rows.groupBy("path").agg(*[F.sum(c).alias(c) for c in SUMS], F.min("conv_id").alias("conv_id"))
    own = (F.col("n_convs") - 1) * last_points(path) if depth else none
    parent = F.unhex(F.md5(prefix(path, depth - 1))) if depth else F.lit(None).cast("binary")
    return nodes.select(
        F.unhex(F.md5(path)).alias("node"), parent.alias("parent"), "path", F.lit(depth).alias("depth"), "n_convs", "conv_id",
        "n_children", F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), (F.col("saved_tokens") + own).alias("saved_tokens"),
    )


def peel_band(ended: DataFrame, above: DataFrame | None, low: int, high: int) -> DataFrame:
    """Nodes of the depths ``low + 1`` to ``high``, subtree by subtree; only those of depth ``low + 1`` keep
    their path. The band is chosen so that all its paths together have a bounded number of entries."""
    rows = ended.filter((F.col("depth") > low) & (F.col("depth") <= high)).select(
        "path", "depth", "n_convs", "conv_id", *[F.lit(0).cast("long").alias(c) for c in SUMS[1:]]
    )
    if above is not None:
        lifted = above.select(
            prefix(F.col("path"), high).alias("path"), F.lit(high).alias("depth"), "n_convs", "conv_id",
            F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        )
        rows = rows.unionByName(lifted)

    def run(table: pa.Table) -> pa.Table:
        levels: dict[int, dict] = {}
        names: dict[bytes, list] = {}  # of every path: digests of its prefixes from depth ``low`` on
        for row in table.to_pylist():
            path, depth = row["path"], row["depth"]
            if path not in names:
                digest = hashlib.md5(path[: ENTRY * low])
                names[path] = [digest.digest()]
                for d in range(low, depth):
                    digest.update(path[ENTRY * d : ENTRY * (d + 1)])
                    names[path].append(digest.digest())
            merge(levels.setdefault(depth, {}), names[path][-1], path, [row[c] for c in SUMS], row["conv_id"])
        out = []
        for depth in range(high, low, -1):
            for node, (path, sums, conv) in levels.pop(depth, {}).items():
                at = ENTRY * depth
                points = int.from_bytes(path[at - 4 : at], "big")
                n, children, leaves, saved = sums[0], sums[1], max(sums[2], 1), sums[3] + (sums[0] - 1) * points
                parent = names[path][depth - 1 - low]
                kept = path[:at] if depth == low + 1 else None
                out.append((node, parent, kept, depth, n, conv, children, leaves, saved))
                if depth > low + 1:
                    merge(levels.setdefault(depth - 1, {}), parent, path, [n, 1, leaves, saved], conv)
        columns = list(zip(*out)) if out else [[] for _ in range(9)]
        kinds = [pa.binary()] * 3 + [pa.int32()] + [pa.int64()] * 5
        names_of = [c.strip().split()[0] for c in NODES.split(",")]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names_of)

    return rows.groupBy(prefix(F.col("path"), low).alias("subtree")).applyInArrow(run, NODES)


def merge(level: dict, node: bytes, path: bytes, sums: list, conv: int) -> None:
    """Add a row to its node. ``path`` is any path through the node."""
    held = level.get(node)
    if held is None:
        level[node] = [path, sums, conv]
    else:
        held[1] = [a + b for a, b in zip(held[1], sums)]
        held[2] = min(held[2], conv)


def peel(ended: DataFrame, band: int) -> list[DataFrame]:
    """Nodes of all depths of ``path, depth, n_convs, conv_id`` (distinct paths), from the deepest on."""
    # one number per length of conversation that occurs
    ends = dict(ended.groupBy("depth").count().collect())
    found, above, high, alive = [], None, max(ends, default=-1), 0
    while high >= 0:
        low, entries, reach = high, 0, alive
        while low > 0 and entries + reach + ends.get(low, 0) <= band:
            reach += ends.get(low, 0)
            entries += reach
            low -= 1
        if low < high - 1:
            nodes = materialise(peel_band(ended, above, low, high), "nodes")
            above, high, alive = nodes.filter(F.col("depth") == low + 1), low, reach
        else:
            nodes = above = materialise(peel_level(ended, above, high), "nodes")
            alive += ends.get(high, 0)
            high -= 1
        found.append(nodes)
    return found


def ends_of(paths: DataFrame) -> DataFrame:
    """``node, ends_sha256``: hash of the ids that end at a node, ascending, joined by commas.

    Ids are sorted by range over node and id, so those of a common conversation are sorted and written out
    in many tasks; each hands on one text per node, and the task of a node hashes these one by one.
    """
    n = partitions_of(paths.sparkSession)
    rows = paths.select(F.unhex(F.md5("path")).alias("node"), "conv_id")
    ordered = rows.repartitionByRange(n, "node", "conv_id").sortWithinPartitions("node", "conv_id")

    def texts(batches):
        for batch in batches:
            out: list[tuple[bytes, int, list]] = []
            for node, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if not out or out[-1][0] != node:
                    out.append((node, conv, []))
                out[-1][2].append(str(conv))
            columns = [[x[0] for x in out], [x[1] for x in out], [",".join(x[2]) for x in out]]
            kinds = [pa.binary(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["node", "first", "ids"])

    def hashes(batches):
        now, digest = None, None
        for batch in batches:
            out = []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if node == now:
                    digest.update(b",")
                else:
                    out += [(now, digest.hexdigest())] if digest else []
                    now, digest = node, hashlib.sha256()
                digest.update(ids.encode())
            yield hash_batch(out)
        if digest:
            yield hash_batch([(now, digest.hexdigest())])

    written = ordered.mapInArrow(texts, "node binary, first long, ids string")
    dealt = written.repartition(n, "node").sortWithinPartitions("node", "first")
    return dealt.mapInArrow(hashes, "node binary, ends_sha256 string")


def hash_batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], ["node", "ends_sha256"]
    )


def prefix_trie(conversations: DataFrame, rebuild: bool = True, band: int = 1 << 14) -> DataFrame:
    """One row per node of the trie of ``conversations`` (``conv_id, turn, role, text``).

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``; a node
    goes by the smallest id of its members. ``rebuild`` puts turns of the first conversation of each hundred
    before (see ``rebuilt_turns``); without it conversations stay as they are.

    Turns go by turn number, null first, then role, then text; repeated rows are turns of their own. Null
    role or text is empty, rows without an id are left out, other columns are ignored. A table without
    conversations has no nodes. Turns are told apart by MD5.
    """
    turns = materialise(numbered_turns(conversations), "turns")
    paths = materialise(as_paths(rebuilt_turns(turns) if rebuild else with_starts(turns)), "paths")
    ended = paths.groupBy("path", "depth").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    levels = peel(materialise(ended, "ended"), band)
    if not levels:
        levels = [paths.sparkSession.createDataFrame([], NODES)]
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    nodes = nodes.drop("path")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(parents, "parent", "left")
        .join(ends_of(paths), "node", "left")
        .select(
            "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )


def with_starts(turns: DataFrame) -> DataFrame:
    starts = turns.filter("place = 1").select(
        "conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("entry")
    )
    return starts.unionByName(turns)


