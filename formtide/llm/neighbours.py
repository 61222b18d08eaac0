"""Embeddings: near duplicates by pivot permutations (operator 4), exact top-k by pivot distances (operator 8)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formtide.llm.common import materialise
from formtide.llm.graph import components, local_roots, tiled

FINITE = "{v} IS NOT NULL AND size({v}) > 0 AND forall({v}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"


def usable(vector: str) -> F.Column:
    """The vector is there and all its components are finite numbers."""
    return F.coalesce(F.expr(FINITE.format(v=f"`{vector}`")), F.lit(False))


def matrix(column, kind=np.float64) -> np.ndarray:
    """Arrow lists of one length as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind)


def pivots_of(rows: DataFrame, id_column: str, vector: str, n: int) -> np.ndarray:
    """At most ``n`` vectors, those with the smallest hash of their id: a bounded sample."""
    found = rows.orderBy(F.xxhash64(id_column, F.lit(3)), id_column).limit(n).select(vector).collect()
    return np.array([r[0] for r in found], float)


def spread_pivots(rows: DataFrame, id_column: str, vector: str, n: int, apart: float, sample: int = 16) -> np.ndarray:
    """At most ``n`` unit vectors, each the farthest from those before in a bounded sample of ``sample * n``.

    None has a cosine of ``apart`` or more with another, so a group of near copies supplies one pivot
    however many of the rows it has.
    """
    x = pivots_of(rows, id_column, vector, sample * n)
    if not len(x):
        return x
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    taken, nearest = [0], x @ x[0]
    while len(taken) < n and nearest.min() < apart:
        taken.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[taken[-1]])
    return x[taken]


def by_group(batches, columns: list[str]):
    """Arrow tables of equal keys from batches whose rows are sorted by them."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in columns)))
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            if keys[start] != now and held:
                yield now, pa.Table.from_batches(held)
                held = []
            now = keys[start]
            held.append(batch.slice(start, i - start))
            start = i
    if held:
        yield now, pa.Table.from_batches(held)


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, n_pivots: int = 64, prefix: int = 6,
                    shared: int = 2, limit: int = 1024, id_column: str = "vec_id", vector: str = "embedding",
                    group: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row; vectors link inside their group only.

    A vector is described by its ``prefix`` nearest of ``n_pivots`` pivots. Each of them is an inverted
    list (per group); two vectors that share at least ``shared`` pivots or have the same nearest pivot meet
    in the list of the first one they share, and their cosine is then taken in double precision. Lists above ``limit`` rows are tiled.
    Equal vectors enter once with their number. Rows with a null id or group, or with a vector that is
    null, zero or not finite, link with nothing; a null id has no component and is not kept.
    """
    named = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.col(group).alias("g")
    )
    nonzero = F.expr("exists(v, x -> x <> 0)")
    valid = named.filter(usable("v")).filter(nonzero & F.col("vec_id").isNotNull() & F.col("g").isNotNull())
    distinct = materialise(
        valid.groupBy("g", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("times")), "vectors"
    )
    pivots = spread_pivots(distinct, "rep", "v", n_pivots, threshold)

    def describe(batches):
        for batch in batches:
            x = matrix(batch.column("v"))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            nearest = np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("g", "v", "rep", "times")]
                + [pa.array(list(nearest), pa.list_(pa.int32()))],
                ["g", "v", "rep", "times", "pivots"],
            )

    kind = distinct.schema["g"].dataType.simpleString()
    element = distinct.schema["v"].dataType.simpleString()
    described = distinct.mapInArrow(describe, f"g {kind}, v {element}, rep long, times long, pivots array<int>")
    listed = described.select("*", F.explode("pivots").alias("pivot"))
    key = ["g", "pivot", "tile_i", "tile_j"]
    tiles = tiled(listed, ["g", "pivot"], "rep", limit).repartition(*key).sortWithinPartitions(*key)
    n_all, need = len(pivots), min(shared, len(pivots), prefix)

    def verify(batches):
        for (_, pivot, i, j), table in by_group(batches, key):
            table = table.combine_chunks()
            part, rep = table.column("part").to_numpy(), table.column("rep").to_numpy()
            x = matrix(table.column("v").combine_chunks())
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            own = np.zeros((len(rep), n_all), np.float32)
            nearest = matrix(table.column("pivots").combine_chunks(), np.int64)
            own[np.arange(len(rep))[:, None], nearest] = 1
            common = own @ own.T
            first = own[:, :pivot] @ own[:, :pivot].T < 0.5  # no smaller pivot is shared
            close = (common >= need) | (nearest[:, :1] == nearest[:, 0])
            linked = (x @ x.T >= threshold) & close & first
            if i != j:
                linked &= part[:, None] != part[None, :]
            np.fill_diagonal(linked, False)
            some = linked.any(axis=1)
            if not some.any():
                continue
            order = np.argsort(rep)
            root = np.empty(len(rep), np.int64)
            root[order] = rep[order][local_roots(linked[np.ix_(order, order)])]
            weight = linked @ table.column("times").to_numpy().astype(float)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[some]) for a in (rep, weight.astype(np.int64), root)], ["rep", "links", "root"]
            )

    found = materialise(tiles.mapInArrow(verify, "rep long, links long, root long"), "found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per_rep = (
        distinct.join(links, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select("g", "v", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"))
    )
    # by group, vector and the id's presence: a row without an id stays out of its vector's group
    ready = F.when(F.col("vec_id").isNotNull(), F.col("g"))
    rows = named.withColumn("g", ready).join(per_rep, ["g", "v"], "left")
    alone = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), alone.alias("component_id"),
        F.coalesce(F.col("vec_id") == alone, F.lit(False)).alias("kept"),
    )


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; through floating point where that is exact."""
    most = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if most * most * a.shape[1] < 2.0**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def top_k(vectors: DataFrame, is_query: Callable[[F.Column], F.Column], k: int = 5, scale: float = 256.0,
          n_pivots: int = 64, block_rows: int = 1024, query_rows: int = 256, id_column: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products of every query.

    Components become ``floor(scale * x)``. One more component lifts all vectors to one length, so that
    the highest product is the least distance. A vector's key is its nearest pivot and the distance to
    it; blocks of the index hold rows of one pivot between two distances. Queries, in blocks, first see
    the blocks whose distances are nearest to theirs; the k-th score so far then bounds, by the triangle
    inequality, the range of distances around every pivot that can still hold a better row, and only
    blocks in that range are read. Ties go to the smaller id. Vectors that are null or not finite and
    rows without an id take no part; a repeated id asks once (with its least vector) and is no candidate
    for itself. Vectors have one length.
    """
    spark = vectors.sparkSession
    whole = F.transform("v", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    named = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    base = named.filter(usable("v") & F.col("vec_id").isNotNull()).select("vec_id", whole.alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    longest = base.agg(F.max(squares)).first()[0]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if longest is None:
        return empty
    pivots = pivots_of(base, "vec_id", "v", n_pivots)
    pivot_lift = np.sqrt(np.maximum(longest - (pivots**2).sum(1), 0))

    def distances(x: np.ndarray, lift: np.ndarray) -> np.ndarray:
        """To every pivot, with the extra component ``lift``."""
        squared = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * x @ pivots.T
        return np.sqrt(np.maximum(squared + (lift[:, None] - pivot_lift[None, :]) ** 2, 0))

    def index(batches):
        for batch in batches:
            x = matrix(batch.column("v"), np.int64)
            d = distances(x.astype(float), np.sqrt(np.maximum(longest - (x.astype(float) ** 2).sum(1), 0)))
            nearest = d.argmin(axis=1)
            radius = d[np.arange(len(x)), nearest]
            ids = batch.column("vec_id").to_numpy()
            order = np.lexsort((ids, radius, nearest))
            cuts = np.flatnonzero(np.diff(nearest[order])) + 1
            rows = []
            for same in np.split(order, cuts):
                for i in range(0, len(same), block_rows):
                    own = same[i : i + block_rows]
                    rows.append((int(nearest[own[0]]), radius[own[0]], radius[own[-1]], ids[own].tobytes(), x[own].tobytes()))
            kinds = (pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary())
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["pivot", "near", "far", "ids", "rows"])

    def ask(batches):
        """Blocks of queries with their distances to all pivots (queries have no extra component)."""
        ids, vectors_ = [], []

        def block():
            x = np.vstack(vectors_)
            d = distances(x.astype(float), np.zeros(len(x)))
            return pa.RecordBatch.from_arrays(
                [pa.array([a.tobytes()], pa.binary()) for a in (np.concatenate(ids), x, d)], ["ids", "rows", "d"]
            )

        for batch in batches:
            for i in range(0, batch.num_rows, query_rows):
                part = batch.slice(i, query_rows)
                if ids and sum(map(len, ids)) + part.num_rows > query_rows:
                    yield block()
                    ids, vectors_ = [], []
                ids.append(part.column("vec_id").to_numpy())
                vectors_.append(matrix(part.column("v"), np.int64))
        if ids:
            yield block()

    blocks = materialise(base.mapInArrow(index, "pivot int, near double, far double, ids binary, rows binary"), "index")
    asked = base.filter(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = materialise(asked, "queries")
    n_queries = asked.count()
    if not n_queries:
        return empty
    queries = asked.repartition(-(-n_queries // query_rows)).mapInArrow(ask, "ids binary, rows binary, d binary")
    queries = materialise(queries.withColumn("query_block", F.monotonically_increasing_id()), "query_blocks")
    dim = pivots.shape[1]

    def seen(batches, with_bound: bool):
        """Best rows of every pair of a query block and an index block."""
        for batch in batches:
            for row in batch.to_pylist():
                q_ids = np.frombuffer(row["q_ids"], np.int64)
                q = np.frombuffer(row["q_rows"], np.int64).reshape(-1, dim)
                ids = np.frombuffer(row["ids"], np.int64)
                x = np.frombuffer(row["rows"], np.int64).reshape(-1, dim)
                least = np.full(len(q), np.iinfo(np.int64).min)
                if with_bound:
                    least = np.frombuffer(row["least"], np.int64)
                    d = np.frombuffer(row["d"]).reshape(len(q), -1)[:, row["pivot"]]
                    reach = np.frombuffer(row["reach"])
                    open_ = (d - reach <= row["far"]) & (d + reach >= row["near"])
                    q_ids, q, least = q_ids[open_], q[open_], least[open_]
                score = _product(q, x)
                out = []
                for i in range(len(q)):
                    can = np.flatnonzero((score[i] >= least[i]) & (ids != q_ids[i]))
                    best = can[np.lexsort((ids[can], -score[i][can]))[:k]]
                    out.append((np.full(len(best), q_ids[i]), ids[best], score[i][best]))
                if out:
                    a, b, c = (np.concatenate(z) for z in zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["query_block"]] * len(a), pa.int64()), *map(pa.array, (a, b, c))],
                        ["query_block", "query_id", "vec_id", "score"],
                    )

    schema = "query_block long, query_id long, vec_id long, score long"
    all_pivots = len(pivots)

    def middle(batches):
        """The pivot nearest to most queries of a block, and the queries' median distance to it."""
        for batch in batches:
            d = [np.frombuffer(b).reshape(-1, all_pivots) for b in batch.column("d").to_pylist()]
            own = [int(np.bincount(x.argmin(1), minlength=all_pivots).argmax()) for x in d]
            at = [float(np.median(x[:, p])) for x, p in zip(d, own)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_block"), pa.array(own, pa.int32()), pa.array(at)], ["query_block", "pivot", "at"]
            )

    asked_blocks = queries.select(
        "query_block", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), "d"
    )
    heads = blocks.select("pivot", "near", "far").distinct()
    places = queries.mapInArrow(middle, "query_block long, pivot int, at double")
    gap = F.greatest(F.col("near") - F.col("at"), F.col("at") - F.col("far"), F.lit(0.0))
    # a few nearest annuli per block of queries: heads are one row per block of the index
    start = places.join(heads, "pivot").withColumn("gap", gap)
    nearest = Window.partitionBy("query_block").orderBy("gap", "near", "far")
    start = start.withColumn("n", F.row_number().over(nearest)).filter("n <= 4").select("query_block", "pivot", "near", "far")
    pairs = blocks.join(start, ["pivot", "near", "far"]).join(asked_blocks, "query_block")
    ranked = Window.partitionBy("query_block", "query_id").orderBy(F.desc("score"), "vec_id")
    first = pairs.mapInArrow(lambda b: seen(b, False), schema).withColumn("rank", F.row_number().over(ranked))
    bound = first.filter(F.col("rank") == k).select("query_block", "query_id", F.col("score").alias("least"))
    bounds = bound.groupBy("query_block").agg(F.collect_list(F.struct("query_id", "least")).alias("bounds"))

    def ranges(batches):
        """For every block of queries and pivot, the distances that can still matter."""
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["q_ids"], np.int64)
                q = np.frombuffer(row["q_rows"], np.int64).reshape(-1, dim).astype(float)
                d = np.frombuffer(row["d"]).reshape(len(ids), -1)
                known = {b["query_id"]: b["least"] for b in row["bounds"] or []}
                low = np.iinfo(np.int64).min
                least = np.array([known.get(i, low) for i in ids.tolist()], np.int64)
                squared = (q**2).sum(1) + longest - 2.0 * least
                reach = np.where(least == low, np.inf, np.sqrt(np.maximum(squared, 0)) * (1 + 1e-9) + 1e-3)
                n = d.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]] * n, t) for c, t in (("query_block", pa.int64()), ("q_ids", pa.binary()), ("q_rows", pa.binary()), ("d", pa.binary()))]
                    + [pa.array([a.tobytes()] * n, pa.binary()) for a in (least, reach)]
                    + [pa.array(np.arange(n, dtype=np.int32)), pa.array((d - reach[:, None]).min(0)), pa.array((d + reach[:, None]).max(0))],
                    ["query_block", "q_ids", "q_rows", "d", "least", "reach", "pivot", "low", "high"],
                )

    wanted = asked_blocks.join(bounds, "query_block", "left").mapInArrow(
        ranges,
        "query_block long, q_ids binary, q_rows binary, d binary, least binary, reach binary,"
        " pivot int, low double, high double",
    )
    pairs = blocks.join(wanted, "pivot").filter("near <= high AND far >= low")
    found = pairs.mapInArrow(lambda b: seen(b, True), schema)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
