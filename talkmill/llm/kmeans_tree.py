"""Nearest neighbours by inner product through a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is indexed: it goes down
the tree to its leaf.  A query visits leaves best bin first: a priority queue
holds the open subtrees by the inner product of the query with their centres,
and its best entry is opened next.  The number of leaves to visit is widened,
by a quarter each time, until the recall of calibration queries against brute
force over all vectors reaches ``TARGET``.

Leaves lie in bins of at most ``BLOCK`` vectors: small neighbours share one, a
large leaf has several.  A query goes once to each bin where it visits leaves.
A task holds one bin and streams its queries past it, so every vector moves
once, however many queries there are; only a bin with more than ``STREAM``
visitors is given to several tasks.  Of equal vectors only the ``k + 1`` smallest ids can be among
anyone's k nearest, so copies are set aside first.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from talkmill.llm.common import run_of, ship_package, stage

SAMPLE = 20_000  # vectors the tree is fitted on, at most
BRANCHES = 8
LEAF = 64  # sample vectors of a leaf, at most
TARGET = 0.97  # recall on calibration queries
CALIBRATION = 200  # calibration queries, about
BLOCK = 16_384  # vectors of a bin, at most
STREAM = 1 << 20  # queries that one task streams past a bin, about
LEAST_BLOCK = 512  # vectors of a bin, if there are fewer vectors than partitions ask for
QUERIES = 512  # queries whose visits are listed at once
CELLS = 1 << 22  # scores in memory at once
SALTS = 64


class Tree:
    """Centres of all nodes, children as ranges of node numbers, and leaf
    numbers (-1 for inner nodes)."""

    def __init__(self, sample: np.ndarray, seed: int = 5):
        random = np.random.default_rng(seed)
        self.centres, self.first, self.last, self.leaf = [sample.mean(0) if len(sample) else np.zeros(sample.shape[1])], [0], [0], [-1]
        todo, self.leaves = [(0, sample)], 0
        while todo:
            node, points = todo.pop()
            groups = self._split(points, random) if len(points) > LEAF else []
            if len(groups) < 2:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            self.first[node], self.last[node] = len(self.centres), len(self.centres) + len(groups)
            for k, group in enumerate(groups):
                self.centres.append(group.mean(0))
                self.first.append(0)
                self.last.append(0)
                self.leaf.append(-1)
                todo.append((self.first[node] + k, group))
        self.centres = np.array(self.centres)

    @staticmethod
    def _split(points: np.ndarray, random) -> list[np.ndarray]:
        centres = points[random.choice(len(points), BRANCHES, replace=False)]
        for _ in range(10):
            own = np.argmin(((centres**2).sum(1) - 2 * points @ centres.T), axis=1)
            centres = np.array([points[own == k].mean(0) if (own == k).any() else centres[k] for k in range(BRANCHES)])
        own = np.argmin(((centres**2).sum(1) - 2 * points @ centres.T), axis=1)
        return [points[own == k] for k in range(BRANCHES) if (own == k).any()]

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by the nearest centre at each node."""
        node = np.zeros(len(vectors), np.int64)
        first, last, leaf = np.array(self.first), np.array(self.last), np.array(self.leaf)
        while (open_ := leaf[node] < 0).any():
            for n in np.unique(node[open_]).tolist():
                here = np.flatnonzero(node == n)
                centres = self.centres[first[n] : last[n]]
                node[here] = first[n] + np.argmin((centres**2).sum(1) - 2 * vectors[here] @ centres.T, axis=1)
        return leaf[node]

    def visit(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        near = self.centres @ query
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
            for kid in range(self.first[node], self.last[node]):
                heapq.heappush(queue, (-near[kid], kid))
        return out


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _placed(shared):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = shared.value.place(_matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(leaf, pa.int64()), batch.column("v")], names=["id", "leaf", "v"])

    return run


def layout(sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First bin and number of bins of each leaf: neighbouring leaves share a
    bin of at most ``block`` vectors, a larger leaf has several of its own."""
    first, bins = np.zeros(len(sizes), np.int64), -(-sizes // block)
    bin_, filled = 0, 0
    for leaf, size in enumerate(sizes.tolist()):
        if filled and filled + size > block:
            bin_, filled = bin_ + 1, 0
        first[leaf] = bin_
        filled += size
        if size > block:
            bin_, filled = bin_ + int(bins[leaf]), 0
    return first, bins


def _visits(shared, first: np.ndarray, bins: np.ndarray, most: int):
    """A row for each query and bin, with the leaves to visit there."""

    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, QUERIES):
                batch = whole.slice(low, QUERIES)
                orders = [np.array(shared.value.visit(q, most), np.int64) for q in _matrix(batch.column("v"))]
                leaf = np.concatenate(orders)
                row = np.repeat(np.arange(len(orders)), [len(o) for o in orders])
                step = np.concatenate([np.arange(len(o)) for o in orders])
                times = bins[leaf]
                row, step, leaf = np.repeat(row, times), np.repeat(step, times), np.repeat(leaf, times)
                bin_ = first[leaf] + np.arange(len(leaf)) - np.repeat(np.cumsum(times) - times, times)
                order = np.lexsort((bin_, row))
                row, step, leaf, bin_ = row[order], step[order], leaf[order], bin_[order]
                starts = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(bin_) != 0)][: len(row)])
                offsets, which = pa.array(np.append(starts, len(row)).astype(np.int32)), pa.array(row[starts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(which), pa.array(bin_[starts]), batch.column("v").take(which),
                     pa.ListArray.from_arrays(offsets, pa.array(leaf.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(step.astype(np.int32)))],
                    names=["id", "bin", "v", "leaves", "steps"],
                )

    return run


FOUND = "query_id long, vec_id long, score double, step long"


def _best(asked, vectors, leaves, steps, ids, points, at, starts, k):
    """The k best points of a bin for some queries.  ``leaves`` and ``steps``
    are list columns; ``at`` and ``starts`` tell which points a leaf has."""
    rows = np.repeat(np.arange(len(asked)), pc.list_value_length(leaves).to_numpy())
    flat = leaves.flatten().to_numpy()
    place = np.minimum(np.searchsorted(at, flat), len(at) - 1)
    here = at[place] == flat
    step = np.full((len(asked), len(at)), -1, np.int64)
    step[rows[here], place[here]] = steps.flatten().to_numpy()[here]
    scores = np.full((len(asked), len(ids)), -np.inf)
    for j in range(len(at)):
        who = np.flatnonzero(step[:, j] >= 0)
        if len(who):
            scores[who, starts[j] : starts[j + 1]] = vectors[who] @ points[starts[j] : starts[j + 1]].T
    scores[asked[:, None] == ids[None, :]] = -np.inf
    edge = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(asked), -np.inf)
    # A matrix product may round equal vectors differently: a hair below the
    # edge stays, and the score is summed anew in one order for all.
    finite = np.isfinite(edge)
    edge[finite] -= 1e-12 * (1 + np.abs(edge[finite]))
    row, point = np.nonzero((scores >= edge[:, None]) & (scores > -np.inf))
    score = np.concatenate([(vectors[row[i : i + 8192]] * points[point[i : i + 8192]]).sum(axis=1) for i in range(0, len(row), 8192)] or [np.zeros(0)])
    order = np.lexsort((ids[point], -score, row))
    row, point, score = row[order], point[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    row, point, score = row[rank < k], point[rank < k], score[rank < k]
    leaf = np.searchsorted(starts, point, side="right") - 1
    return asked[row], ids[point], score, step[row, leaf]


def _runs(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    """Slices of rows of one bin, salt and kind."""
    keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("bin", "salt", "kind")])
    edges = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
    bounds = [0, *edges.tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(bounds, bounds[1:]) if b > a]


def _nearest(k: int):
    """Rows sorted by bin, a bin's vectors before its queries."""

    def bin_of(held: list[pa.RecordBatch]):
        ids = np.concatenate([h.column("id").to_numpy() for h in held])
        leaf = np.concatenate([h.column("leaf").to_numpy(zero_copy_only=False) for h in held]).astype(np.int64)
        points = np.concatenate([_matrix(h.column("v")) for h in held])
        order = np.lexsort((ids, leaf))
        ids, leaf, points = ids[order], leaf[order], points[order]
        at, starts = np.unique(leaf, return_index=True)
        return ids, points, at, np.append(starts, len(ids))

    def run(batches):
        key, held, ready = None, [], None
        for batch in batches:
            for part in _runs(batch):
                own = (part.column("bin")[0].as_py(), part.column("salt")[0].as_py())
                if own != key:
                    key, held, ready = own, [], None
                if part.column("kind")[0].as_py() == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                ready = ready or bin_of(held)
                some = max(1, CELLS // len(ready[0]))
                for low in range(0, part.num_rows, some):
                    asked = part.slice(low, some)
                    columns = _best(asked.column("id").to_numpy(), _matrix(asked.column("v")), asked.column("leaves"), asked.column("steps"), *ready, k)
                    kinds = (np.int64, np.int64, np.float64, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in FOUND.split(", ")])

    return run


def _search(points: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """The k best of each visited bin for each query."""
    visits = stage(visits, "visits")
    hot = visits.groupBy("bin").agg(F.count("*").alias("n")).where(F.col("n") > STREAM)
    hot = stage(hot.select("bin", F.ceil(F.col("n") / STREAM).cast("int").alias("salts")), "hot")
    salts = F.coalesce("salts", F.lit(1))
    nothing = F.lit(None).cast("array<int>")
    own = points.join(hot, "bin", "left").select(
        "bin", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(0).alias("kind"), "id", "leaf", "v",
        nothing.alias("leaves"), nothing.alias("steps"),
    )
    asked = visits.join(hot, "bin", "left").select(
        "bin", F.pmod(F.xxhash64("id", F.lit(3)), salts).cast("int").alias("salt"), F.lit(1).alias("kind"), "id", F.lit(None).cast("long").alias("leaf"), "v",
        "leaves", "steps",
    )
    rows = own.unionByName(asked).repartition("bin", "salt").sortWithinPartitions("bin", "salt", "kind")
    return rows.mapInArrow(_nearest(k), FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``id, v`` of vectors that can take part; zeros have one sign, so that
    equal vectors are equal arrays.  Floats stay floats on their way."""
    kind = "float" if vectors.select(F.col(f"`{embedding}`")).schema[0].dataType == ArrayType(FloatType()) else "double"
    v = F.col(f"`{embedding}`").cast(f"array<{kind}>")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.transform(v, lambda x: x + F.lit(0.0).cast(kind)).alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0))


def nearest(
    vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 20, k: int = 20, target: float = TARGET
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of each row whose id
    ``every`` divides, among all other rows.

    Nearness is the inner product in double precision; ties go to the smaller
    id.  Vectors that are null or zero, or hold null, NaN or infinity, take no
    part, nor do rows without id or (if lengths differ) with another length
    than most.  An id counts once: rows that repeat it with the same vector are
    one row, and of different vectors the one that sorts first stays.  A query
    with fewer than k candidates gets them all.  An empty table gives an empty
    one.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = usable(vectors, vec_id, embedding).withColumn("d", F.size("v"))
    length = rows.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if length is None:
        return empty
    rows = rows.where(F.col("d") == length["d"]).drop("d")
    repeated = stage(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated")
    if not repeated.isEmpty():
        one = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("v").alias("v"))
        rows = rows.join(repeated, "id", "left_anti").unionByName(one)

    # Of equal vectors the k + 1 smallest ids: first among a part of them.
    # Equal means equal in 128 bits of hash.
    copies = rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    for keys in (["h1", "h2", "salt"], ["h1", "h2"]):
        copies = copies.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("id"))).where(F.col("n") <= k + 1).drop("n")
    index = stage(copies.select("id", "v"), "candidates")
    total = index.count()
    share = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1_000_000))
    sample = index.where(share < F.lit(min(1_000_000, math.ceil(0.95 * SAMPLE / total * 1_000_000)))).orderBy("id").limit(SAMPLE).select("v").toArrow()
    shared = spark.sparkContext.broadcast(Tree(_matrix(sample.column("v")) if len(sample) else np.zeros((0, length["d"]))))
    tree = shared.value
    kind = index.schema["v"].dataType.simpleString()
    placed = stage(index.mapInArrow(_placed(shared), f"id long, leaf long, v {kind}"), "placed")

    sizes = np.zeros(tree.leaves, np.int64)
    for leaf, n in placed.groupBy("leaf").count().collect():  # a row per leaf at most
        sizes[leaf] = n
    first, bins = layout(sizes, max(LEAST_BLOCK, min(BLOCK, -(-total // run_of(spark)))))
    # A row per leaf, and a leaf has a vector of the sample at least.
    where = spark.createDataFrame([(i, int(f), int(b)) for i, (f, b) in enumerate(zip(first, bins))], "leaf long, first long, bins long")
    points = placed.join(F.broadcast(where), "leaf")
    points = points.select("id", "leaf", "v", (F.col("first") + F.pmod(F.xxhash64("id", F.lit(3)), F.col("bins"))).alias("bin"))

    queries = rows.where(F.col("id") % every == 0).withColumn("_hash", F.xxhash64("id", F.lit(23)))
    queries = stage(queries, "queries")
    asked = queries.count()
    if not asked:
        return empty

    def search(of: DataFrame, most: int) -> DataFrame:
        visits = of.select("id", "v").mapInArrow(_visits(shared, first, bins, most), f"id long, bin long, v {kind}, leaves array<int>, steps array<int>")
        return _top(_search(points, visits, k), k)

    some = queries.where(F.pmod("_hash", F.lit(max(1, asked // CALIBRATION))) == 0)
    some = stage(some if not some.isEmpty() else queries.limit(CALIBRATION), "calibration")
    # One search over all leaves gives the exact result and, by the step at
    # which each neighbour's leaf comes up, the recall at any number of visits.
    exact = search(some, tree.leaves)
    steps = {r["step"]: r["count"] for r in exact.groupBy("step").count().collect()}  # a row per leaf at most
    most = 1
    while most < tree.leaves and sum(n for step, n in steps.items() if step < most) < target * sum(steps.values()):
        most = min(math.ceil(1.25 * most), tree.leaves)
    found = stage(search(queries, most), "found")
    # Who met fewer than k candidates looks everywhere.
    enough = found.groupBy("query_id").count().where(F.col("count") >= min(k, total - 1)).select(F.col("query_id").alias("id"))
    short = stage(queries.join(enough, "id", "left_anti"), "short")
    if most < tree.leaves and not short.isEmpty():
        more = search(short, tree.leaves)
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(more)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
