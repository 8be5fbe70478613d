"""Centroid clustering with heap-ordered bounds.

Vectors lie in packed blocks, one row per block of some thousand vectors.  For
each of its vectors a block knows the gap between the distance to the second
nearest and to the nearest centroid, and each cluster of the block keeps its
vectors in a heap by gap.  When centroids move, a vector of cluster j can only
have changed sides if its gap is used up by the drift of j and the largest
drift of the others; both only grow, so a heap holds gap plus the drift
accumulated when the vector came in, and nothing in it has to be touched as
centroids move.  A round pops the vectors whose gap has expired, scans just
those exactly, and pushes them back.  What a round changes in the sums of the
clusters travels as one small row per block and cluster.

Each round writes the blocks with their heaps as a table, so a lost executor
costs one task.  The driver holds the centroids and sums: clusters x
components numbers, whatever the size of the table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import ship_package, stage

BLOCK = 4096  # vectors in a block
LIMIT = 1 << 27  # components beyond it would not give distances that fit a long
EXACT = 1 << 52  # sums of squares below it are exact in doubles

BLOCKS = "block long, ids array<bigint>, width int, vectors binary, owner binary, heaps binary, popped long"
SEEDS = "seeds array<struct<hash:string,vec_id:bigint,vector:array<bigint>>>"
DELTAS = "deltas array<struct<cluster:int,n:bigint,sums:array<bigint>>>"


def whole_vectors(ids: pa.Array, vectors: pa.Array, hashes: pa.Array, components: int, scale: float):
    """Ids, integer components and hashes of the vectors that are kept."""
    ids_, hashes_ = ids.to_pylist(), hashes.to_pylist()
    vectors = vectors.cast(pa.list_(pa.float64()))
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    lengths = np.diff(offsets)
    valid = vectors.is_valid().to_numpy(zero_copy_only=False) & (lengths == components)
    cells = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
    rows = np.flatnonzero(valid)
    found = cells[offsets[:-1][rows][:, None] + np.arange(components)] if len(rows) else np.zeros((0, components))
    with np.errstate(over="ignore", invalid="ignore"):
        found = np.floor(scale * found)
        good = (np.abs(found) <= LIMIT).all(axis=1)  # False for NaN and infinity
    return [ids_[i] for i in rows[good]], found[good].astype(np.int64), [hashes_[i] for i in rows[good]]


def pack(values: np.ndarray) -> tuple[int, bytes]:
    """Integers in the narrowest width that holds them all."""
    most = int(np.abs(values).max()) if values.size else 0
    width = 1 if most < 1 << 7 else 2 if most < 1 << 15 else 4
    return width, values.astype(f"<i{width}").tobytes()


def unpack(width: int, data: bytes, components: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{width}").reshape(-1, components).astype(np.int64)


def _blocks(components: int, scale: float, clusters: int, size: int):
    def order(seed: tuple) -> tuple:
        return seed[0] is None, seed[0] or "", seed[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        held: list[tuple[list, np.ndarray, list]] = []

        def packed(ids: list, vectors: np.ndarray, hashes: list) -> pa.RecordBatch:
            seeds = heapq.nsmallest(clusters, zip(hashes, ids, map(tuple, vectors.tolist())), key=order)
            width, data = pack(vectors)
            values = [[block], [ids], [width], [data], [[{"hash": h, "vec_id": i, "vector": list(v)} for h, i, v in seeds]]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary(),
                     pa.list_(pa.struct([("hash", pa.string()), ("vec_id", pa.int64()), ("vector", pa.list_(pa.int64()))]))]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], names=["block", "ids", "width", "vectors", "seeds"]
            )

        def together() -> tuple[list, np.ndarray, list]:
            return [i for h in held for i in h[0]], np.concatenate([h[1] for h in held]), [x for h in held for x in h[2]]

        for batch in batches:
            found = whole_vectors(batch.column("id"), batch.column("vector"), batch.column("hash"), components, scale)
            held.append(found)
            if sum(len(h[0]) for h in held) >= size:
                ids, vectors, hashes = together()
                while len(ids) >= size:
                    yield packed(ids[:size], vectors[:size], hashes[:size])
                    ids, vectors, hashes = ids[size:], vectors[size:], hashes[size:]
                    block += 1
                held = [(ids, vectors, hashes)]
        if held:
            ids, vectors, hashes = together()
            if ids:
                yield packed(ids, vectors, hashes)

    return run


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact, one column per centroid."""
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * most * most * vectors.shape[1] < EXACT:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(1) for c in centroids], axis=1)


def nearest_with_gap(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and by how much the second
    nearest is farther, rounded down a little."""
    squares = squared_distances(vectors, centroids)
    rows = np.arange(len(squares))
    owner = squares.argmin(axis=1)
    upper = np.sqrt(squares[rows, owner].astype(np.float64))
    if squares.shape[1] == 1:
        return owner, np.full(len(squares), np.inf)
    squares[rows, owner] = np.iinfo(np.int64).max
    lower = np.sqrt(squares.min(axis=1).astype(np.float64))
    return owner, lower - upper - 1e-9 * (1 + lower)


def write_heaps(heaps: list[list[tuple[float, int]]]) -> bytes:
    sizes = np.array([len(h) for h in heaps], "<i8").tobytes()
    every = [pair for heap in heaps for pair in heap]
    keys = np.array([k for k, _ in every], "<f8").tobytes()
    return sizes + keys + np.array([r for _, r in every], "<i4").tobytes()


def read_heaps(data: bytes, clusters: int) -> list[list[tuple[float, int]]]:
    sizes = np.frombuffer(data, "<i8", clusters)
    total, at = int(sizes.sum()), 8 * clusters
    pairs = list(zip(np.frombuffer(data, "<f8", total, at).tolist(), np.frombuffer(data, "<i4", total, at + 8 * total).tolist()))
    ends = np.cumsum(sizes).tolist()
    return [pairs[end - size : end] for end, size in zip(ends, sizes.tolist())]


def expired(heaps: list[list[tuple[float, int]]], drift: np.ndarray) -> list[int]:
    """Pop the rows whose gap the accumulated drift of their cluster has used
    up."""
    out = []
    for heap, moved in zip(heaps, drift.tolist()):
        while heap and heap[0][0] <= moved:
            out.append(heapq.heappop(heap)[1])
    return out


def _changes(vectors: np.ndarray, before: np.ndarray | None, after: np.ndarray) -> list[dict]:
    """What the given vectors, moved between clusters, change in the sums."""
    out: dict[int, list] = {}
    for owners, sign in ((after, 1), (before, -1)):
        if owners is None:
            continue
        for cluster in np.unique(owners).tolist():
            own = owners == cluster
            n, sums = out.get(cluster, (0, 0))
            out[cluster] = (n + sign * int(own.sum()), sums + sign * vectors[own].sum(axis=0))
    return [{"cluster": c, "n": n, "sums": sums.tolist()} for c, (n, sums) in out.items()]


def _assign(centroids: np.ndarray, drift: np.ndarray, first: bool):
    """One round over blocks: expired vectors find their cluster again."""
    clusters, components = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                vectors = unpack(row.column("width")[0].as_py(), row.column("vectors")[0].as_py(), components)
                if first:
                    heaps: list = [[] for _ in range(clusters)]
                    owner, rows = np.zeros(len(vectors), np.int32), np.arange(len(vectors))
                else:
                    heaps = read_heaps(row.column("heaps")[0].as_py(), clusters)
                    owner = np.frombuffer(row.column("owner")[0].as_py(), "<i4").copy()
                    rows = np.array(expired(heaps, drift), np.int64)
                deltas: list = []
                if len(rows):
                    found, gap = nearest_with_gap(vectors[rows], centroids)
                    if first:
                        deltas = _changes(vectors, None, found)
                    else:
                        moved = np.flatnonzero(found != owner[rows])
                        deltas = _changes(vectors[rows[moved]], owner[rows[moved]], found[moved])
                    owner[rows] = found
                    for pair, cluster in zip(zip((gap + drift[found]).tolist(), rows.tolist()), found.tolist()):
                        heaps[cluster].append(pair) if first else heapq.heappush(heaps[cluster], pair)
                    if first:
                        for heap in heaps:
                            heapq.heapify(heap)
                changed = pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(row.column(c) for c in ("block", "ids", "width", "vectors")),
                        pa.array([owner.astype("<i4").tobytes()], pa.binary()),
                        pa.array([write_heaps(heaps)], pa.binary()),
                        pa.array([len(rows)], pa.int64()),
                        pa.array([deltas], pa.list_(changed)),
                    ],
                    names=["block", "ids", "width", "vectors", "owner", "heaps", "popped", "deltas"],
                )

    return run


def _distances(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                vectors = unpack(row.column("width")[0].as_py(), row.column("vectors")[0].as_py(), centroids.shape[1])
                owner = np.frombuffer(row.column("owner")[0].as_py(), "<i4")
                squares = ((vectors - centroids[owner]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([row.column("ids").flatten(), pa.array(owner), pa.array(squares)], names=["vec_id", "cluster", "distance"])

    return run


def _add_changes(blocks: DataFrame, totals: list[list[int]], sizes: list[int]) -> None:
    """Add the blocks' changes to the sums, exactly.  At most clusters x
    (components + 1) numbers reach the driver."""
    deltas = blocks.select(F.explode("deltas").alias("d"))
    cells = deltas.select(F.col("d.cluster").alias("cluster"), F.posexplode(F.concat(F.array("d.n"), "d.sums")).alias("place", "value"))
    for r in cells.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        if r["place"]:
            totals[r["cluster"]][r["place"] - 1] += int(r["value"])
        else:
            sizes[r["cluster"]] += int(r["value"])


def fit(
    table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = 64, clusters: int = 16, rounds: int = 3,
    scale: float = 64.0, block: int = BLOCK,
) -> tuple[DataFrame, np.ndarray, list[int]]:
    """``(blocks, centroids, scanned)``: packed blocks with every vector's
    final cluster, the centroids (fewer than asked for if there are fewer
    vectors), and how many vectors each round had to scan exactly.

    Vectors that are null, have another number of components, or a null or
    non-finite one take no part; nor do those with an integer component
    beyond 2^27, whose squared distances a long cannot hold.
    """
    ship_package(table.sparkSession)
    named = table.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = named.select("id", "vector", F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256).alias("hash"))
    first = "block long, ids array<bigint>, width int, vectors binary, " + SEEDS
    blocks = stage(rows.mapInArrow(_blocks(components, scale, clusters, block), first), "blocks")
    seeds = (
        blocks.select(F.inline("seeds"))
        .orderBy(F.col("hash").asc_nulls_last(), "vector")
        .limit(clusters)
        .collect()
    )
    centroids = np.array([r["vector"] for r in seeds], np.int64).reshape(len(seeds), components)
    blocks = blocks.drop("seeds").withColumns({c: F.lit(None).cast(t) for c, t in (("owner", "binary"), ("heaps", "binary"), ("popped", "long"))})
    if not len(seeds):
        return blocks, centroids, []
    totals, sizes = [[0] * components for _ in seeds], [0] * len(seeds)
    drift = np.zeros(len(seeds))
    scanned = []
    for turn in range(rounds + 1):
        # The last turn only assigns.
        columns = ["block", "ids", "width", "vectors", "owner", "heaps", "popped"]
        blocks = stage(blocks.select(*columns).mapInArrow(_assign(centroids, drift, turn == 0), f"{BLOCKS}, {DELTAS}"), "blocks")
        scanned.append(blocks.agg(F.sum("popped")).first()[0])
        if turn == rounds:
            break
        _add_changes(blocks, totals, sizes)
        moved = np.array(
            [[total // n for total in own] if n else old.tolist() for own, n, old in zip(totals, sizes, centroids)], np.int64
        )
        step = np.sqrt(((moved - centroids) ** 2).sum(axis=1).astype(np.float64)) * (1 + 1e-12)
        # The largest step among the other clusters, for each cluster.
        others = np.array([max((s for j, s in enumerate(step.tolist()) if j != i), default=0.0) for i in range(len(step))])
        drift = drift + step + others
        centroids = moved
    return blocks, centroids, scanned


def clustered(table: DataFrame, **named) -> DataFrame:
    """``vec_id, cluster, distance`` (squared): one row per vector that takes
    part (see ``fit``); rows that repeat a vec_id, or have none, each count.
    Start: the vectors whose ``1:<vec_id>`` has the smallest SHA-256, ties by
    components, those without vec_id last.  Ties of distance go to the smaller
    cluster; an empty cluster keeps its centroid.  No vector gives no row.
    """
    blocks, centroids, _ = fit(table, **named)
    return blocks.mapInArrow(_distances(centroids), "vec_id long, cluster int, distance long")


def cluster_report(table: DataFrame, digest, **named) -> DataFrame:
    """``clustered`` with ``cluster_inertia``, ``inertia`` and the digest
    (``digest`` of a centroid's components) of each vector's cluster.  A sum
    that a long cannot hold is null."""
    spark = table.sparkSession
    blocks, centroids, _ = fit(table, **named)
    rows = stage(blocks.mapInArrow(_distances(centroids), "vec_id long, cluster int, distance long"), "clustered")
    sums = [(r["cluster"], int(r["s"])) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()]
    whole = sum(s for _, s in sums)

    def fitting(value: int) -> int | None:
        return value if value < 1 << 63 else None

    # One row per cluster.
    facts = spark.createDataFrame(
        [(c, fitting(s), fitting(whole), digest(centroids[c].tolist())) for c, s in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
