"""Near copies by circulant MinHash.

1. *Signatures.*  Two permutations of the 32-bit numbers do for all
   coordinates: the first scatters the shingles, the second, shifted
   circularly by k places, orders them for coordinate k.  Coordinate k is the
   least place among a document's shingles.
2. *Classes.*  Documents with equal sets are one node from here on.
3. *Bands.*  ``ROWS`` neighbouring coordinates make one bucket key, ``BANDS``
   of them per node; nodes that share a key are candidates.  Two sets at the
   threshold of 0.8 share none with a probability of 3e-7.
4. *First links.*  Each node meets the least node it shares a bucket with: one
   pair per node, verified on the full sets.  Only connections matter, so
   buckets whose nodes are one component by now are done.
5. *Verification.*  The nodes of all other buckets meet in blocks, one row per
   node and block: whatever is connected by such buckets, or, if that is large,
   each bucket by itself, a large one in parts.  Parts that hold one component
   only do not meet each other.  In a block, nodes of different components
   whose signatures agree enough (lowest bit of each coordinate; six and a half
   deviations below the threshold) are verified on the full sets; pairs of
   candidates are never rows.
6. Components of the verified links, then back to every document of a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import arrow_bytes, by_bytes, fitting_broadcast, join_known, packed, ship_package, stage, text_of
from talkmill.llm.components import components
from talkmill.llm.hashing import mix, shingles
from talkmill.operators.ordered import ordered_scan

ROWS, BANDS = 7, 64
COORDINATES = ROWS * BANDS
WORDS = COORDINATES // 64  # longs of the bit sketch
DEVIATIONS = 6.5
CHUNK = 1 << 15  # shingles hashed at once: the arrays stay in the cache
BATCH = 2_000_000  # bytes of texts taken at once
BLOCK = 1 << 22  # shingles of the nodes that meet in one task
PAIRS = 20_000  # that one task verifies, about

FACTS = "id long, n long, c1 long, c2 long, keys array<bigint>, sketch array<bigint>"


def scatter(shingle_hashes: np.ndarray) -> np.ndarray:
    """First permutation: every shingle to its place among 2^32."""
    return (mix(shingle_hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def order(places: np.ndarray) -> np.ndarray:
    """Second permutation, a bijection of 32 bits."""
    x = places ^ (places >> np.uint32(16))
    x = x * np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row per set, one column per shift of the second permutation; empty
    sets have the largest number everywhere."""
    out = np.full((len(sets), COORDINATES), np.iinfo(np.uint32).max, np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    shifts = np.arange(COORDINATES, dtype=np.uint32)
    # Sets (pieces of long ones) that fill a chunk together.
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def put() -> None:
        places = np.concatenate([p for _, p in held])
        rows = np.array([i for i, _ in held])
        begins = np.r_[0, np.cumsum([len(p) for _, p in held])[:-1]]
        for k in shifts:
            least = np.minimum.reduceat(order(places + k), begins)
            np.minimum.at(out[:, k], rows, least)

    for i in full:
        places = scatter(sets[i])
        for begin in range(0, len(places), CHUNK):
            piece = places[begin : begin + CHUNK]
            if held and size + len(piece) > CHUNK:
                put()
                held, size = [], 0
            held.append((i, piece))
            size += len(piece)
    if held:
        put()
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; bands never share keys but by chance."""
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(found), 1))
    for r in range(ROWS):
        keys = mix(keys ^ found[:, r::ROWS].astype(np.uint64))
    return keys.view(np.int64)


def sketches(found: np.ndarray) -> np.ndarray:
    """The lowest bit of each coordinate."""
    bits = np.packbits((found & np.uint32(1)).astype(np.uint8), axis=1)
    return bits.view(np.int64)


def most_different(num: int, den: int) -> int:
    """Bits by which two sketches of sets at the threshold differ at most."""
    equal = (1 + num / den) / 2
    return int(COORDINATES * (1 - equal) + DEVIATIONS * (COORDINATES * equal * (1 - equal)) ** 0.5) + 1


def class_of(sets: list[np.ndarray]) -> np.ndarray:
    """Two sums of mixed shingles for each set: equal sets, equal sums."""
    out = np.zeros((2, len(sets)), np.uint64)
    for i, s in enumerate(sets):
        for k, salt in enumerate((0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
            out[k, i] = mix(s ^ np.uint64(salt)).sum(dtype=np.uint64)
    return out.view(np.int64)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    data, at = arrow_bytes(batch.column("text"))
    for low, high in by_bytes(np.diff(at), BATCH):
        yield batch.column("id").slice(low, high - low), shingles(data[at[low] : at[high]], at[low : high + 1] - at[low], width)


def _lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(values).ravel()))


def _prints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sets in _sets(batch, width):
                found = signatures(sets)
                classes = class_of(sets)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(classes[0]), pa.array(classes[1]), _lists(band_keys(found)), _lists(sketches(found))],
                    names=["id", "n", "c1", "c2", "keys", "sketch"],
                )

    return run


def _set_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sets in _sets(batch, width):
                classes = class_of(sets)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(classes[0]), pa.array(classes[1]),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["id", "n", "c1", "c2", "grams"],
                )

    return run


def _verify(num: int, den: int):
    """The pairs whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for one, two in zip(batch.column("own"), batch.column("other")):
                own, other = (np.frombuffer(x.as_buffer(), np.uint64) for x in (one, two))
                at = np.searchsorted(own, other)
                at[at == len(own)] = 0
                both = int((own[at] == other).sum())
                similar.append(den * both >= num * (len(own) + len(other) - both))
            keep = pa.array(similar, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("p").filter(keep), batch.column("m").filter(keep)], names=["a", "b"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``p, m`` whose full sets are similar, as ``a, b``.  Sets have
    one row per node, so the joins split a pivot with many pairs."""
    own = sets.select(F.col("node").alias("p"), F.col("grams").alias("own"))
    other = sets.select(F.col("node").alias("m"), F.col("grams").alias("other"))
    count = pairs.count()
    # Only sets of nodes in pairs are moved.
    own = own.join(fitting_broadcast(pairs.select("p").distinct(), count), "p", "left_semi")
    both = other.join(fitting_broadcast(pairs, count), "m").join(own, "p").select("p", "m", "own", "other")
    return packed(both, count, PAIRS).mapInArrow(_verify(num, den), "a long, b long")


def _compare(num: int, den: int):
    """The links of one block between nodes of different components; one link
    is enough to make two components one."""
    limit = most_different(num, den)

    def run(table: pa.Table) -> pa.Table:
        nodes, label = table.column("node").to_numpy(), table.column("component").to_numpy().copy()
        grams = [np.frombuffer(g.as_buffer(), np.uint64) for g in table.column("grams").combine_chunks()]
        sizes = np.array([len(g) for g in grams], np.int64)
        bits = np.stack([np.array(x, np.int64) for x in table.column("sketch").to_pylist()]).view(np.uint64)
        _, codes = np.unique(np.concatenate(grams), return_inverse=True)
        codes = np.split(codes, np.cumsum(sizes)[:-1])
        member = np.zeros(int(max(c.max() for c in codes)) + 1, bool)
        found: list[tuple[int, int]] = []
        for k in range(len(nodes) - 1):
            rest = slice(k + 1, None)
            other = np.flatnonzero(label[rest] != label[k]) + k + 1
            alike = np.minimum(sizes[other], sizes[k]) * den >= np.maximum(sizes[other], sizes[k]) * num
            other = other[alike]
            other = other[np.bitwise_count(bits[other] ^ bits[k]).sum(axis=1, dtype=np.int64) <= limit]
            if not len(other):
                continue
            member[codes[k]] = True
            for j in other.tolist():
                if label[j] == label[k]:
                    continue
                both = int(np.count_nonzero(member[codes[j]]))
                if den * both >= num * (sizes[k] + sizes[j] - both):
                    found.append((int(nodes[k]), int(nodes[j])))
                    label[label == label[j]] = label[k]
            member[codes[k]] = False
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _open_buckets(entries: DataFrame) -> DataFrame:
    """The entries of buckets that hold two components or more."""
    spread = entries.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    return join_known(entries, spread, "key")


def _labelled(entries: DataFrame, reached: DataFrame) -> DataFrame:
    labels = reached.select(F.col("id").alias("node"), "root")
    joined = join_known(entries.select("key", "node", "n"), labels, "node", "left")
    return joined.select("key", "node", "n", F.coalesce("root", "node").alias("component"))


def _meetings(rows: DataFrame, block: int) -> DataFrame:
    """``g, i, j, node, component``: who meets in which task, of ``g, node, n,
    component``.  A group of at most ``block`` shingles meets as a whole; a
    larger one is put in order of its components and cut, and every two parts
    meet that hold more than one component between them."""
    weights = stage(rows.groupBy("g").agg(F.sum("n").alias("w")), "weights")
    large = weights.where(F.col("w") > block).select("g")
    whole = join_known(rows, weights.where(F.col("w") <= block).select("g"), "g")
    whole = whole.select("g", F.lit(0).alias("i"), F.lit(0).alias("j"), "node", "component")
    if large.isEmpty():
        return whole
    laid = ordered_scan(rows.join(large, "g"), ["g"], [F.col("component"), F.col("node")], running_sums={"upto": "n"})
    parts = stage(laid.withColumn("part", F.floor((F.col("upto") - 1) * 2 / block).cast("int")), "parts")
    facts = stage(parts.groupBy("g", "part").agg(F.min("component").alias("low"), F.max("component").alias("high")), "facts")
    one, two = (facts.select("g", F.col("part").alias(p), F.col("low").alias(f"low_{p}"), F.col("high").alias(f"high_{p}")) for p in "ij")
    several = F.least("low_i", "low_j") < F.greatest("high_i", "high_j")
    met = stage(one.join(two, "g").where((F.col("i") <= F.col("j")) & several).select("g", "i", "j"), "met")
    columns = ["g", "i", "j", "node", "component"]
    first = parts.join(met.withColumn("part", F.col("i")), ["g", "part"]).select(*columns)
    second = parts.join(met.where("i < j").withColumn("part", F.col("j")), ["g", "part"]).select(*columns)
    return whole.unionByName(first).unionByName(second)


def similar_nodes(entries: DataFrame, sketches: DataFrame, sets: DataFrame, num: int, den: int, block: int = BLOCK) -> DataFrame:
    """``id, root`` of the nodes that verified links connect.

    ``entries``: ``key, node, n``, one row per bucket and node; ``sketches``:
    ``node, sketch``; ``sets``: ``node, grams``, one row per node.
    """
    # One pair per node: the least node of all its buckets.
    least = entries.groupBy("key").agg(F.min("node").alias("p"))
    first = join_known(entries, least, "key").where("p < node").groupBy("node").agg(F.min("p").alias("p"))
    pairs = stage(first.select("p", F.col("node").alias("m")), "pairs")
    reached = stage(components(_verified(pairs, sets, num, den)), "components")
    left = stage(_open_buckets(_labelled(entries, reached)), "buckets")
    if left.isEmpty():
        return reached

    # What such buckets connect, through the least node of each.
    hubs = left.groupBy("key").agg(F.min("node").alias("p"))
    edges = join_known(left.select("key", "node"), hubs, "key").select(F.col("node").alias("a"), F.col("p").alias("b"))
    blocks = stage(components(edges).select(F.col("id").alias("node"), F.col("root").alias("g")), "blocks")
    nodes = stage(join_known(left.groupBy("node").agg(F.max("n").alias("n"), F.max("component").alias("component")), blocks, "node"), "nodes")
    large = stage(nodes.groupBy("g").agg(F.sum("n").alias("w")).where(F.col("w") > block).select("g"), "large")
    rows = nodes.join(large, "g", "left_anti").select("g", "node", "n", "component")
    if not large.isEmpty():
        of_large = nodes.join(large, "g").select("node")
        rows = rows.unionByName(join_known(left, of_large, "node").select(F.col("key").alias("g"), "node", "n", "component"))
    met = _meetings(stage(rows, "rows"), block)
    told = met.join(sets, "node").join(sketches, "node").select("g", "i", "j", "node", "component", "sketch", "grams")
    links = stage(told.groupBy("g", "i", "j").applyInArrow(_compare(num, den), "a long, b long"), "links")
    known = reached.select(F.col("id").alias("a"), F.col("root").alias("b"))
    return stage(components(known.unionByName(links)), "components")


def near_copies(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 4, num: int = 80, den: int = 100, block: int = BLOCK
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row for each row of
    ``docs``.

    Words are what stands between blanks, A-Z as a-z.  Two documents are
    linked when ``den * intersection >= num * union`` of their sets of
    distinct ``width``-word runs (fewer words: one run); ``component_id`` is
    the smallest doc_id that links lead to, and the document with that doc_id
    is kept.  A null or empty text, or one without words, has no shingles and
    no link.  Rows that repeat a doc_id count as one document with all their
    sets (a row without words stays by itself); a row without doc_id takes no
    part in links, has a null component and is kept.  No group is capped.  An empty table gives an empty one.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), text_of(text).alias("text"))
    facts = stage(rows.mapInArrow(_prints(width), FACTS), "prints")
    same = ["n", "c1", "c2"]
    named = facts.where("id is not null")
    classes = stage(
        named.where("n > 0").groupBy(*same).agg(F.min("id").alias("rep")).withColumn("node", F.monotonically_increasing_id()), "classes"
    )
    # The class of each row; copies, however many, are one node below.
    documents = stage(join_known(named.select("id", *same), classes, same, "left"), "documents")
    first = classes.withColumnRenamed("rep", "id")
    # One row per node, also where rows repeat.
    marked = join_known(named, first, [*same, "id"]).select("node", "n", "keys", "sketch")
    marked = stage(marked.groupBy("node").agg(F.first(F.struct("n", "keys", "sketch")).alias("f")).select("node", "f.*"), "marked")
    entries = marked.select("node", "n", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1").select("key")
    entries = stage(join_known(entries, shared, "key").select("key", "node", "n"), "entries")
    wanted = join_known(classes, entries.select("node").distinct(), "node").select(F.col("rep").alias("id")).distinct()
    wanted = stage(wanted, "wanted")
    texts = rows.join(fitting_broadcast(wanted, wanted.count()), "id", "left_semi")
    sets = texts.mapInArrow(_set_rows(width), "id long, n long, c1 long, c2 long, grams binary")
    sets = join_known(sets, first, [*same, "id"])
    sets = stage(sets.groupBy("node").agg(F.first("grams").alias("grams")), "sets")
    reached = similar_nodes(entries, marked.select("node", "sketch"), sets, num, den, block)

    # An id with several sets connects them.
    several = documents.where("node is not null").groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("top")).where("b < top")
    several = stage(several.select("id", "b"), "several")
    if not several.isEmpty():
        joined = documents.where("node is not null").join(several, "id").select(F.col("node").alias("a"), "b")
        reached = stage(components(reached.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(joined)), "components")
    rooted = join_known(classes.select("node", "rep"), reached.withColumnRenamed("id", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    component = join_known(rooted.select("node", "root"), least, "root").select("node", "component")
    done = join_known(documents.select("id", "n", "node"), component, "node", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
    unnamed = facts.where("id is null").select(F.lit(None).cast("long").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return done.unionByName(unnamed).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
