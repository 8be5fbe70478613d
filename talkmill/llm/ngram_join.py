"""Documents whose sets of word n-grams have a Jaccard similarity of 0.75 or
more: a prefix-tree join.

1. *Support.*  A document can only be similar to another if that share of its
   n-grams also occurs elsewhere.  Every batch of documents sends each of its
   n-gram hashes once, packed per bucket of hashes; those that several of its
   documents hold are known to occur twice already, so a passage that many
   documents share costs one hash per batch.  Each bucket answers a batch with
   one packed row of counts, and a batch sums its answers per document.  The
   buckets grow in number with the corpus, so each stays a few million hashes,
   and half of a hash (the other half chooses the bucket) is enough: a wrong
   match only keeps a document in.  A bucket also names its commonest n-grams.
2. *Classes.*  Documents with equal sets are one class from here on.
3. *Order and prefixes.*  Sets of supported classes are put in one global
   order, rare n-grams first.  Similar sets share an n-gram within their first
   ``n - ceil(0.75 n) + 1``; classes that share one become candidates through
   the smallest of them, so a group gives as many links as it has members.
4. *Trie.*  Candidates are connected, and each connected block of sets meets
   in one task, where sets are stored in one trie and searched (``trie``).
   Blocks above ``BLOCK`` n-grams are cut into parts, and every two parts meet
   in a task of their own.
5. Components of the links found, then back to every document of a class.

Where most documents have near copies, every n-gram of the corpus takes part
in each step, so what a step writes counts: a hash and its holder take some
five bytes in step 1, step 3 moves prefixes only, and step 4 moves texts,
which are smaller than their hashes.  No set is stored: it is made from its
text where it is needed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import arrow_bytes, by_bytes, fitting_broadcast, free_shuffles, give_back, join_known, pick, ship_package, stage, text_of, unused
from talkmill.llm.components import components
from talkmill.llm.hashing import mix, shingles
from talkmill.llm.trie import linked
from talkmill.session import join_facts

BATCH = 2_000_000  # bytes of texts hashed at once
SENT_BYTES = 4_000_000  # bytes of texts whose hashes are sent together
BUCKET = 2_000_000  # hashes that meet in one task, about
FREQUENT = 1 << 20  # n-grams whose exact frequency orders the sets: 16 MB at most
BLOCK = 1 << 22  # n-grams of candidate sets in one task

SENT = "batch long, bucket int, owned int, gaps binary, grams binary, ids binary, sizes binary, classes binary, known binary"
ANSWER = "batch long, held int, places binary, counts binary, ids binary, sizes binary, classes binary, known binary"
SHARED = np.uint32(2**32 - 1)  # place of hashes that several documents of a batch hold
FACTS = "id long, n long, c1 long, c2 long, support long"  # of a common n-gram: its code in c1, its holders in support, else null


def _small(numbers: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes each as the largest needs."""
    most = int(numbers.max()) if len(numbers) else 0
    return numbers.astype(next(f"u{k}" for k in (1, 2, 4, 8) if most < 1 << 8 * k)).tobytes()


def _from_small(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}" if n else "u1")


def _codes(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and half of each hash: all that a bucket knows of an n-gram."""
    return (grams >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | grams & np.uint64(0xFFFFFFFF)


def _sets(table: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Ids and n-gram sets of a batch, a few megabytes at a time."""
    data, at = arrow_bytes(table.column("text"))
    ids = table.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
    for low, high in by_bytes(np.diff(at), BATCH):
        yield ids[low:high], shingles(data[at[low] : at[high]], at[low : high + 1] - at[low], width)


def _class_of(grams: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Two sums of mixed hashes for each set: equal sets, equal sums."""
    out = np.zeros((2, n), np.uint64)
    for k, salt in enumerate((0x1B873593A5A5A5A5, 0xC2B2AE3D27D4EB4F)):
        np.add.at(out[k], owner, mix(grams ^ np.uint64(salt)))
    return out.view(np.int64)


def _bucketed(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    return order, np.searchsorted(key[order], np.arange(buckets + 1))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in by_bytes(np.diff(arrow_bytes(batch.column("text"))[1]), SENT_BYTES):
            yield batch.slice(low, high - low)


def _pack_support(width: int, buckets: int):
    kind = np.uint16 if buckets < 65536 else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in _pieces(batches):
            parts = list(_sets(batch, width))
            ids = np.concatenate([i for i, _ in parts])
            sets = [s for _, found in parts for s in found]
            sizes = np.array([len(s) for s in sets], np.int64)
            grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            owner = np.repeat(np.arange(len(ids), dtype=np.uint32), sizes)
            classes = _class_of(grams, owner, len(ids))
            # Each hash once: by its holder, or by none where there are more.
            order = np.argsort(grams, kind="stable")
            grams, owner = grams[order], owner[order]
            first = np.r_[True, grams[1:] != grams[:-1]] if len(grams) else np.zeros(0, bool)
            alone = first & np.r_[first[1:], True] if len(grams) else first
            known = np.bincount(owner[~alone], minlength=len(ids))
            place = np.where(alone, owner, SHARED)[first]
            grams = grams[first]
            order = np.lexsort((place, ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(kind)))
            grams, place = grams[order], place[order]
            bounds = np.searchsorted((grams >> np.uint64(32)) % np.uint64(buckets), np.arange(buckets + 1, dtype=np.uint64))
            half = (grams & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            rows: dict[str, list] = {c.split()[0]: [] for c in SENT.split(", ")}

            def put(**values) -> None:
                for column in rows:
                    rows[column].append(values.get(column))

            for b in np.flatnonzero(np.diff(bounds)).tolist():
                # Holders ascend, with those of no holder at the end.
                own = place[bounds[b] : bounds[b + 1]]
                owned = int(np.searchsorted(own, SHARED))
                put(batch=number, bucket=b, owned=owned, gaps=_small(np.diff(own[:owned], prepend=np.uint32(0))), grams=half[bounds[b] : bounds[b + 1]].tobytes())
            # What is known of the documents themselves travels along.
            put(
                batch=number, bucket=int(mix(np.array([number], np.uint64))[0] % np.uint64(buckets)), ids=ids.tobytes(), sizes=sizes.tobytes(),
                classes=classes.tobytes(), known=known.astype(np.int64).tobytes(),
            )
            kinds = [pa.int64(), pa.int32(), pa.int32(), *(pa.binary() for _ in range(6))]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))
            number += 1
        give_back()

    return run


def _counting(most: int):
    """One bucket: for each batch, how many of a document's hashes another
    batch has sent too; and its ``most`` commonest n-grams, if they have three
    holders or more."""

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_pylist() for c in table.column_names}
        sent = [k for k, grams in enumerate(columns["grams"]) if grams is not None]
        out: dict[str, list] = {c.split()[0]: [] for c in ANSWER.split(", ")}

        def put(batch: int, **values) -> None:
            for column in out:
                out[column].append(batch if column == "batch" else values.get(column))

        for k, ids in enumerate(columns["ids"]):
            if ids is not None:
                put(columns["batch"][k], ids=ids, sizes=columns["sizes"][k], classes=columns["classes"][k], known=columns["known"][k])
        if sent:
            grams = np.concatenate([np.frombuffer(columns["grams"][k], np.uint32) for k in sent])
            lengths = [len(columns["grams"][k]) // 4 for k in sent]
            # What several documents of a batch hold has two holders at least.
            holders = np.concatenate([np.repeat(np.array([1, 2], np.int32), (columns["owned"][k], n - columns["owned"][k])) for k, n in zip(sent, lengths)])
            order = np.argsort(grams, kind="stable")
            grams = grams[order]
            begins = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
            times = np.diff(np.r_[begins, len(grams)])
            again = np.empty(len(grams), bool)
            again[order] = np.repeat(times > 1, times)
            begin = 0
            for k, n in zip(sent, lengths):
                owned = columns["owned"][k]
                places = np.cumsum(_from_small(columns["gaps"][k], owned), dtype=np.int64)[again[begin : begin + owned]]
                begin += n
                if len(places):
                    places, counts = np.unique(places, return_counts=True)
                    put(columns["batch"][k], held=len(places), places=_small(np.diff(places, prepend=0)), counts=_small(counts))
            if most:
                held = np.add.reduceat(holders[order], begins)
                top = np.flatnonzero(held > 2)
                top = top[np.argsort(-held[top], kind="stable")[:most]]
                bucket = columns["bucket"][sent[0]]
                if len(top):
                    put(-1 - bucket, ids=(grams[begins[top]].astype(np.int64) | bucket << 32).tobytes(), known=held[top].astype(np.int64).tobytes())
        kinds = [pa.int64(), pa.int32(), *(pa.binary() for _ in range(6))]
        grams = order = again = holders = None
        give_back()
        return pa.table({name: pa.array(v, k) for (name, v), k in zip(out.items(), kinds)})

    return run


_count_support = _counting(0)


def _sum_support(table: pa.Table) -> pa.Table:
    """One batch: its documents, with the answers of all buckets added up.  Or
    the common n-grams of one bucket."""
    rows = table.to_pylist()
    own = next(r for r in rows if r["ids"] is not None)
    ids, support = np.frombuffer(own["ids"], np.int64), np.frombuffer(own["known"], np.int64).copy()
    if own["sizes"] is None:
        none = pa.nulls(len(ids), pa.int64())
        return pa.table({"id": none, "n": none, "c1": pa.array(ids), "c2": none, "support": pa.array(support)})
    for r in rows:
        if r["places"] is not None:
            support[np.cumsum(_from_small(r["places"], r["held"]), dtype=np.int64)] += _from_small(r["counts"], r["held"]).astype(np.int64)
    classes = np.frombuffer(own["classes"], np.int64).reshape(2, -1)
    columns = (ids, np.frombuffer(own["sizes"], np.int64), classes[0], classes[1], support)
    return pa.table({c.split()[0]: pa.array(v) for c, v in zip(FACTS.split(", "), columns)})


def _only_sizes(width: int):
    def run(batches):
        for batch in batches:
            sizes = [len(s) for _, found in _sets(batch.set_column(0, "id", pa.array(np.zeros(batch.num_rows, np.int64))), width) for s in found]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], names=["n"])

    return run


def _spread(grams: np.ndarray, owners: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row per bucket: n-grams, and their owners as distances from the least."""
    order, bounds = _bucketed((grams >> np.uint64(32)) % np.uint64(buckets), buckets)
    grams, owners = grams[order], owners[order]
    full = np.flatnonzero(np.diff(bounds)).tolist()
    least = [owners[bounds[b] : bounds[b + 1]].min() for b in full]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(full, pa.int32()),
            pa.array(least, pa.int64()),
            pa.array([grams[bounds[b] : bounds[b + 1]].tobytes() for b in full], pa.binary()),
            pa.array([_small(owners[bounds[b] : bounds[b + 1]].view(np.uint64) - low.view(np.uint64)) for b, low in zip(full, least)], pa.binary()),
        ],
        names=["bucket", "least", "grams", "owners"],
    )


def _prefixes(frequent, width: int, coded: int, buckets: int, num: int, den: int):
    """First n-grams of each set in the global order: those that are not
    frequent by their hash, then the frequent ones by their number of holders.
    ``coded`` buckets are those of the frequent ones' codes."""

    def run(batches):
        known, counts = frequent.value
        for piece in _pieces(batches):
            grams, owners = [], []
            for ids, sets in _sets(piece, width):
                for i, s in zip(ids.tolist(), sets):
                    if not len(s):
                        continue
                    length = len(s) - -(-len(s) * num // den) + 1
                    codes = _codes(s, coded)
                    at = np.searchsorted(known, codes)
                    at[at == len(known)] = 0
                    seen = np.where(known[at] == codes, counts[at], 0) if len(known) else np.zeros(len(s), np.int64)
                    first = np.argsort(seen, kind="stable")[:length]
                    grams.append(s[first])
                    owners.append(np.full(len(first), i, np.int64))
            if grams:
                yield _spread(np.concatenate(grams), np.concatenate(owners), buckets)
        give_back()

    return run


def _share_prefix(table: pa.Table) -> pa.Table:
    """Each holder of a prefix n-gram with the smallest of its holders."""
    rows = table.select(["least", "grams", "owners"]).to_pylist()
    grams = [np.frombuffer(r["grams"], np.uint64) for r in rows]
    owners = np.concatenate([(_from_small(r["owners"], len(g)).astype(np.uint64) + np.int64(r["least"]).view(np.uint64)).view(np.int64) for r, g in zip(rows, grams)])
    grams = np.concatenate(grams)
    order = np.lexsort((owners, grams))
    grams, owners = grams[order], owners[order]
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
    least = np.repeat(owners[first], np.diff(np.r_[first, len(grams)]))
    a, b = owners[owners != least], least[owners != least]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    rows = grams = owners = least = order = None
    give_back()
    return pa.table({"a": pa.array(a[new]), "b": pa.array(b[new])})


def _meet(width: int, num: int, den: int):
    def run(table: pa.Table) -> pa.Table:
        ids, sets = [], []
        seen = set()
        for batch in table.select(["id", "text"]).combine_chunks().to_batches():
            for own, found in _sets(batch, width):
                for i, s in zip(own.tolist(), found):
                    if (i, g := s.tobytes()) not in seen:
                        seen.add((i, g))
                        ids.append(i)
                        sets.append(np.frombuffer(g, np.uint64))
        found = [(i, root) for i, root in linked(ids, sets, num, den) if i != root]
        return pa.table({"a": pa.array([i for i, _ in found], pa.int64()), "b": pa.array([r for _, r in found], pa.int64())})

    return run


def similar_documents(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 5, num: int = 75, den: int = 100
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row for each row of ``docs``.

    Words are what stands between blanks, A-Z as a-z.  Two documents are
    linked when ``den * intersection >= num * union`` of their sets of
    distinct ``width``-word runs (fewer words: one run); ``component_id`` is
    the smallest doc_id that links lead to.  A null or empty text, or one
    without words, has no shingles and no link.  Rows that repeat a doc_id
    count as one document with all their sets; a row without doc_id takes no
    part in links and has a null component.  No row is dropped, no group is
    capped.  An empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), text_of(text).alias("text"))
    named = rows.where("id is not null")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / 6 / BUCKET))
    facts = stage(
        named.mapInArrow(_pack_support(width, buckets), SENT).groupBy("bucket").applyInArrow(_counting(max(1, FREQUENT // buckets)), ANSWER)
        .groupBy("batch").applyInArrow(_sum_support, FACTS),
        "support",
    )
    free_shuffles(spark)
    documents = facts.where("n is not null").drop("support")
    # A document's own class, and whether another class can be similar to it.
    classes = stage(
        facts.where("n > 0").groupBy("n", "c1", "c2").agg(F.min("id").alias("rep"), F.max(F.col("support") * den >= F.col("n") * num).alias("live")),
        "classes",
    )
    live = stage(classes.where("live").select(F.col("rep").alias("id")).distinct(), "live")
    grams = classes.where("live").agg(F.sum("n")).first()[0] or 0
    parts = max(1, math.ceil(grams * (den - num) / den / BUCKET))

    top = facts.where("n is null").select(F.col("c1").alias("code"), F.col("support").alias("sets")).toArrow()
    known = top.column("code").to_numpy().view(np.uint64)
    order = np.argsort(known)
    frequent = spark.sparkContext.broadcast((known[order], top.column("sets").to_numpy()[order]))
    shared = (
        named.join(fitting_broadcast(live, live.count()), "id", "left_semi").select("id", "text")
        .mapInArrow(_prefixes(frequent, width, buckets, parts, num, den), "bucket int, least long, grams binary, owners binary")
        .groupBy("bucket").applyInArrow(_share_prefix, "a long, b long")
    )
    candidates = stage(components(shared), "candidates")
    del shared
    free_shuffles(spark)

    # Texts of one block of candidates meet; a large block part by part.
    weights = documents.select("id", "n").join(candidates, "id").groupBy("root").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("parts"))
    blocks = join_facts(candidates, weights, "root")
    placed = join_known(named, blocks, "id").withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "id", "text", "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    links = placed.groupBy("root", "i", "j").applyInArrow(_meet(width, num, den), "a long, b long")
    reached = stage(components(links), "components")
    del placed, links
    free_shuffles(spark)

    roots = classes.join(reached.withColumnRenamed("id", "rep"), "rep", "left").select(
        "n", "c1", "c2", F.coalesce("root", "rep").alias("component")
    )
    done = join_facts(documents, roots, ["n", "c1", "c2"], "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
    unnamed = rows.where("id is null").mapInArrow(_only_sizes(width), "n long").select(
        F.lit(None).cast("long").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
    )
    return done.unionByName(unnamed)


def one_of_each(docs: DataFrame, **named) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the
    smallest doc_id, all of a document's rows, and rows without doc_id."""
    doc_id = named.get("doc_id", "doc_id")
    found = similar_documents(docs, **named)
    (gone_id,) = unused(docs.columns, "gone")
    gone = stage(found.where("component_id <> doc_id").select(F.col("doc_id").alias(gone_id)).distinct(), "gone")
    same = F.col(f"`{doc_id}`").cast("long") == F.col(gone_id)
    return docs.join(fitting_broadcast(gone, gone.count()), same, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
