"""Exact copies by an index of cuckoo filters over buckets of digests.

The index is a table: for each bucket of digests one filter (16-bit
fingerprints) and the stored keys, that is what identifies a live text: the
SHA-256 digest of the normalised text and its length.  A batch of texts meets
the index bucket by bucket.  A digest that the filter does not know is new; one
that it knows is compared with the bucket's stored keys, so a false hit never
joins two texts.  A filter that overflows is built anew, twice as large, from
the stored keys.  Deleting a digest takes its fingerprint out of the filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkmill.llm.common import SPACE, fitting_broadcast, ship_package, stage, text_of, unused
from talkmill.session import join_facts

SLOTS = 4  # fingerprints in a cell
KICKS = 200  # moves before a filter counts as full
KEYS_PER_BUCKET = 32_768  # live digests of a bucket, about

STORED = "bucket int, cells binary, digest binary, size long, copies long, chars long, doc_id long, row long"
_NAMES = [c.split()[0] for c in STORED.split(", ")]
_KINDS = [{"int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}[c.split()[1]] for c in STORED.split(", ")]


class CuckooFilter:
    """Fingerprints of digests in cells of four; each digest has two cells."""

    def __init__(self, cells: int = 64, content: bytes | None = None):
        self.slots = memoryview(bytearray(content) if content else bytearray(2 * SLOTS * cells)).cast("H")
        self.mask = len(self.slots) // SLOTS - 1  # the number of cells is a power of two

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "big") or 1
        return mark, int.from_bytes(digest[2:8], "big") & self.mask, mark

    def _other(self, cell: int, mark: int) -> int:
        return (cell ^ (mark * 0x5BD1E995)) & self.mask

    def _find(self, cell: int, mark: int) -> int:
        for at in range(cell * SLOTS, cell * SLOTS + SLOTS):
            if self.slots[at] == mark:
                return at
        return -1

    def __contains__(self, digest: bytes) -> bool:
        mark, cell, _ = self._places(digest)
        return self._find(cell, mark) >= 0 or self._find(self._other(cell, mark), mark) >= 0

    def insert(self, digest: bytes) -> bool:
        """False when there is no room; the filter must then be built anew."""
        mark, cell, seed = self._places(digest)
        for at in (cell, self._other(cell, mark)):
            free = self._find(at, 0)
            if free >= 0:
                self.slots[free] = mark
                return True
        for kick in range(KICKS):
            at = cell * SLOTS + (seed + kick) % SLOTS
            self.slots[at], mark = mark, self.slots[at]
            cell = self._other(cell, mark)
            free = self._find(cell, 0)
            if free >= 0:
                self.slots[free] = mark
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        mark, cell, _ = self._places(digest)
        for at in (self._find(cell, mark), self._find(self._other(cell, mark), mark)):
            if at >= 0:
                self.slots[at] = 0
                return True
        return False


class Bucket:
    """A filter and the stored keys it stands for."""

    def __init__(self) -> None:
        self.filter = CuckooFilter()
        self.keys: dict[bytes, list] = {}

    def put(self, digest: bytes, size: int, copies: int, best: tuple) -> None:
        """``best``: (-chars, doc_id is null, doc_id, row) of the row that stays."""
        if digest in self.filter:
            stored = self.keys.get(digest)
            if stored is not None and stored[0] == size:
                stored[1] += copies
                stored[2] = min(stored[2], best)
                return
        self.keys[digest] = [size, copies, best]
        if not self.filter.insert(digest):
            self.resize()

    def take(self, digest: bytes) -> None:
        if digest in self.filter and self.keys.pop(digest, None) is not None:
            self.filter.delete(digest)

    def resize(self) -> None:
        cells = 2 * (self.filter.mask + 1)
        while True:
            self.filter = CuckooFilter(cells)
            if all(self.filter.insert(digest) for digest in self.keys):
                return
            cells *= 2

    @classmethod
    def read(cls, table: pa.Table) -> Bucket:
        self = cls()
        for r in table.to_pylist():
            if r["cells"] is not None:
                self.filter = CuckooFilter(content=r["cells"])
            else:
                self.keys[r["digest"]] = [r["size"], r["copies"], (-r["chars"], r["doc_id"] is None, r["doc_id"] or 0, r["row"])]
        return self

    def write(self, bucket: int) -> pa.Table:
        rows = [(bucket, bytes(self.filter.slots), None, None, None, None, None, None)]
        for digest, (size, copies, (less, no_id, doc_id, row)) in self.keys.items():
            rows.append((bucket, None, digest, size, copies, -less, None if no_id else doc_id, row))
        return pa.table([pa.array(c, kind) for c, kind in zip(zip(*rows), _KINDS)], names=_NAMES)


def _combine(buckets: int):
    """Rows of a batch with one digest are one row before they are sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[bytes, list] = {}
            columns = (batch.column(c).to_pylist() for c in ("digest", "size", "chars", "doc_id", "row"))
            for digest, size, chars, doc_id, row in zip(*columns):
                mine = (-chars, doc_id is None, doc_id or 0, row)
                seen = best.get(digest)
                if seen is None:
                    best[digest] = [size, 1, mine]
                else:
                    seen[1] += 1
                    seen[2] = min(seen[2], mine)
            rows = [
                (int.from_bytes(d[8:16], "big") % buckets, None, d, size, copies, -less, None if no_id else doc_id, row)
                for d, (size, copies, (less, no_id, doc_id, row)) in best.items()
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), _KINDS)], names=_NAMES)

    return run


def _bucket_of(buckets: int) -> Column:
    """The bucket of a digest, as in ``_combine``."""
    eight = F.conv(F.hex(F.substring("digest", 9, 8)), 16, 10).cast("decimal(20,0)")
    return (eight % buckets).cast("int")


def _insert(stored: pa.Table, new: pa.Table) -> pa.Table:
    bucket = Bucket.read(stored)
    for r in new.to_pylist():
        bucket.put(r["digest"], r["size"], r["copies"], (-r["chars"], r["doc_id"] is None, r["doc_id"] or 0, r["row"]))
    return bucket.write((new if len(new) else stored).column("bucket")[0].as_py())


def _delete(stored: pa.Table, gone: pa.Table) -> pa.Table:
    bucket = Bucket.read(stored)
    for digest in gone.column("digest").to_pylist():
        bucket.take(digest)
    return bucket.write((gone if len(gone) else stored).column("bucket")[0].as_py())


@dataclass
class CuckooIndex:
    """Live digests: a table of filters and stored keys in the shared folder.

    An index that outgrows its buckets is dealt over more of them, again from
    the stored keys, so a bucket stays a task's worth of work.
    """

    table: DataFrame
    buckets: int

    @classmethod
    def empty(cls, spark: SparkSession, texts: int) -> CuckooIndex:
        ship_package(spark)
        return cls(spark.createDataFrame([], STORED), max(1, math.ceil(texts / KEYS_PER_BUCKET)))

    def keys(self) -> DataFrame:
        """``digest, size, copies, chars, doc_id, row`` of the live digests."""
        return self.table.where("digest is not null").drop("bucket", "cells")

    def insert(self, digests: DataFrame) -> CuckooIndex:
        """The index after the rows of ``digests`` (see ``digests_of``)."""
        new = digests.mapInArrow(_combine(self.buckets), STORED)
        both = self.table.groupBy("bucket").cogroup(new.groupBy("bucket")).applyInArrow(_insert, STORED)
        grown = CuckooIndex(stage(both, "cuckoo"), self.buckets)
        rows = grown.table.count()  # keys, and a filter for each bucket
        return grown.over(math.ceil(rows / KEYS_PER_BUCKET)) if rows > (2 * KEYS_PER_BUCKET + 1) * self.buckets else grown

    def over(self, buckets: int) -> CuckooIndex:
        """The same digests in another number of buckets."""
        keys = self.table.where("digest is not null").withColumn("bucket", _bucket_of(buckets))
        both = self.table.limit(0).groupBy("bucket").cogroup(keys.groupBy("bucket")).applyInArrow(_insert, STORED)
        return CuckooIndex(stage(both, "cuckoo"), buckets)

    def delete(self, digests: DataFrame) -> CuckooIndex:
        """The index without the digests in column ``digest``; unknown ones
        and nulls change nothing."""
        gone = digests.where("digest is not null").select(_bucket_of(self.buckets).alias("bucket"), "digest").distinct()
        both = self.table.groupBy("bucket").cogroup(gone.groupBy("bucket")).applyInArrow(_delete, STORED)
        return CuckooIndex(stage(both, "cuckoo"), self.buckets)


def digests_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, chars, size, digest, row``, staged: code points of the text,
    bytes and SHA-256 of the normalised text, and a number for the row."""
    plain = F.regexp_replace(text_of(text), SPACE + "+", "")
    return stage(
        docs.select(
            F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
            F.length(text_of(text)).cast("long").alias("chars"),
            F.octet_length(plain).cast("long").alias("size"),
            F.unhex(F.sha2(plain.cast("binary"), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )


def exact_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each row.

    Texts are equal when they are after deleting all blanks; null is empty.
    The row with the most code points, then the smallest doc_id (null last),
    then, of repeated rows, the first met stays: exactly one of a group has
    ``kept``.  An empty table gives an empty one.
    """
    digests = digests_of(docs, doc_id, text)
    index = CuckooIndex.empty(docs.sparkSession, digests.count()).insert(digests)
    groups = index.keys().select("digest", F.col("copies").alias("group_size"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
    return join_facts(digests, groups, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def without_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever these
    are named.  Of repeated rows one stays."""
    found = exact_copies(docs, doc_id=doc_id, text=text)
    # Ids all of whose rows go, and ids with rows of both kinds (repeated ids).
    fate = stage(
        found.groupBy("doc_id").agg(F.max("kept").alias("some"), F.min("kept").alias("all")).where("not all"), "fate"
    )
    own_fate, own_digest, sha, chars, place = unused(docs.columns, "fate", "digest", "sha", "chars", "place")
    key = F.col(f"`{doc_id}`").cast("long")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    touched = fitting_broadcast(fate.select(F.col("doc_id").alias(own_fate)), fate.count())
    stay = docs.join(touched, key.eqNullSafe(F.col(own_fate)), "left_anti").select(*columns)
    repeated = fate.where("some").select(F.col("doc_id").alias("r"))
    if repeated.isEmpty():
        return stay
    kept = found.where("kept").join(repeated, F.col("doc_id").eqNullSafe(F.col("r")), "left_semi")
    kept = kept.select(F.col("doc_id").alias(own_fate), F.col("text_sha256").alias(own_digest))
    digest = F.sha2(F.regexp_replace(text_of(text), SPACE + "+", "").cast("binary"), 256)
    # Length decides between rows of one id and one normalised text.
    again = docs.withColumns({sha: digest, chars: F.length(text_of(text))})
    again = again.join(kept, F.col(sha).eqNullSafe(F.col(own_digest)) & key.eqNullSafe(F.col(own_fate)))
    first = F.row_number().over(Window.partitionBy(sha).orderBy(F.desc(chars)))
    return stay.unionByName(again.withColumn(place, first).where(F.col(place) == 1).select(*columns))
