"""A sparse document-term matrix in shards of rows (CSR).

1. A task counts the words of its texts with codes of its own: a vocabulary for
   some megabytes of text, and below it shards of about one megabyte.  The
   vocabulary is packed per bucket of words.
2. The buckets of all vocabularies give one dictionary: each distinct word and
   a dense number.  A word reaches its bucket once per vocabulary, however
   often it occurs, and buckets hold a bounded number of bytes.
3. The numbers come back per vocabulary and replace the codes in its shards.

No step holds more than the words of one vocabulary or one bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from talkmill.llm.common import arrow_bytes, by_bytes, run_of, ship_package, stage
from talkmill.llm.hashing import span_hashes

SHARD = 1 << 20  # bytes of text in a shard; a longer text is a shard of its own
SHARDS = 16  # shards that share a vocabulary
BUCKET = 64 << 20  # bytes of words that meet in one task, about

NUMBERED = "vocabulary long, bucket int, slot int, numbers binary, sizes binary, bytes binary"


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task in runs of about ``most`` bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(arrow_bytes(batch.column("text"))[1])
        for low, high in by_bytes(sizes, most):
            own = int(sizes[low:high].sum())
            if held and size + own > most:
                yield joined()
                held, size = [], 0
            held.append(batch.slice(low, high - low))
            size += own
    if held:
        yield joined()


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of every word of some texts, and the words as a dictionary
    array (codes by first appearance)."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    flat = lists.flatten()
    rows = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    some = pc.greater(pc.binary_length(flat), 0)
    return rows[some.to_numpy(zero_copy_only=False)], flat.filter(some).dictionary_encode()


def count_cells(rows: np.ndarray, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CSR arrays: where each row begins, its codes (ascending), their counts."""
    keys = (rows << 32) | codes
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[first, len(keys)]).astype(np.int32)
    cells = keys[first]
    indptr = np.searchsorted(cells, np.arange(n + 1) << 32).astype(np.int64)
    return indptr, (cells & 0xFFFFFFFF).astype(np.int32), counts


def _packed(words: pa.Array, slots: np.ndarray) -> tuple[list[int], list[bytes], list[bytes]]:
    """Words, already in the order of their slots, packed per slot."""
    data, at = arrow_bytes(words)
    found, begins = np.unique(slots, return_index=True)
    ends = [*begins[1:].tolist(), len(slots)]
    sizes = np.diff(at).astype(np.int32)
    pieces = [(b, e) for b, e in zip(begins.tolist(), ends)]
    return found.tolist(), [sizes[b:e].tobytes() for b, e in pieces], [data[at[b] : at[e]].tobytes() for b, e in pieces]


def unpacked(sizes: list[bytes], data: list[bytes]) -> pa.Array:
    """Packed words as one string array."""
    lengths = np.frombuffer(b"".join(sizes), np.int32)
    offsets = np.r_[0, np.cumsum(lengths, dtype=np.int64)]
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(b"".join(data)))


def _count_shards(kept: list[str], schema: pa.Schema, most: int, slots: int):
    """Rows of two kinds: shards (codes of their vocabulary), and packed words."""

    def rows_of(**values) -> pa.RecordBatch:
        n = len(next(iter(values.values())))

        def column(field: pa.Field) -> pa.Array:
            value = values.get(field.name)
            return pa.nulls(n, field.type) if value is None else value.cast(field.type) if isinstance(value, pa.Array) else pa.array(value, field.type)

        return pa.RecordBatch.from_arrays([column(f) for f in schema], schema=schema)

    def finished(number: int, shards: list[tuple]) -> Iterator[pa.RecordBatch]:
        # One dictionary for all shards, its words in the order of their slots.
        unified = pa.chunked_array([coded for _, coded, _ in shards]).unify_dictionaries()
        words = unified.chunk(0).dictionary
        data, at = arrow_bytes(words)
        slot = (span_hashes(data, at[:-1], at[1:]) % np.uint64(slots)).astype(np.int32)
        order = np.argsort(slot, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        for k, ((owners, _, rows), coded) in enumerate(zip(shards, unified.chunks)):
            codes = place[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
            cells = dict(zip(("indptr", "columns", "counts"), ([x.tobytes()] for x in count_cells(owners, codes, rows.num_rows))))
            lists = {name: pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(name)) for name in kept}
            yield rows_of(vocabulary=[number], shard=[k], **cells, **lists)
        found, sizes, packed = _packed(words.take(pa.array(order)), slot[order])
        yield rows_of(vocabulary=[number] * len(found), slot=found, sizes=sizes, bytes=packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        for rows in _slices(batches, most):
            held.append((*words_of(rows.column("text")), rows.drop_columns(["text"])))
            if len(held) == SHARDS:
                yield from finished(number, held)
                held, number = [], number + 1
        if held:
            yield from finished(number, held)

    return run


def _number_words(table: pa.Table) -> pa.Table:
    """One bucket: numbers from 0 for the words of all its vocabularies, and one
    row (vocabulary null) with the distinct words in that order."""
    sizes, data = table.column("sizes").to_pylist(), table.column("bytes").to_pylist()
    coded = unpacked(sizes, data).dictionary_encode()
    numbers = coded.indices.to_numpy().astype(np.int32)
    ends = np.cumsum([len(s) // 4 for s in sizes]).tolist()
    packed = [numbers[b:e].tobytes() for b, e in zip([0, *ends[:-1]], ends)]
    bucket = table.column("bucket")[0].as_py()
    distinct, at = arrow_bytes(coded.dictionary)
    n = len(packed)
    columns = {
        "vocabulary": pa.array([*table.column("vocabulary").to_pylist(), None], pa.int64()),
        "bucket": pa.array([bucket] * (n + 1), pa.int32()),
        "slot": pa.array([*table.column("slot").to_pylist(), None], pa.int32()),
        "numbers": pa.array([*packed, None], pa.binary()),
        "sizes": pa.array([None] * n + [np.diff(at).astype(np.int32).tobytes()], pa.binary()),
        "bytes": pa.array([None] * n + [distinct.tobytes()], pa.binary()),
    }
    return pa.table(columns)


def _renumber(kept: list[str], kinds: pa.Schema):
    """The shards of one vocabulary: codes replaced by numbers of the
    dictionary, and what each row sums up to."""

    def run(shards: pa.Table, words: pa.Table) -> pa.Table:
        pieces = sorted(words.to_pylist(), key=lambda p: p["slot"])
        numbers = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(p["numbers"], np.int32) + np.int64(p["before"]) for p in pieces)])
        columns, sums, nonzero = [], [], []
        for indptr, codes, counts in zip(*(shards.column(c).combine_chunks() for c in ("indptr", "columns", "counts"))):
            indptr = np.frombuffer(indptr.as_buffer(), np.int64)
            upto = np.r_[0, np.cumsum(np.frombuffer(counts.as_buffer(), np.int32), dtype=np.int64)]
            columns.append(numbers[np.frombuffer(codes.as_buffer(), np.int32)].tobytes())
            sums.append(np.diff(upto[indptr]))
            nonzero.append(np.diff(indptr))
        made = {"columns": columns, "row_sum": sums, "nonzero": nonzero}
        return pa.table([pa.array(made[f.name], f.type) if f.name in made else shards.column(f.name).cast(f.type) for f in kinds], schema=kinds)

    return run


MATRIX = ["vocabulary", "shard", "indptr", "columns", "counts", "row_sum", "nonzero"]


def _matrix_type(rows: DataFrame, kept: list[str], sums: bool) -> T.StructType:
    ddl = "vocabulary bigint, shard int, indptr binary, columns binary, counts binary"
    fields = T.StructType.fromDDL(ddl + (", row_sum array<bigint>, nonzero array<bigint>" if sums else ""))
    return T.StructType([*fields, *(T.StructField(name, T.ArrayType(rows.schema[name].dataType)) for name in kept)])


def _unpack_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words = unpacked([row["sizes"]], [row["bytes"]])
            yield pa.RecordBatch.from_arrays(
                [words.cast(pa.string()), pa.array(np.arange(len(words), dtype=np.int64) + row["before"])], names=["word", "number"]
            )


def term_matrix(rows: DataFrame, *, shard_bytes: int = SHARD, bucket_bytes: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """The matrix of ``rows``, a frame with a string column ``text`` (not
    null) and any further columns, and its dictionary: ``word, number``, every
    distinct word once, numbered from 0 without gaps in no special order.

    Words are what stands between blanks (space, \\t to \\r), case-sensitive.
    One row per shard: ``vocabulary, shard`` name it; ``indptr``, ``columns``
    and ``counts`` are packed int64, int64 and int32 (row i of the shard has
    its cells from ``indptr[i]`` to ``indptr[i + 1]``, every column once);
    ``row_sum`` and ``nonzero`` (words and distinct words of each row) and each
    further column of ``rows`` are arrays with one entry per matrix row.  A
    text without words is an empty row; an empty table gives no shard.
    """
    spark = rows.sparkSession
    ship_package(spark)
    kept = [c for c in rows.columns if c != "text"]
    local_type, matrix_type = _matrix_type(rows, kept, False), _matrix_type(rows, kept, True)
    both = T.StructType([*local_type, *T.StructType.fromDDL("slot int, sizes binary, bytes binary")])
    # A vocabulary's words come in slots, as a shuffle's would; their number
    # follows the cluster's shuffle partitions.  A bucket is one slot or two.
    slots = 2 * run_of(spark)
    counted = stage(rows.mapInArrow(_count_shards(kept, to_arrow_schema(both), shard_bytes, slots), both), "shards")
    words = counted.where("slot is not null").select("vocabulary", "slot", "sizes", "bytes")
    size = words.agg(F.sum(F.octet_length("bytes") + F.octet_length("sizes"))).first()[0] or 0
    buckets = min(slots, max(run_of(spark), math.ceil(size / bucket_bytes)))
    grouped = words.withColumn("bucket", F.pmod("slot", F.lit(buckets))).groupBy("bucket")
    numbered = stage(grouped.applyInArrow(_number_words, NUMBERED), "numbers")
    # One row per bucket, so this window without keys stays small.
    distinct = numbered.where("vocabulary is null").select("bucket", (F.octet_length("sizes") / 4).cast("long").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(distinct.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    placed = numbered.join(offsets, "bucket")
    dictionary = placed.where("vocabulary is null").select("sizes", "bytes", "before").mapInArrow(_unpack_words, "word string, number long")
    own = placed.where("vocabulary is not null").select("vocabulary", "slot", "before", "numbers")
    shards = counted.where("shard is not null").select(*local_type.names)
    met = shards.groupBy("vocabulary").cogroup(own.groupBy("vocabulary"))
    return met.applyInArrow(_renumber(kept, to_arrow_schema(matrix_type)), matrix_type), dictionary


def row_sums(matrix: DataFrame) -> DataFrame:
    """One row per matrix row: its further columns, ``row_sum`` (words) and
    ``nonzero`` (distinct words)."""
    kept = [*matrix.columns[len(MATRIX) :], "row_sum", "nonzero"]
    return matrix.select(F.inline(F.arrays_zip(*(F.col(c) for c in kept))))
