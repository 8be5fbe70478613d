"""Byte-level BPE: encoding by ranked merges, and decoding.

Texts are cut into stretches before every blank that stands alone between two
other characters; such a blank always starts a new match of the split pattern,
so stretches can be encoded one by one.  Spark counts the distinct stretches of
the corpus.  For the commonest ones, ``KNOWN`` at most, SQL functions take the
words (the matches of the pattern) and higher-order functions fold the ranked
merges over the bytes of each distinct word: an array of byte strings, in which
each step joins the neighbouring pair of lowest rank, read from a map in a
table of one row that all tasks get; words meet it a few hundred at a time.
That table has a fixed bound and goes to all tasks.  A task codes the stretches
of a batch as a dictionary and looks them all up at once; those outside the
table (rare or longer than ``LONGEST`` bytes) are merged in the task.

Decoding is SQL: each id's bytes from a literal array, concatenated.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm.common import arrow_bytes, by_bytes, give_back, ship_package, stage, text_of

KNOWN = 1 << 17  # stretches of the table that all tasks get: 10 MB at most
RARE = 32 << 20  # bytes of other words and their ids that a task remembers
ENTRY = 200  # bytes that a remembered word costs beside its own and its ids'
LONGEST = 48  # bytes of a stretch in that table
BATCH = 1_000_000  # bytes of texts encoded at once
COUNTED = 3_000_000  # bytes of texts whose stretches are counted at once
RANK_CELLS = 1 << 14
GROUPS = 32  # of words, for each task that folds them: each group meets the ranks once
BLANKS = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])  # of one byte
LONG_BLANKS = [int.from_bytes(chr(c).encode()) for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


# Words.


def _cuts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where stretches begin: at each text, and at every blank that stands
    alone between two other characters."""
    n = len(data)
    white = np.zeros(n + 2, bool)
    inner = white[1:-1]
    np.take(BLANKS, data, out=inner)
    if n > 2:
        # Longer blanks, by their UTF-8 bytes: U+0085, U+00A0; U+1680, U+2000
        # to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
        two = np.flatnonzero((data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0)))
        lead = np.flatnonzero((data[:-2] >= 0xE1) & (data[:-2] <= 0xE3))
        code = (data[lead].astype(np.int32) << 16) | (data[lead + 1].astype(np.int32) << 8) | data[lead + 2]
        three = lead[np.isin(code, LONG_BLANKS)]
        for at_, width in ((two, 2), (three, 3)):
            for k in range(width):
                inner[at_ + k] = True
    single = data == 32
    single &= ~white[:-2]
    single &= ~white[2:]
    single[at[1:][at[1:] > 0] - 1] = False
    single[at[:-1][at[:-1] < n]] = True
    return np.flatnonzero(single)


class Stretches:
    """The distinct stretches of a batch, and which of them each text has."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        begins = _cuts(data, at)
        bounds = np.append(begins, len(data)).astype(np.int64)
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = whole.dictionary_encode()
        self.distinct, self.codes = coded.dictionary.cast(pa.large_string()), coded.indices.to_numpy()
        self.bounds = np.searchsorted(begins, at)
        self.bounds[-1] = len(begins)


def _batches(batches: Iterator[pa.RecordBatch], most: int):
    for batch in batches:
        data, at = arrow_bytes(batch.column("text"))
        for low, high in by_bytes(np.diff(at), most):
            yield batch.slice(low, high - low), Stretches(data[at[low] : at[high]], at[low : high + 1] - at[low])


def _count_stretches(batches):
    for _, found in _batches(batches, COUNTED):
        counts = pa.array(np.bincount(found.codes, minlength=len(found.distinct)))
        short = pc.less_equal(pc.binary_length(found.distinct), LONGEST)
        yield pa.RecordBatch.from_arrays([found.distinct.filter(short).cast(pa.string()), counts.filter(short)], names=["stretch", "n"])
    give_back()


# The fold.


def _literal(value: object, kind: str) -> Column:
    """A constant of a nested type; the optimizer makes it a literal."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def rank_map(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """``cells``, in one row: ranks by hex digits, dealt over cells, since a
    map is searched from its front: ``cells[crc32(key) % n][key]``.

    A table and no literal: a plan's text repeats its literals, and the driver
    makes, sends and keeps that text several times for each run."""
    cells: list[list[tuple[str, int]]] = [[] for _ in range(RANK_CELLS)]
    for word, rank in ranks.items():
        key = word.hex().upper()
        cells[zlib.crc32(key.encode()) % RANK_CELLS].append((key, rank))
    return spark.createDataFrame(pa.table({"cells": pa.array([cells], pa.list_(pa.map_(pa.string(), pa.int32())))}))


def folded_ids(word: Column, ranks: Column) -> Column:
    """Ids of a word (a string): ranked merges folded over its bytes."""

    def rank(key: Column) -> Column:
        return F.get(ranks, F.pmod(F.crc32(key.cast("binary")), F.lit(RANK_CELLS)).cast("int"))[key]

    def bound(value: Column, use) -> Column:
        """``use(value)``, with ``value`` computed once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def pair_ranks(parts: Column) -> Column:
        return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda b, i: rank(F.concat(F.get(parts, i), b)))

    def join_at(parts: Column, i: Column) -> Column:  # i from 1
        pair = F.array(F.concat(F.get(parts, i - 1), F.get(parts, i)))
        return F.concat(F.slice(parts, F.lit(1), i - 1), pair, F.slice(parts, i + 2, F.size(parts)))

    def merge(parts: Column, _: Column) -> Column:
        least = bound(pair_ranks(parts), lambda r: F.array_position(r, F.array_min(r)).cast("int"))
        return bound(least, lambda i: F.when(i.isNull(), parts).otherwise(join_at(parts, i)))

    steps = F.sequence(F.lit(1), F.greatest(F.octet_length(word) - 1, F.lit(1)))
    letters = F.regexp_extract_all(F.hex(word.cast("binary")), F.lit(".."), F.lit(0))
    folded = F.aggregate(steps, letters, merge, lambda parts: F.transform(parts, rank))
    return F.when(F.octet_length(word) == 0, F.array().cast("array<int>")).otherwise(folded)


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the same merges, in the task."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONGEST:
        return _merged_by_heap(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    none = len(ranks) << 8
    pairs = [ranks.get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pairs and (least := min(pairs)) < none:
        i = pairs.index(least)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merged_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a long word in n log n steps: pairs wait in a heap."""
    n = len(word)
    end, left = list(range(1, n + 1)), list(range(-1, n - 1))
    gone = bytearray(n)
    waiting: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(waiting, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while waiting:
        _, i, upto = heapq.heappop(waiting)
        j = end[i]
        if gone[i] or j >= n or end[j] != upto:
            continue
        gone[j] = 1
        end[i] = upto
        if upto < n:
            left[upto] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


# Documents.


class Remembered:
    """Ids of words met so far, packed, up to ``RARE`` bytes.  A full memory
    takes no more words; they are merged each time.  It ends with its task: a
    worker lives on between stages, and would keep it from all that follow."""

    def __init__(self):
        self.ids: dict[bytes, bytes] = {}
        self.size = 0

    def find(self, word: bytes, ranks: dict[bytes, int]) -> bytes:
        packed = self.ids.get(word)
        if packed is None:
            packed = np.array(merged(word, ranks), np.int32).tobytes()
            size = len(word) + len(packed) + ENTRY
            if self.size + size <= RARE and len(word) <= LONGEST:
                self.ids[word] = packed
                self.size += size
        return packed


def _encode(pattern: str, shared):
    def run(batches):
        known, ids, ranks = shared.value
        words_of = regex.compile(pattern).findall
        rare = Remembered()
        for batch, found in _batches(batches, BATCH):
            place = pc.index_in(found.distinct, value_set=known).fill_null(-1).to_numpy().copy()
            missing = np.flatnonzero(place < 0)
            extra = [
                b"".join([rare.find(word.encode(), ranks) for word in words_of(stretch)])
                for stretch in found.distinct.take(pa.array(missing)).to_pylist()
            ]
            # Ids of each distinct stretch, then of each stretch in its place.
            ends = np.cumsum([0, *(len(x) // 4 for x in extra)], dtype=np.int32)
            rest = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(extra), np.int32)))
            place[missing] = len(ids) + np.arange(len(missing))
            each = pa.concat_arrays([ids, rest]).take(pa.array(place[found.codes]))
            lists = pa.ListArray.from_arrays(each.offsets.take(pa.array(found.bounds)), each.values)
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists], names=[*kept, "ids"])
            del batch, found, place, missing, extra, rest, each, lists
        del rare
        give_back()

    return run


def _commonest(counted: DataFrame) -> DataFrame:
    """``stretch``: those that occur at least so often that ``KNOWN`` or fewer
    do.  The cut comes from a histogram of the counts, so no task sorts or
    gathers them; stretches that occur once are left to the tasks.
    """
    repeated = stage(counted.groupBy("stretch").agg(F.sum("n").alias("n")).where("n > 1"), "counts")
    # Counts up to 64, then bins of a sixteenth of a power of two: some
    # thousand rows, whatever the corpus.
    bins = F.when(F.col("n") <= 64, F.col("n").cast("double")).otherwise(F.floor(F.log2("n") * 16) / 16 + 64)
    binned = repeated.withColumn("bin", bins)
    kept, cut = 0, None
    for r in binned.groupBy("bin").agg(F.count("*").alias("stretches")).orderBy(F.desc("bin")).collect():
        kept += r["stretches"]
        if kept > KNOWN:
            break
        cut = r["bin"]
    return binned.where(F.lit(False) if cut is None else F.col("bin") >= cut).select("stretch")


def stretch_table(rows: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``stretch, ids``: the commonest stretches of column ``text``, encoded."""
    top = stage(_commonest(rows.select("text").mapInArrow(_count_stretches, "stretch string, n long")), "stretches")
    parts = max(8, rows.sparkSession.sparkContext.defaultParallelism)
    cut = F.regexp_extract_all("stretch", F.lit("(?U)" + pattern), F.lit(0))
    words = top.repartition(parts, "stretch").select("stretch", F.posexplode(cut).alias("at", "word"))
    group = F.pmod(F.xxhash64("word"), F.lit(GROUPS * parts)).alias("group")
    groups = stage(words.select("word", group).repartition(parts, "group").groupBy("group").agg(F.collect_set("word").alias("words")), "words")
    coded = F.transform("words", lambda w: F.struct(w.alias("word"), folded_ids(w, F.col("cells")).alias("ids")))
    ids = groups.crossJoin(F.broadcast(rank_map(rows.sparkSession, ranks))).select(F.inline(coded))
    # A stretch of the table has few words: at most LONGEST bytes.
    whole = F.sort_array(F.collect_list(F.struct("at", "ids")))
    return words.join(stage(ids, "ids"), "word").groupBy("stretch").agg(F.flatten(whole["ids"]).alias("ids"))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` for each row: the ids of the whole text.

    Each match of ``pattern`` is merged by itself, without special tokens.
    Null counts as empty, and an empty text has no ids; rows that repeat and
    null ids are rows like others; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    table = stretch_table(rows, ranks, pattern).toArrow().combine_chunks()
    lists = table.column("ids").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    ids = pa.ListArray.from_arrays(lists.offsets, lists.values.cast(pa.int32())) if len(lists) else pa.array([], pa.list_(pa.int32()))
    words = table.column("stretch").combine_chunks()
    words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
    shared = spark.sparkContext.broadcast((words.cast(pa.large_string()), ids, ranks))
    del table, lists, ids, words
    give_back()
    return rows.mapInArrow(_encode(pattern, shared), "doc_id long, ids array<int>")


def decoded(ids: Column, ranks: dict[bytes, int]) -> Column:
    """Bytes of an array of ids: binary pieces concatenated.  An id outside
    the vocabulary, or a null array, gives null."""
    pieces: list[str | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for word, rank in ranks.items():
        pieces[rank] = base64.b64encode(word).decode()
    # Bytes stay what they are in a string; only strings have a join.
    known = _literal(pieces, "array<binary>").cast("array<string>")
    found = F.transform(ids, lambda i: F.get(known, i))
    return F.when(~F.exists(found, lambda d: d.isNull()), F.array_join(found, "").cast("binary"))


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by one blank."""
    return F.array_join(ids.cast("array<string>"), " ")
