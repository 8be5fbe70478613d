"""Length packing, fixed-size groups and ordered export."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill import fixed
from talkmill.functions import text as tx
from talkmill.operators.conversations import KEY, TURN, TURNS_PER_BLOCK, conversation_facts, measure
from talkmill.operators.ordered import global_row_number
from talkmill.session import join_facts, stage


class Segment(NamedTuple):
    """Chunks of ``size`` rows from position ``start`` on, numbered from
    ``first_chunk``."""

    start: int
    size: int
    first_chunk: int


def packing_segments(histogram: list[tuple[int, int]], max_words: int, max_rows: int) -> list[Segment]:
    """Chunk shape of next-fit packing over rows sorted by length, longest first.

    How many rows fit into a chunk never falls along that order, so the chunks
    form at most ``max_rows`` segments of equal size.  ``histogram`` holds
    (length, rows) pairs.
    """
    pairs = sorted(histogram, reverse=True)
    ends = list(accumulate(n for _, n in pairs))
    total = ends[-1] if ends else 0

    def length_at(position: int) -> int:
        return pairs[bisect_right(ends, position)][0] if position < total else 0

    def first_fit(rows: int) -> int:
        """First position from which ``rows`` rows fit."""
        low, high = 0, total
        while low < high:
            mid = (low + high) // 2
            if sum(length_at(mid + i) for i in range(rows)) <= max_words:
                high = mid
            else:
                low = mid + 1
        return low

    segments, position, chunk = [], 0, 0
    for size in range(1, max_rows + 1):
        until = first_fit(size + 1) if size < max_rows else total
        if position >= min(until, total):
            continue
        segments.append(Segment(position, size, chunk))
        n = -(-(min(until, total) - position) // size)
        position, chunk = position + n * size, chunk + n
    return segments


def chunk_of(position: Column, segments: list[Segment]) -> tuple[Column, Column]:
    """(chunk number, slot inside the chunk) of a position."""
    chunk = slot = F.lit(None).cast("bigint")
    for s in segments:
        offset = position - F.lit(s.start)
        chunk = F.when(position >= s.start, F.lit(s.first_chunk) + F.floor(offset / s.size)).otherwise(chunk)
        slot = F.when(position >= s.start, offset % s.size).otherwise(slot)
    return chunk, slot


def split_by_length(lengths: DataFrame, max_words: int = fixed.MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(short, long): word_count below ``max_words``, or not."""
    is_short = F.col("word_count") < max_words
    return lengths.filter(is_short), lengths.filter(~is_short)


def pack(
    lengths: DataFrame,
    id_column: str,
    max_words: int = fixed.MAX_WORDS,
    max_rows: int = fixed.MAX_CONVERSATIONS,
) -> DataFrame:
    """``id, word_count, pos, chunk_id, slot`` of the short rows.

    ``pos`` is the place in (word_count descending, id) order, found by one
    range shuffle of the narrow rows; the histogram has at most ``max_words``
    rows, so the chunk shape is worked out on the driver.
    """
    return _pack_staged(stage(lengths.select(id_column, "word_count"), "lengths"), id_column, max_words, max_rows)


def _pack_staged(lengths: DataFrame, id_column: str, max_words: int, max_rows: int) -> DataFrame:
    """``pack`` over staged lengths: range partitioning reads its input twice,
    which must not count the words of every text twice."""
    short, _ = split_by_length(lengths, max_words)
    placed = global_row_number(
        short, [F.col("word_count").desc(), F.col(id_column).asc()], name="pos", start=0
    )
    histogram = [tuple(r) for r in placed.groupBy("word_count").count().collect()]
    chunk, slot = chunk_of(F.col("pos"), packing_segments(histogram, max_words, max_rows))
    return placed.select("*", chunk.alias("chunk_id"), slot.alias("slot"))


def usable(measured: DataFrame, prompt: str | None = fixed.DEFAULT_SYSTEM) -> DataFrame:
    """Conversations worth training on: no wrong script, and more than one turn
    before the first empty one (less its question).

    ``conv_id, first, stop, has_system, n_messages, word_count``: turns from
    ``stop`` on do not count; ``word_count`` includes the prompt put before a
    conversation without a system message (no prompt: nothing is put there).
    """
    prompted = 0 if prompt is None else len(prompt.split())
    facts = conversation_facts(measured).filter(~F.col("wrong") & (F.col("n_left") > 1))
    return facts.select(
        KEY,
        "first",
        "stop",
        "has_system",
        F.col("n_left").alias("n_messages"),
        (F.col("words_left") + F.when(F.col("has_system"), 0).otherwise(prompted)).alias("word_count"),
    )


def merge_chunks(turns: DataFrame, packed: DataFrame, prompt: str | None = fixed.DEFAULT_SYSTEM) -> DataFrame:
    """Turns of packed conversations as merged conversations, one row per
    message: ``chunk_id, slot, turn, role, text``.  ``packed`` carries the facts
    of ``usable``.

    The first row of a chunk (slot -1) is a system message with the text of the
    first message of its first conversation, which is the prompt where one was
    put before it; then come the user and assistant turns.
    """
    chosen = packed.select(KEY, "chunk_id", "slot", "first", "stop", "has_system")
    opens = F.col("slot") == 0
    own_first = opens if prompt is None else opens & F.col("has_system")
    placed = turns.join(chosen, KEY).filter(F.col("stop").isNull() | (F.col(TURN) < F.col("stop")))
    as_system = F.struct(F.lit(-1).cast("bigint").alias("slot"), F.lit("system").alias("role"))
    as_spoken = F.struct(F.col("slot"), F.col("role"))
    rows = placed.withColumn(
        "m",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(own_first & (F.col(TURN) == F.col("first")), as_system),
                    F.when(F.col("role").isin("user", "assistant"), as_spoken),
                )
            )
        ),
    ).select("chunk_id", "m.slot", TURN, "m.role", "text")
    if prompt is None:
        return rows
    added = chosen.filter(opens & ~F.col("has_system")).select(
        "chunk_id",
        F.lit(-1).cast("bigint").alias("slot"),
        (F.col("first") - 1).alias(TURN),
        F.lit("system").alias("role"),
        F.lit(prompt).alias("text"),
    )
    return rows.unionByName(added)


def training_messages(
    turns: DataFrame,
    max_words: int = fixed.MAX_WORDS,
    max_rows: int = fixed.MAX_CONVERSATIONS,
    prompt: str | None = fixed.DEFAULT_SYSTEM,
) -> DataFrame:
    """Cleaned, prompted and packed conversations, one row per message.

    The texts are read twice: once for the facts of every turn, once to merge.
    Everything between works on staged narrow rows.  Conversations of
    ``max_words`` words and more stay as they are: ``kind`` is "long" there,
    ``chunk_id`` their number by id, and every turn is kept.
    """
    conversations = stage(usable(measure(turns), prompt), "conversations")
    packed = _pack_staged(conversations, KEY, max_words, max_rows)
    _, long_rows = split_by_length(conversations, max_words)
    numbered = global_row_number(long_rows, [F.col(KEY)], name="chunk_id", start=0)
    merged = merge_chunks(turns, packed, prompt).withColumn("kind", F.lit("merged"))
    return merged.unionByName(long_messages(turns, numbered, prompt).withColumn("kind", F.lit("long")))


def long_messages(turns: DataFrame, numbered: DataFrame, prompt: str | None = fixed.DEFAULT_SYSTEM) -> DataFrame:
    """Turns of conversations that are not merged, in the columns of
    ``merge_chunks``; the prompt (slot -1) comes before those without a system
    message."""
    chosen = numbered.select(KEY, "chunk_id", "first", "stop", "has_system")
    kept = turns.join(chosen, KEY).filter(F.col("stop").isNull() | (F.col(TURN) < F.col("stop")))
    rows = kept.select("chunk_id", F.lit(0).cast("bigint").alias("slot"), TURN, "role", "text")
    if prompt is None:
        return rows
    added = chosen.filter(~F.col("has_system")).select(
        "chunk_id",
        F.lit(-1).cast("bigint").alias("slot"),
        (F.col("first") - 1).alias(TURN),
        F.lit("system").alias("role"),
        F.lit(prompt).alias("text"),
    )
    return rows.unionByName(added)


def training_rows(messages: DataFrame) -> DataFrame:
    """Training messages as rows ``kind, chunk_id, part, word_count, messages``.

    A merged conversation is one row (part 0), which its words bound.  A long
    one goes on in further parts, so that no row grows without limit.
    """
    block = F.floor(F.greatest(F.col(TURN), F.lit(0)) / F.lit(TURNS_PER_BLOCK))
    part = F.when(F.col("kind") == "long", block).otherwise(F.lit(0).cast("bigint"))
    said = F.array_sort(F.collect_list(F.struct("slot", TURN, "role", F.col("text").alias("content"))))
    rows = messages.withColumn("part", part).groupBy("kind", "chunk_id", "part")
    return rows.agg(
        F.sum(F.coalesce(tx.word_count(F.col("text")), F.lit(0))).alias("word_count"), said.alias("m")
    ).select(
        "kind",
        "chunk_id",
        "part",
        "word_count",
        F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"),
    )


def training_set(
    turns: DataFrame,
    max_words: int = fixed.MAX_WORDS,
    max_rows: int = fixed.MAX_CONVERSATIONS,
    prompt: str | None = fixed.DEFAULT_SYSTEM,
    size: int = fixed.GROUP_SIZE,
    drop_tail: str = "keep",
    seed: int = 0,
) -> DataFrame:
    """The training set: rows of ``training_rows`` with their ``group_id`` (per
    kind) and the ``place`` of the group in the seeded order of all groups.

    Write in the order ``place, chunk_id, part``.  Only group keys are numbered;
    the rows themselves move once, to meet their group's place.
    """
    rows = stage(training_rows(training_messages(turns, max_words, max_rows, prompt)), "training")
    is_long = F.col("kind") == "long"
    chunks = F.col("chunk_id") + 1
    n = rows.agg(F.max(F.when(is_long, chunks)).alias("long"), F.max(F.when(~is_long, chunks)).alias("merged")).first()
    total = F.when(is_long, F.lit(n["long"] or 0)).otherwise(F.lit(n["merged"] or 0))
    grouped = groups(rows, "chunk_id", total, size, drop_tail)
    key = F.md5(F.concat_ws("/", "kind", F.col("group_id").cast("string"), F.lit(str(seed))))
    keys = grouped.select("kind", "group_id").distinct()
    places = global_row_number(keys, [key.asc(), F.col("kind"), F.col("group_id")], name="place", start=0)
    return join_facts(grouped, places, ["kind", "group_id"])


def groups(
    rows: DataFrame, index: str, total: int | Column, size: int = fixed.GROUP_SIZE, drop_tail: str = "keep"
) -> DataFrame:
    """``group_id`` of rows numbered from 0 in ``index``.

    ``drop_tail="keep"`` keeps every row; ``"reference"`` always drops the last
    group, even a full one; ``"partial"`` drops it only when it is not full.
    """
    limits = {"keep": total, "reference": total - size, "partial": total - size + 1}
    if drop_tail not in limits:
        raise ValueError(f"drop_tail must be one of {sorted(limits)}")
    group = F.floor(F.col(index) / size)
    return rows.withColumn("group_id", group).filter(F.col("group_id") * size < limits[drop_tail])


def training_groups(
    lengths: DataFrame,
    id_column: str,
    max_words: int = fixed.MAX_WORDS,
    max_rows: int = fixed.MAX_CONVERSATIONS,
    size: int = fixed.GROUP_SIZE,
    drop_tail: str = "keep",
) -> DataFrame:
    """Groups of short chunks and of long rows: ``kind, group_id, item, id``;
    ``item`` is the chunk number, or the place of a long row in id order."""
    lengths = stage(lengths.select(id_column, "word_count"), "lengths")
    packed = _pack_staged(lengths, id_column, max_words, max_rows)
    n_chunks = packed.agg(F.coalesce(F.max("chunk_id") + 1, F.lit(0))).first()[0]
    _, long_rows = split_by_length(lengths, max_words)
    numbered = global_row_number(long_rows, [F.col(id_column)], name="item", start=0)
    n_long = numbered.count()
    short_groups = groups(packed.withColumn("item", F.col("chunk_id")), "item", n_chunks, size, drop_tail)
    long_groups = groups(numbered, "item", n_long, size, drop_tail)
    columns = ["group_id", "item", id_column]
    return (
        short_groups.select(F.lit("short").alias("kind"), *columns)
        .unionByName(long_groups.select(F.lit("long").alias("kind"), *columns))
    )


def shuffle_groups(grouped: DataFrame, seed: int = 0) -> DataFrame:
    """Groups in seeded random order; the order inside a group is kept."""
    mixed = grouped.withColumn("shuffle_key", F.xxhash64("kind", "group_id", F.lit(seed)))
    return mixed.orderBy("shuffle_key", "kind", "group_id", "item")


def export_chunks(
    df: DataFrame, order: list[Column], size: int = fixed.EXPORT_CHUNK, limit: int | None = None
) -> DataFrame:
    """Rows numbered in ``order`` with their export ``chunk``: all rows, or
    with ``limit`` whole chunks up to the one that reaches that many rows.
    Write with ``partitionBy("chunk")``."""
    numbered = global_row_number(df, order, name="rn").withColumn("chunk", F.floor((F.col("rn") - 1) / size))
    return numbered if limit is None else numbered.filter(F.col("chunk") < -(-limit // size))
