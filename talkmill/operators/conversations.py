"""Operators on conversations stored one row per turn.

``turns`` has ``conv_id, turn, role, text`` with (conv_id, turn) unique.  No
operator gathers a conversation: facts about one come from aggregates with
map-side combine and are joined back, so a conversation with a third of all
rows is split by the skew join or by the range layout.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmill import fixed
from talkmill.functions import messages as ms
from talkmill.functions import text as tx
from talkmill.operators.ordered import ordered_scan
from talkmill.session import join_facts

KEY, TURN = "conv_id", "turn"
TURNS_PER_BLOCK = 4096


def select_stored(
    conversations: DataFrame,
    time_start: datetime | None = None,
    time_end: datetime | None = None,
    source: str | None = None,
    only_generated: bool = True,
    columns: tuple[str, ...] = ("messages",),
    limit: int | None = None,
) -> DataFrame:
    """Stored conversations in a time range (both ends inclusive) and source;
    any ``limit`` of them, if one is given."""
    tests: list[Column] = []
    if time_start is not None:
        tests.append(F.col("time") >= F.lit(time_start))
    if time_end is not None:
        tests.append(F.col("time") <= F.lit(time_end))
    if source is not None:
        tests.append(F.col("source") == source)
    if only_generated:
        tests.append(F.col("message_generated"))
    for test in tests:
        conversations = conversations.filter(test)
    chosen = conversations.select(*columns)
    return chosen if limit is None else chosen.limit(limit)


def wrong_script_keys(turns: DataFrame) -> DataFrame:
    """Keys of conversations with a CJK character in any turn."""
    return turns.filter(tx.has_cjk(F.col("text"))).select(KEY).distinct()


def drop_wrong_script(turns: DataFrame) -> DataFrame:
    return join_facts(turns, wrong_script_keys(turns), KEY, "left_anti")


def drop_null_context(turns: DataFrame) -> DataFrame:
    """Conversations whose first message carries an empty context are dropped."""
    suspects = turns.filter(F.contains(F.lower("text"), F.lit(fixed.NULL_CONTEXT))).select(KEY, TURN)
    firsts = turns.groupBy(KEY).agg(F.min(TURN).alias(TURN))
    return join_facts(turns, suspects.join(firsts, [KEY, TURN]).select(KEY), KEY, "left_anti")


def measure(turns: DataFrame) -> DataFrame:
    """Facts of every turn: one pass over the texts, narrow rows out."""
    text = F.coalesce("text", F.lit(""))
    return turns.select(
        KEY,
        TURN,
        (F.col("role") == "assistant").alias("answer"),
        (F.col("role") == "system").alias("system"),
        (text == "").alias("empty"),
        tx.has_cjk(text).alias("wrong_script"),
        tx.word_count(text).alias("words"),
    )


def conversation_facts(measured: DataFrame) -> DataFrame:
    """Facts of every conversation from the facts of its turns: ``conv_id,
    first, cut, stop, has_system, wrong, n, n_left, words_left``.

    ``cut`` is the first empty turn; turns from ``stop`` on do not count: those
    from the cut on and, when the empty turn is the assistant's, the one before.
    ``n_left`` and ``words_left`` are what is before the stop.

    Blocks of turns are summed up first, then the blocks of a conversation: a
    conversation with a third of all rows is spread over many blocks, and what
    meets in one task is one row per block.
    """
    block = Window.partitionBy(KEY, "block").orderBy(TURN)
    marked = measured.withColumn("block", F.floor(F.col(TURN) / TURNS_PER_BLOCK)).withColumn(
        "open", ~F.bool_or("empty").over(block)
    )
    open_turn = F.when(F.col("open"), F.col(TURN))
    empty_turn = F.when(F.col("empty"), F.col(TURN))
    # Flags and numbers only: texts would turn the hash aggregate into a sort.
    blocks = marked.groupBy(KEY, "block").agg(
        F.bool_or("wrong_script").alias("wrong"),
        F.count_if("open").alias("n"),
        F.sum(F.when(F.col("open"), F.col("words"))).alias("words"),
        F.max(open_turn).alias("last"),
        F.max_by("words", open_turn).alias("last_words"),
        F.min(empty_turn).alias("cut"),
        F.min_by("answer", empty_turn).alias("answer_empty"),
        F.min(TURN).alias("first"),
        F.min_by("system", TURN).alias("has_system"),
    )
    # Blocks after the one with the first empty turn do not count.
    before = Window.partitionBy(KEY).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    here = F.col("counts")
    last_block = F.when(here & (F.col("n") > 0), F.col("block"))
    cut_block = F.when(F.col("cut").isNotNull(), F.col("block"))
    facts = (
        blocks.withColumn("counts", F.min("cut").over(before).isNull())
        .groupBy(KEY)
        .agg(
            F.bool_or("wrong").alias("wrong"),
            F.sum(F.when(here, F.col("n"))).alias("n"),
            F.coalesce(F.sum(F.when(here, F.col("words"))), F.lit(0)).alias("words"),
            F.max_by("last", last_block).alias("last"),
            F.max_by("last_words", last_block).alias("last_words"),
            F.min("cut").alias("cut"),
            F.coalesce(F.min_by("answer_empty", cut_block), F.lit(False)).alias("answer_empty"),
            F.min("first").alias("first"),
            F.min_by("has_system", "block").alias("has_system"),
        )
    )
    # The question of an empty answer goes, too, if there is one.
    dropped = (F.col("answer_empty") & (F.col("n") > 0)).cast("int")
    return facts.select(
        KEY,
        "first",
        "cut",
        F.when(dropped == 1, F.col("last")).otherwise(F.col("cut")).alias("stop"),
        "has_system",
        "wrong",
        "n",
        (F.col("n") - dropped).alias("n_left"),
        (F.col("words") - dropped * F.coalesce("last_words", F.lit(0))).alias("words_left"),
    )


def keep_valid(turns: DataFrame, on_empty: str = "truncate") -> DataFrame:
    """Turns before the first empty one (less its question, when the empty turn
    is the assistant's), of conversations with more than one turn left.

    ``on_empty="drop"`` drops a conversation with any empty turn.
    """
    if on_empty not in ("truncate", "drop"):
        raise ValueError("on_empty must be 'truncate' or 'drop'")
    facts = conversation_facts(measure(turns)).filter(F.col("n_left") > 1)
    if on_empty == "drop":
        return join_facts(turns, facts.filter(F.col("cut").isNull()).select(KEY), KEY, "left_semi")
    kept = join_facts(turns, facts.select(KEY, "stop"), KEY)
    return kept.filter(F.col("stop").isNull() | (F.col(TURN) < F.col("stop"))).select(*turns.columns)


def add_system(turns: DataFrame, prompt: str = fixed.DEFAULT_SYSTEM) -> DataFrame:
    """A system turn before the first turn where that is not one already."""
    first = turns.groupBy(KEY).agg(
        F.min(TURN).alias("first"), F.min_by(F.col("role") == "system", TURN).alias("has_system")
    )
    added = first.filter(~F.col("has_system")).select(
        KEY, (F.col("first") - 1).alias(TURN), F.lit("system").alias("role"), F.lit(prompt).alias("text")
    )
    return turns.select(KEY, TURN, "role", "text").unionByName(added)


def word_counts(turns: DataFrame) -> DataFrame:
    """``conv_id, n_messages, word_count``."""
    return turns.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.sum(F.coalesce(tx.word_count(F.col("text")), F.lit(0))).alias("word_count"),
    )


def good_pairs(turns: DataFrame, lead_ins=None, drop_first=None, refusals=None) -> DataFrame:
    """(previous turn, cleaned assistant turn) for every assistant turn that is
    no refusal: ``conv_id, pair, slot, role, text``; ``pair`` is the assistant's
    turn and ``slot`` 0 or 1.

    An opening assistant turn has no previous one and yields nothing, unless it
    is the whole conversation.
    """

    def cleaned() -> Column:
        answer = tx.strip_lead_ins(
            F.col("text"),
            fixed.LEAD_INS if lead_ins is None else lead_ins,
            fixed.DROP_FIRST_SENTENCE if drop_first is None else drop_first,
        )
        return F.when(F.col("role") == "assistant", answer).otherwise(F.col("text"))

    # Only keys and verdicts are put in order.
    refused = tx.is_refusal(cleaned(), fixed.REFUSALS if refusals is None else refusals)
    good = (F.col("role") == "assistant") & ~refused
    narrow = turns.select(KEY, TURN, good.alias("_good"), F.lit(True).alias("_here"))
    scanned = ordered_scan(narrow, [KEY], [F.col(TURN)], lags={"_before": TURN, "_has": "_here"}).filter("_good")
    alone = turns.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select(KEY)
    own = F.struct(F.col(TURN).alias("at"), F.lit(1).alias("slot"))
    both = scanned.filter("_has").select(
        KEY, F.col(TURN).alias("pair"), F.explode(F.array(F.struct(F.col("_before").alias("at"), F.lit(0).alias("slot")), own)).alias("w")
    )
    single = join_facts(scanned.filter(F.col("_has").isNull()), alone, KEY, "left_semi").select(KEY, F.col(TURN).alias("pair"), own.alias("w"))
    wanted = both.unionByName(single).select(F.col(KEY).alias("_key"), "pair", "w.at", "w.slot")
    # Then each wanted turn's text is fetched once.
    texts = turns.select(KEY, TURN, "role", cleaned().alias("text"))
    return texts.join(wanted, F.col(KEY).eqNullSafe(F.col("_key")) & (F.col(TURN) == F.col("at"))).select(KEY, "pair", "slot", "role", "text")


def sections(turns: DataFrame) -> DataFrame:
    """``section`` of every turn: a user turn opens a new one, except as first
    turn; leading turns of other roles share section 0."""
    marked = turns.withColumn("_user", (F.col("role") == "user").cast("bigint"))
    scanned = ordered_scan(marked, [KEY], [F.col(TURN)], running_sums={"_users": "_user"})
    first = turns.groupBy(KEY).agg(F.min_by(F.col("role") == "user", TURN).cast("bigint").alias("_open"))
    return join_facts(scanned, first, KEY).select(
        *turns.columns, (F.col("_users") - F.col("_open")).alias("section")
    )


def message_rank(role: Column, parts_types: Column) -> Column:
    """Order of messages with equal times: tool call, tool result, other
    assistant, everything else."""
    return (
        F.when((role == "assistant") & F.array_contains(parts_types, "tool-call"), 0)
        .when((role == "tool") & F.array_contains(parts_types, "tool-result"), 1)
        .when(role == "assistant", 2)
        .otherwise(3)
    )


def last_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, last_user_turn, trailing_turn``."""
    return turns.groupBy(KEY).agg(
        F.max(F.when(F.col("role") == "user", F.col(TURN))).alias("last_user_turn"),
        F.max(TURN).alias("trailing_turn"),
    )


def nest(turns: DataFrame, rows_per_part: int = TURNS_PER_BLOCK) -> DataFrame:
    """``conv_id, part, messages``: the turns of a conversation as an array.

    A conversation is one row (part 0) up to ``rows_per_part`` turns; longer
    ones go on in further parts, so that no row grows without limit.
    """
    first = turns.groupBy(KEY).agg(F.min(TURN).alias("_first"))
    part = F.floor((F.col(TURN) - F.col("_first")) / F.lit(rows_per_part))
    ordered = F.array_sort(F.collect_list(F.struct(TURN, "role", F.col("text").alias("content"))))
    return (
        join_facts(turns, first, KEY)
        .withColumn("part", part)
        .groupBy(KEY, "part")
        .agg(ordered.alias("m"))
        .select(
            KEY,
            "part",
            F.transform("m", lambda m: ms.message(m["role"], m["content"])).alias("messages"),
        )
    )


def unnest(conversations: DataFrame, keep: tuple[str, ...] = ("id", "version")) -> DataFrame:
    """One row per message: the kept columns, ``role`` and ``content``."""
    return conversations.select(*keep, F.explode("messages").alias("m")).select(
        *keep, "m.role", "m.content"
    )


def stamp(
    conversations: DataFrame, key: Column, source: Column, version: str, date_added: datetime, tokens: Column
) -> DataFrame:
    """``id, source, version, token, date_added`` added; the id is a 63-bit hash."""
    return conversations.withColumns(
        {
            "id": F.shiftrightunsigned(F.xxhash64(key, source), 1),
            "source": source,
            "version": F.lit(version),
            "token": tokens,
            "date_added": F.lit(date_added),
        }
    )


def project_parts(messages: DataFrame, role: str = "role", content: str = "text", parts: str = "parts") -> DataFrame:
    """Stored form of chat messages: a user's text as one text part, an
    assistant's parts cleaned; other roles are left out."""
    from_user = F.array(
        F.struct(
            F.lit("text").alias("type"),
            F.col(content).alias("text"),
            F.lit(None).cast("string").alias("content"),
            F.lit(None).cast("string").alias("reasoning"),
        )
    )
    cleaned = ms.sanitise_parts(ms.dedupe_parts(F.col(parts)))
    return messages.filter(F.col(role).isin("user", "assistant")).withColumn(
        parts, F.when(F.col(role) == "user", from_user).otherwise(cleaned)
    )


def for_template(rows: DataFrame, template: str, messages: str = "messages", seed: int = 0) -> DataFrame:
    """Rows ready for a chat template, one ``messages`` array each.

    ``qwen3`` and ``r1`` turn reasoning samples (rows with a ``think`` column)
    into messages and drop the unusable ones; ``qwen3`` puts the default system
    message before other conversations; every other template keeps them.
    """
    if template in ("qwen3", "r1") and "think" in rows.columns:
        optional = {
            c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
            for c in ("vi_question", "vi_answer", "vi_thinking")
        }
        sample = ms.reasoning_sample(
            F.col("question"), F.col("answer"), F.col("think"), *optional.values(), F.col("id"), seed
        )
        made = rows.withColumn("_s", sample).filter(F.col("_s").isNotNull())
        return made.select("id", "_s.pair", F.col("_s.messages").alias(messages))
    if template == "qwen3":
        prompted = ms.with_system(F.col(messages))
        if "part" in rows.columns:
            # Further parts of a conversation go on without a prompt.
            prompted = F.when(F.col("part") == 0, prompted).otherwise(F.col(messages))
        return rows.withColumn(messages, prompted)
    return rows


def pull(
    turns: DataFrame,
    stored: DataFrame,
    time_start: datetime | None = None,
    time_end: datetime | None = None,
    source: str | None = None,
    lead_ins=None,
    drop_first=None,
    refusals=None,
    limit: int | None = None,
) -> DataFrame:
    """Good question/answer pairs of the stored conversations in a time range
    and source; ``stored`` has one row per conversation with ``time, source,
    message_generated``.  Conversations without a good pair give no row.  A
    ``limit`` counts stored conversations; none is set by default."""
    chosen = select_stored(stored, time_start, time_end, source, columns=(KEY,), limit=limit)
    wanted = join_facts(turns, chosen, KEY, "left_semi")
    return good_pairs(drop_null_context(wanted), lead_ins, drop_first, refusals)
