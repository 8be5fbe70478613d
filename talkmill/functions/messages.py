"""Column functions over one conversation held as an array of messages.

A message is ``struct<role: string, content: string>``.  These serve sources
whose rows already are whole conversations; tables with one row per turn use
``talkmill.operators.conversations``, which never gathers a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkmill import fixed
from talkmill.functions import text as tx

MESSAGE = "struct<role:string,content:string>"
MESSAGES = f"array<{MESSAGE}>"


def message(role: str | Column, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def has_cjk(messages: Column) -> Column:
    return F.exists(messages, lambda m: F.coalesce(tx.has_cjk(m["content"]), F.lit(False)))


def total_words(messages: Column) -> Column:
    return F.aggregate(
        messages,
        F.lit(0).cast("bigint"),
        lambda acc, m: acc + F.coalesce(tx.word_count(m["content"]), F.lit(0)),
    )


def has_null_context(messages: Column) -> Column:
    first = F.get(messages, F.lit(0))["content"]
    return F.coalesce(F.contains(F.lower(first), F.lit(fixed.NULL_CONTEXT)), F.lit(False))


def valid_part(messages: Column, on_empty: str = "truncate") -> Column:
    """Messages before the first empty one (and before its question, when the
    empty one is the assistant's); NULL when at most one is left.

    ``on_empty="drop"`` gives NULL as soon as any message is empty.
    """
    if on_empty not in ("truncate", "drop"):
        raise ValueError("on_empty must be 'truncate' or 'drop'")

    def cut(at: Column) -> Column:
        """``at``: 1-based place of the first empty message, 0 for none."""
        kept = F.when(at == 0, F.size(messages))
        if on_empty == "drop":
            kept = kept.otherwise(0)
        else:
            answer = F.get(messages, at - 1)["role"] == "assistant"
            kept = kept.when(answer, F.greatest(at - 2, F.lit(0))).otherwise(at - 1)
        return F.when(kept > 1, F.slice(messages, F.lit(1), kept))

    empty = F.transform(messages, lambda m: F.coalesce(m["content"], F.lit("")) == "")
    return tx.bind(F.array_position(empty, True).cast("int"), cut)


def good_turns(messages: Column) -> Column:
    """Question/answer pairs whose cleaned answer is not a refusal."""
    cleaned = F.transform(
        messages,
        lambda m: F.when(m["role"] == "assistant", message(m["role"], tx.strip_lead_ins(m["content"]))).otherwise(
            m
        ),
    )

    def pairs(ms: Column) -> Column:
        def pair(m: Column, i: Column) -> Column:
            keep = (m["role"] == "assistant") & ~tx.is_refusal(m["content"])
            alone = F.when(F.size(ms) == 1, F.array(m))
            both = F.when(i > 0, F.array(F.get(ms, i - 1), m)).otherwise(alone)
            return F.coalesce(F.when(keep, both), F.array().cast(MESSAGES))

        return F.flatten(F.transform(ms, pair))

    return tx.bind(cleaned, pairs)


def with_system(messages: Column, prompt: str = fixed.DEFAULT_SYSTEM) -> Column:
    """A system message in front when the first message is not one."""
    first = F.get(messages, F.lit(0))["role"]
    return F.when(
        first != "system", F.concat(F.array(message("system", F.lit(prompt))), messages)
    ).otherwise(messages)


def parse_qa(text: Column) -> Column:
    """``array<struct<question, answer>>`` of generated text; NULL when a block
    does not hold exactly one answer marker."""
    blocks = tx.bind(
        F.split(text, fixed.QUESTION_MARK), lambda b: F.slice(b, F.lit(2), F.size(b))
    )
    halves = F.transform(blocks, lambda b: F.split(b, fixed.ANSWER_MARK, -1))
    return tx.bind(
        halves,
        lambda hs: F.when(
            F.forall(hs, lambda h: F.size(h) == 2),
            F.transform(
                hs,
                lambda h: F.struct(
                    tx.strip(F.get(h, F.lit(0))).alias("question"), tx.strip(F.get(h, F.lit(1))).alias("answer")
                ),
            ),
        ),
    )


def parse_questions(text: Column) -> Column:
    """Non-empty ``- question`` lines after the first question marker."""
    blocks = tx.bind(
        F.split(text, fixed.QUESTION_MARK), lambda b: F.slice(b, F.lit(2), F.size(b))
    )
    lines = F.flatten(F.transform(blocks, lambda b: F.split(b, "\n")))
    dashed = F.filter(F.transform(lines, tx.strip), lambda x: F.startswith(x, F.lit("-")))
    return F.filter(
        F.transform(dashed, lambda x: tx.strip(F.substring(x, F.lit(2), F.length(x)))), lambda x: x != ""
    )


def with_context(question: Column, content: Column) -> Column:
    """The question behind its source text."""
    return F.concat(F.lit(fixed.CONTEXT_BEFORE), content, F.lit(fixed.CONTEXT_AFTER), question)


def qa_to_messages(pairs: Column, content: Column | None = None) -> Column:
    """Pairs as user/assistant messages; the first one gets the source text when
    any question needs it and there is a text."""
    plain = F.flatten(
        F.transform(pairs, lambda q: F.array(message("user", q["question"]), message("assistant", q["answer"])))
    )
    if content is None:
        return plain
    wanted = F.exists(pairs, lambda q: tx.needs_context(q["question"])) & content.isNotNull()

    def add(ms: Column) -> Column:
        head = F.get(ms, F.lit(0))
        return F.concat(
            F.array(message(head["role"], with_context(head["content"], content))),
            F.slice(ms, F.lit(2), F.size(ms)),
        )

    return F.when(wanted, tx.bind(plain, add)).otherwise(plain)


def reasoning_sample(
    question: Column,
    answer: Column,
    think: Column,
    vi_question: Column,
    vi_answer: Column,
    vi_thinking: Column,
    key: Column,
    seed: int = 0,
) -> Column:
    """``struct<pair, messages>`` of a reasoning sample; NULL when a translated
    sample has CJK text in its question or answer.

    The prompt and the suffix are chosen by a hash of ``key`` and ``seed``.
    """
    translated = vi_question.isNotNull() & vi_answer.isNotNull()
    wrong = translated & (tx.has_cjk(question) | tx.has_cjk(answer))
    vi_trace = vi_thinking.isNotNull() & ~tx.has_cjk(vi_thinking)
    pair = F.when(~translated, "en_en").when(vi_trace, "vi_vi").otherwise("vi_en")

    def build(p: Column) -> Column:
        trace = (
            F.when(p == "vi_vi", vi_thinking)
            .when(p == "vi_en", F.concat(F.lit(fixed.REASONING_TRANSLATION), question, F.lit("\n\n"), think))
            .otherwise(think)
        )
        prompt = F.lit(None).cast("string")
        for name, prompts in fixed.REASONING_SYSTEM.items():
            pick = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(len(prompts))).cast("int")
            prompt = F.when(p == name, F.get(F.array(*[F.lit(x) for x in prompts]), pick)).otherwise(prompt)
        suffix = F.when(F.pmod(F.xxhash64(key, F.lit(seed + 1)), F.lit(2)) == 0, fixed.THINK_SUFFIX).otherwise("")
        asked = F.when(translated, vi_question).otherwise(question)
        replied = F.when(translated, vi_answer).otherwise(answer)
        return F.struct(
            p.alias("pair"),
            F.array(
                message("system", prompt),
                message("user", F.concat(asked, suffix)),
                message("assistant", F.concat(F.lit("<think>\n"), trace, F.lit("\n</think>\n\n"), replied)),
            ).alias("messages"),
        )

    return F.when(~F.coalesce(wrong, F.lit(False)), tx.bind(pair, build))


def dedupe_parts(parts: Column) -> Column:
    """First part of each (type, JSON of content or of the whole part)."""

    def key(p: Column) -> Column:
        return F.concat_ws("|", p["type"], F.coalesce(p["content"], F.to_json(p)))

    return tx.bind(
        F.transform(parts, key),
        lambda keys: F.filter(parts, lambda p, i: F.array_position(keys, F.get(keys, i)) == i + 1),
    )


def sanitise_parts(parts: Column) -> Column:
    """Parts without placeholder reasoning."""
    return F.filter(
        parts,
        lambda p: ~F.coalesce((p["type"] == "reasoning") & (p["reasoning"] == "undefined"), F.lit(False)),
    )
