"""Conversation cleaning, nesting, sections and stamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from talkmill import fixed
from talkmill.functions import messages as ms
from talkmill.functions import text as tx
from talkmill.operators import conversations as cv
from talkmill.operators import generate, ordered, profiling
from talkmill.plans.registry import query, sql_strip, sql_word_count

TOKENS = r"len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]'))"


@query(
    "conv_word_counts",
    f"""SELECT conv_id, count(*) AS n_messages, CAST(sum({sql_word_count('text')}) AS BIGINT) AS word_count
        FROM conversations GROUP BY conv_id""",
)
def conv_word_counts(t):
    return cv.word_counts(t("conversations"))


# The tables hold no CJK text: some second turns get some.
SQL_SCRIPT = """WITH t AS (
    SELECT conv_id, turn, role, CASE WHEN conv_id % 5 = 2 AND turn = 1 THEN text || ' 中文' ELSE text END AS text
    FROM conversations)"""


def with_script(t):
    marked = (F.col("conv_id") % 5 == 2) & (F.col("turn") == 1)
    return t("conversations").withColumn(
        "text", F.when(marked, F.concat("text", F.lit(" 中文"))).otherwise(F.col("text"))
    )


@query(
    "conv_prune_script",
    SQL_SCRIPT
    + r"""SELECT conv_id, turn, role, text FROM t
          WHERE conv_id NOT IN (SELECT conv_id FROM t WHERE regexp_matches(text, '[\x{4e00}-\x{9fff}]'))""",
)
def conv_prune_script(t):
    return cv.drop_wrong_script(with_script(t))


@query(
    "conv_script_counts",
    SQL_SCRIPT
    + r"""SELECT conv_id, CAST(sum(len(regexp_extract_all(text, '[\x{4e00}-\x{9fff}]'))) AS BIGINT) AS cjk_chars
          FROM t GROUP BY conv_id""",
)
def conv_script_counts(t):
    return with_script(t).groupBy("conv_id").agg(F.sum(tx.cjk_count(F.col("text"))).alias("cjk_chars"))


# The tables hold no empty turns: some turns are emptied.
SQL_EMPTIED = """WITH t AS (
    SELECT conv_id, turn, role,
           CASE WHEN (conv_id % 7 = 0 AND turn = 3) OR (conv_id % 7 = 3 AND turn = 2) THEN '' ELSE text END AS text
    FROM conversations),
  cuts AS (
    SELECT conv_id, min(turn) FILTER (text = '') AS cut, arg_min(role, turn) FILTER (text = '') AS cut_role, count(*) AS n
    FROM t GROUP BY conv_id)"""


def emptied(t):
    hit = ((F.col("conv_id") % 7 == 0) & (F.col("turn") == 3)) | ((F.col("conv_id") % 7 == 3) & (F.col("turn") == 2))
    return t("conversations").withColumn("text", F.when(hit, "").otherwise(F.col("text")))


@query(
    "conv_validity",
    SQL_EMPTIED
    + """, kept AS (
        SELECT t.*, count(*) OVER (PARTITION BY conv_id) AS n_left, max(turn) OVER (PARTITION BY conv_id) AS last,
               coalesce(cut_role = 'assistant', false) AS answer_empty
        FROM t JOIN cuts USING (conv_id) WHERE cut IS NULL OR turn < cut)
      SELECT conv_id, turn, role, text FROM kept
      WHERE n_left - CAST(answer_empty AS INT) > 1 AND (NOT answer_empty OR turn < last)""",
)
def conv_validity(t):
    return cv.keep_valid(emptied(t))


@query(
    "conv_validity_drop",
    SQL_EMPTIED
    + """SELECT conv_id, turn, role, text FROM t JOIN cuts USING (conv_id) WHERE cut IS NULL AND n > 1""",
)
def conv_validity_drop(t):
    return cv.keep_valid(emptied(t), on_empty="drop")


@query(
    "conv_system_prompt",
    f"""WITH first AS (SELECT conv_id, min(turn) AS first, arg_min(role, turn) AS role FROM conversations GROUP BY conv_id)
        SELECT conv_id, turn, role, text FROM conversations
        UNION ALL
        SELECT conv_id, first - 1, 'system', '{fixed.DEFAULT_SYSTEM}' FROM first WHERE role <> 'system'""",
)
def conv_system_prompt(t):
    return cv.add_system(t("conversations"))


@query(
    "conv_null_context",
    r"""WITH t AS (
          SELECT conv_id, turn, role,
                 CASE WHEN conv_id % 6 = turn THEN E'<content>\n\nNone\n\n</content>\n' || text ELSE text END AS text
          FROM conversations),
        first AS (SELECT conv_id, arg_min(text, turn) AS text FROM t GROUP BY conv_id)
        SELECT conv_id, turn, role, text FROM t
        WHERE conv_id NOT IN (SELECT conv_id FROM first WHERE contains(lower(text), E'<content>\n\nnone\n\n</content>'))""",
)
def conv_null_context(t):
    empty = F.concat(F.lit("<content>\n\nNone\n\n</content>\n"), F.col("text"))
    turns = t("conversations").withColumn(
        "text", F.when(F.col("conv_id") % 6 == F.col("turn"), empty).otherwise(F.col("text"))
    )
    return cv.drop_null_context(turns)


# Phrases that occur in the tables stand in for the fixed lists.
LEAD_INS, TRIGGERS, REFUSALS = ["That ", "Les "], ["with", " der "], ["tion the", " nicht "]


def _sql_cleaned() -> str:
    steps = ["a0 AS (SELECT *, text AS c0, split_part(text, '.', 1) AS first_s FROM conversations)"]
    for i, tag in enumerate(LEAD_INS):
        step = sql_strip(f"replace(c{i}, '{tag}', '')")
        steps.append(
            f"""a{i + 1} AS (SELECT *, CASE WHEN contains(first_s, '{tag}')
                THEN upper({step}[1:1]) || {step}[2:] ELSE c{i} END AS c{i + 1} FROM a{i})"""
        )
    n = len(LEAD_INS)
    hit = " OR ".join(f"contains(first_s, '{x}')" for x in TRIGGERS)
    rest = sql_strip("CASE WHEN contains(text, '.') THEN text[length(first_s) + 2:] ELSE '' END")
    steps.append(f"a AS (SELECT *, CASE WHEN {hit} THEN {rest} ELSE c{n} END AS cleaned FROM a{n})")
    return ",\n".join(steps)


SQL_REFUSED = " OR ".join(f"contains(lower(m_text), '{x}')" for x in REFUSALS)


@query(
    "conv_refusal_filter",
    f"""WITH {_sql_cleaned()},
        m AS (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN cleaned ELSE text END AS m_text FROM a),
        w AS (SELECT *, lag(role) OVER p AS prev_role, lag(m_text) OVER p AS prev_text,
                     count(*) OVER (PARTITION BY conv_id) AS n
              FROM m WINDOW p AS (PARTITION BY conv_id ORDER BY turn)),
        good AS (SELECT * FROM w WHERE role = 'assistant' AND NOT ({SQL_REFUSED}))
        SELECT conv_id, turn AS pair, 0 AS slot, prev_role AS role, prev_text AS text FROM good WHERE prev_role IS NOT NULL
        UNION ALL
        SELECT conv_id, turn, 1, role, m_text FROM good WHERE prev_role IS NOT NULL OR n = 1""",
)
def conv_refusal_filter(t):
    return cv.good_pairs(t("conversations"), LEAD_INS, TRIGGERS, REFUSALS)


@query(
    "conv_nest",
    """SELECT conv_id, CAST(0 AS BIGINT) AS part, count(*) AS n_messages,
              string_agg(role || ':' || text, chr(30) ORDER BY turn) AS messages
       FROM conversations GROUP BY conv_id""",
)
def conv_nest(t):
    nested = cv.nest(t("conversations"))
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return nested.select(
        "conv_id",
        "part",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.array_join(lines, "\x1e").alias("messages"),
    )


@query("conv_unnest", "SELECT conv_id, 'v1' AS version, role, text AS content FROM conversations")
def conv_unnest(t):
    nested = cv.nest(t("conversations")).withColumn("version", F.lit("v1"))
    return cv.unnest(nested, keep=("conv_id", "version"))


@query(
    "conv_sections",
    """SELECT conv_id, turn, CAST(sum(CASE WHEN role = 'user' AND rn > 1 THEN 1 ELSE 0 END)
              OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS section
       FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations)""",
)
def conv_sections(t):
    return cv.sections(t("conversations").select("conv_id", "turn", "role")).drop("role")


@query(
    "conv_last_user",
    """SELECT conv_id, max(turn) FILTER (role = 'user') AS last_user_turn, max(turn) AS trailing_turn
       FROM conversations GROUP BY conv_id""",
)
def conv_last_user(t):
    return cv.last_turns(t("conversations"))


@query(
    "conv_message_order",
    """WITH m AS (
         SELECT event_id, user_id, date_trunc('day', ts) AS created,
                CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END AS message_rank
         FROM events)
       SELECT event_id, message_rank,
              row_number() OVER (PARTITION BY user_id ORDER BY created, message_rank, event_id) AS rn FROM m""",
)
def conv_message_order(t):
    # Events stand in for messages: clicks call a tool, views carry its result.
    kind = F.col("event_type")
    role = F.when(kind.isin("click", "purchase"), "assistant").when(kind.isin("view", "error"), "tool").otherwise("user")
    types = F.when(kind == "click", F.array(F.lit("text"), F.lit("tool-call"))).when(
        kind == "view", F.array(F.lit("tool-result"))
    ).otherwise(F.array(F.lit("text")))
    rows = t("events").select(
        "event_id",
        "user_id",
        F.date_trunc("day", F.col("ts")).alias("created"),
        cv.message_rank(role, types).alias("message_rank"),
    )
    order = [F.col("created"), F.col("message_rank"), F.col("event_id")]
    return ordered.ordered_scan(rows, ["user_id"], order, row_number="rn").select("event_id", "message_rank", "rn")


def stored(t):
    """Conversations with a time, a source and a generated flag made from the key."""
    counts = cv.word_counts(t("conversations"))
    return counts.select(
        "*",
        F.timestamp_add("DAY", F.col("conv_id") % 365, F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")).alias("time"),
        F.concat(F.lit("site"), F.col("conv_id") % 3).alias("source"),
        (F.col("conv_id") % 4 != 0).alias("message_generated"),
    )


@query(
    "conv_select",
    f"""WITH c AS (
          SELECT conv_id, count(*) AS n_messages, CAST(sum({sql_word_count('text')}) AS BIGINT) AS word_count,
                 TIMESTAMP '2024-01-01' + to_days(CAST(conv_id % 365 AS INT)) AS time, 'site' || conv_id % 3 AS source,
                 conv_id % 4 <> 0 AS message_generated
          FROM conversations GROUP BY conv_id)
        SELECT conv_id, n_messages, time FROM c
        WHERE time >= TIMESTAMP '2024-01-10' AND time <= TIMESTAMP '2024-10-01' AND source = 'site1' AND message_generated""",
)
def conv_select(t):
    return cv.select_stored(
        stored(t),
        datetime(2024, 1, 10),
        datetime(2024, 10, 1),
        "site1",
        columns=("conv_id", "n_messages", "time"),
    )


@query(
    "conv_stamp",
    f"""SELECT conv_id, 'site' || conv_id % 3 AS source, 'v2' AS version, CAST(sum({TOKENS}) AS BIGINT) AS token,
               TIMESTAMP '2025-05-01' AS date_added, 11 + row_number() OVER (ORDER BY conv_id) AS idx
        FROM conversations GROUP BY conv_id""",
)
def conv_stamp(t):
    tokens = (
        t("conversations")
        .select("conv_id", profiling.token_count(F.col("text")).alias("n"))
        .groupBy("conv_id")
        .agg(F.sum("n").alias("n_tokens"))
    )
    stamped = cv.stamp(
        tokens,
        F.col("conv_id"),
        F.concat(F.lit("site"), F.col("conv_id") % 3),
        "v2",
        datetime(2025, 5, 1),
        F.col("n_tokens"),
    )
    stamped = stamped.withColumn("date_added", F.col("date_added").cast("timestamp_ntz"))
    return ordered.index_rows(stamped, 11, [F.col("conv_id")]).select(
        "conv_id", "source", "version", "token", "date_added", "idx"
    )


@query(
    "conv_stamp_ids",
    """SELECT source, count(*) AS n, count(*) AS n_ids, true AS positive, true AS stable
       FROM (SELECT DISTINCT conv_id, 'site' || conv_id % 3 AS source FROM conversations) GROUP BY source""",
)
def conv_stamp_ids(t):
    """Stamped ids: one per conversation and source, positive, and the same
    when conversations are stamped again from other partitions."""
    ids = t("conversations").select("conv_id", F.lit(1).alias("n_tokens")).distinct()

    def stamped(rows):
        source = F.concat(F.lit("site"), F.col("conv_id") % 3)
        return cv.stamp(rows, F.col("conv_id"), source, "v2", datetime(2025, 5, 1), F.col("n_tokens"))

    again = stamped(ids.repartition(3, F.col("conv_id") % 7)).select("conv_id", F.col("id").alias("second"))
    both = stamped(ids).join(again, "conv_id")
    return both.groupBy("source").agg(
        F.count("*").alias("n"),
        F.count_distinct("id").alias("n_ids"),
        F.bool_and(F.col("id") >= 0).alias("positive"),
        F.bool_and(F.col("id") == F.col("second")).alias("stable"),
    )


@query(
    "token_totals",
    f"SELECT role, CAST(sum({TOKENS}) AS BIGINT) AS tokens, count(*) AS n FROM conversations GROUP BY role",
)
def token_totals(t):
    counted = t("conversations").select("role", profiling.token_count(F.col("text")).alias("n_tokens"))
    return counted.groupBy("role").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))


@query(
    "parts_clean",
    """SELECT conv_id, turn, role,
              CASE WHEN role = 'user' THEN 'text:' || text
                   WHEN replace(text, 'e', 'E') <> text THEN 'text:' || text || chr(30) || 'text:' || replace(text, 'e', 'E') || chr(30) || 'reasoning:' || text || '!'
                   ELSE 'text:' || text || chr(30) || 'reasoning:' || text || '!' END AS parts
       FROM conversations WHERE role IN ('user', 'assistant')""",
)
def parts_clean(t):
    def part(kind, content, reasoning=None):
        nothing = F.lit(None).cast("string")
        return F.struct(
            F.lit(kind).alias("type"),
            nothing.alias("text"),
            (nothing if content is None else content).alias("content"),
            (nothing if reasoning is None else reasoning).alias("reasoning"),
        )

    text = F.col("text")
    parts = F.array(
        part("text", text),
        part("text", F.replace(text, F.lit("e"), F.lit("E"))),
        part("text", text),
        part("reasoning", None, F.lit("undefined")),
        part("reasoning", None, F.concat(text, F.lit("!"))),
        part("reasoning", None, F.concat(text, F.lit("!"))),
    )
    shown = F.transform(
        "parts", lambda p: F.concat(p["type"], F.lit(":"), F.coalesce(p["text"], p["content"], p["reasoning"]))
    )
    return cv.project_parts(t("conversations").withColumn("parts", parts)).select(
        "conv_id", "turn", "role", F.array_join(shown, "\x1e").alias("parts")
    )


SQL_PAIRS = """WITH pairs AS (
    SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer
    FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
    WHERE q.role = 'user' AND a.role = 'assistant')"""


def turn_pairs(t):
    """User turns with the assistant turn that follows."""
    turns = t("conversations")
    answers = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    questions = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    return questions.join(answers, ["conv_id", "turn"])


@query(
    "reasoning_format",
    SQL_PAIRS
    + f""", k AS (SELECT *, CASE conv_id % 3 WHEN 0 THEN 'en_en' WHEN 1 THEN 'vi_vi' ELSE 'vi_en' END AS pair FROM pairs
              WHERE NOT (conv_id % 3 <> 0 AND conv_id % 4 = 1))
        SELECT conv_id, turn, pair, CAST(3 AS BIGINT) AS n_messages,
               CASE WHEN pair = 'en_en' THEN question ELSE 'vi ' || question END AS asked,
               E'<think>\\n' || CASE pair WHEN 'en_en' THEN 'trace ' || turn WHEN 'vi_vi' THEN 'vi trace ' || turn
                   ELSE E'{fixed.REASONING_TRANSLATION.encode('unicode_escape').decode()}' || question || E'\\n\\ntrace ' || turn END
                || E'\\n</think>\\n\\n' || CASE WHEN pair = 'en_en' THEN answer ELSE 'vi ' || answer END AS replied
        FROM k""",
)
def reasoning_format(t):
    third = F.col("conv_id") % 3
    wrong = (third != 0) & (F.col("conv_id") % 4 == 1)
    rows = turn_pairs(t).withColumns(
        {
            "vi_question": F.when(third != 0, F.concat(F.lit("vi "), "question")),
            "vi_answer": F.when(third != 0, F.concat(F.lit("vi "), "answer")),
            "think": F.concat(F.lit("trace "), F.col("turn")),
            "vi_thinking": F.when(third == 1, F.concat(F.lit("vi trace "), F.col("turn"))),
            "asked_en": F.when(wrong, F.concat("question", F.lit("中"))).otherwise(F.col("question")),
        }
    )
    sample = ms.reasoning_sample(
        F.col("asked_en"),
        F.col("answer"),
        F.col("think"),
        F.col("vi_question"),
        F.col("vi_answer"),
        F.col("vi_thinking"),
        F.concat_ws("/", "conv_id", "turn"),
    )
    made = rows.select("conv_id", "turn", sample.alias("s")).filter(F.col("s").isNotNull())
    asked = F.get(F.col("s.messages"), F.lit(1))["content"]
    return made.select(
        "conv_id",
        "turn",
        "s.pair",
        F.size("s.messages").cast("bigint").alias("n_messages"),
        F.regexp_replace(asked, f"{fixed.THINK_SUFFIX}$", "").alias("asked"),
        F.get(F.col("s.messages"), F.lit(2))["content"].alias("replied"),
    )


SQL_GENERATED = SQL_PAIRS + r""", g AS (
    SELECT *, '### Question: ' || question || E'\n### Answer:\n' || answer ||
        CASE WHEN turn % 4 = 2 THEN ' ### Question: theo N.Q.A. ### Answer: ' || turn
             WHEN turn % 4 = 3 THEN ' ### Question: without answer' ELSE '' END AS text FROM pairs)"""


def generated(t):
    """Pairs rendered as generated text; some with a second pair, some broken."""
    more = (
        F.when(F.col("turn") % 4 == 2, F.concat(F.lit(" ### Question: theo N.Q.A. ### Answer: "), F.col("turn")))
        .when(F.col("turn") % 4 == 3, " ### Question: without answer")
        .otherwise("")
    )
    return turn_pairs(t).withColumn(
        "text",
        F.concat(F.lit("### Question: "), "question", F.lit("\n### Answer:\n"), "answer", more),
    )


@query(
    "qa_parse",
    SQL_GENERATED
    + f"""SELECT conv_id, turn, 0 AS position, {sql_strip('question')} AS question, {sql_strip('answer')} AS answer
          FROM g WHERE turn % 4 <> 3
          UNION ALL
          SELECT conv_id, turn, 1, 'theo N.Q.A.', CAST(turn AS VARCHAR) FROM g WHERE turn % 4 = 2""",
)
def qa_parse(t):
    return generated(t).select(
        "conv_id", "turn", F.posexplode(ms.parse_qa(F.col("text"))).alias("position", "p")
    ).select("conv_id", "turn", "position", "p.question", "p.answer")


@query(
    "qa_to_messages",
    SQL_GENERATED
    + f""", p AS (
          SELECT conv_id, turn, {sql_strip('question')} AS q, {sql_strip('answer')} AS a, turn % 4 = 2 AS two,
                 CASE WHEN conv_id % 3 = 0 THEN NULL ELSE question END AS content FROM g WHERE turn % 4 <> 3),
        c AS (SELECT *, two OR regexp_matches(lower(q), 'theo|này|giá|trên') OR regexp_matches(q, '[A-Z](\\.[A-Z])+\\.') AS needs FROM p)
        SELECT conv_id, turn, 0 AS position, 'user' AS role,
               CASE WHEN needs AND content IS NOT NULL
                    THEN E'{fixed.CONTEXT_BEFORE.replace(chr(10), chr(92) + 'n')}' || content || E'{fixed.CONTEXT_AFTER.replace(chr(10), chr(92) + 'n')}' || q
                    ELSE q END AS content FROM c
        UNION ALL SELECT conv_id, turn, 1, 'assistant', a FROM c
        UNION ALL SELECT conv_id, turn, 2, 'user', 'theo N.Q.A.' FROM c WHERE two
        UNION ALL SELECT conv_id, turn, 3, 'assistant', CAST(turn AS VARCHAR) FROM c WHERE two""",
)
def qa_to_messages(t):
    rows = generated(t).withColumn("source_text", F.when(F.col("conv_id") % 3 != 0, F.col("question")))
    rows = rows.withColumn("pairs", ms.parse_qa(F.col("text"))).filter(F.col("pairs").isNotNull())
    made = rows.select(
        "conv_id",
        "turn",
        F.posexplode(ms.qa_to_messages(F.col("pairs"), F.col("source_text"))).alias("position", "m"),
    )
    return made.select("conv_id", "turn", "position", "m.role", "m.content")


@query(
    "qa_questions",
    SQL_PAIRS
    + f"""SELECT conv_id, turn, 0 AS position, {sql_strip("replace(question, E'\\n', ' ')")} AS question FROM pairs
          UNION ALL SELECT conv_id, turn, 1, 'second ' || turn FROM pairs""",
)
def qa_questions(t):
    text = F.concat(
        F.lit("intro\n- not one\n### Question:\n- "),
        F.replace(F.col("question"), F.lit("\n"), F.lit(" ")),
        F.lit("\n-\nplain\n  -second "),
        F.col("turn"),
    )
    return turn_pairs(t).select(
        "conv_id", "turn", F.posexplode(ms.parse_questions(text)).alias("position", "question")
    )


def stub_asker():
    """Deterministic generator: one question that needs its source, one that
    does not; prompts without a full stop fail."""

    def run(prompt: str) -> str:
        if "." not in prompt:
            raise ValueError("no sentence")
        return f"### Question:\n- theo bài\n- length {len(prompt)}?"

    return run


def stub_answerer():
    return lambda prompt: f"answer {len(prompt)}"


SQL_PROMPT = "'Ngày đăng: ' || source || E'\\n\\n Nội dung: ' || coalesce(text, '')"


def prompt_rows(t):
    return t("documents").select(
        F.col("doc_id").cast("string").alias("link"),
        F.col("source").alias("time"),
        F.coalesce("text", F.lit("")).alias("content"),
    )


@query(
    "generate_by_question",
    f"""WITH p AS (SELECT CAST(doc_id AS VARCHAR) AS link, {SQL_PROMPT} AS prompt FROM documents)
        SELECT link, 1 AS position, 'length ' || length(prompt) || '?' AS question,
               'answer ' || length(prompt || E'\\n\\nlength ' || length(prompt) || '?') AS answer, NULL AS failure
        FROM p WHERE contains(prompt, '.')
        UNION ALL SELECT link, NULL, NULL, NULL, 'ValueError: no sentence' FROM p WHERE NOT contains(prompt, '.')""",
)
def generate_by_question(t):
    return generate.generate_pairs_by_question(prompt_rows(t), stub_asker, stub_answerer)


def stub_pairs():
    def run(prompt: str) -> str:
        if len(prompt) % 5 == 0:
            return "no template ### Question: broken"
        return f"### Question: q{len(prompt)} ### Answer: {prompt}"

    return run


@query(
    "generate_pairs",
    f"""WITH p AS (SELECT CAST(doc_id AS VARCHAR) AS link, {SQL_PROMPT} AS prompt FROM documents)
        SELECT link, length(prompt) % 5 <> 0 AS succeeded, CASE WHEN length(prompt) % 5 = 0 THEN 'template' END AS failure,
               CASE WHEN length(prompt) % 5 <> 0 THEN 'q' || length(prompt) END AS question,
               CASE WHEN length(prompt) % 5 <> 0 THEN {sql_strip('prompt')} END AS answer FROM p""",
)
def generate_pairs(t):
    made = generate.generate_pairs(prompt_rows(t), stub_pairs)
    flags = generate.outcomes(made)
    first = F.get(F.col("pairs"), F.lit(0))
    shown = made.select("link", "failure", first["question"].alias("question"), first["answer"].alias("answer"))
    return shown.join(flags, "link")


@query(
    "pull_messages",
    f"""WITH {_sql_cleaned()},
        m AS (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN cleaned ELSE text END AS m_text FROM a
              WHERE conv_id % 3 = 1 AND conv_id % 4 <> 0 AND conv_id % 365 BETWEEN 9 AND 274),
        w AS (SELECT *, lag(role) OVER p AS prev_role, lag(m_text) OVER p AS prev_text,
                     count(*) OVER (PARTITION BY conv_id) AS n
              FROM m WINDOW p AS (PARTITION BY conv_id ORDER BY turn)),
        good AS (SELECT * FROM w WHERE role = 'assistant' AND NOT ({SQL_REFUSED}))
        SELECT conv_id, turn AS pair, 0 AS slot, prev_role AS role, prev_text AS text FROM good WHERE prev_role IS NOT NULL
        UNION ALL
        SELECT conv_id, turn, 1, role, m_text FROM good WHERE prev_role IS NOT NULL OR n = 1""",
)
def pull_messages(t):
    start, end = datetime(2024, 1, 10), datetime(2024, 10, 1)
    return cv.pull(t("conversations"), stored(t), start, end, "site1", LEAD_INS, TRIGGERS, REFUSALS)


@query(
    "prune_report",
    SQL_SCRIPT
    + r""", w AS (SELECT conv_id, bool_or(regexp_matches(text, '[\x{4e00}-\x{9fff}]')) AS wrong FROM t GROUP BY conv_id)
          SELECT CASE WHEN wrong THEN 'pruned' ELSE 'kept' END AS kind, count(*) AS n FROM w GROUP BY 1""",
)
def prune_report(t):
    facts = cv.conversation_facts(cv.measure(with_script(t)))
    kept = F.when(F.col("wrong"), "pruned").otherwise("kept").alias("kind")
    # The run that writes the decisions counts them.
    decided, found = profiling.counted_table(facts.select("conv_id", kept), "pruned", pruned=F.col("kind") == "pruned", kept=F.col("kind") == "kept")
    return decided.select("kind").distinct().withColumn("n", F.when(F.col("kind") == "pruned", found["pruned"]).otherwise(found["kept"]).cast("bigint"))


@query(
    "template_chat",
    f"""WITH s AS (SELECT conv_id, arg_min(role, turn) AS role, count(*) AS n, string_agg(role || ':' || text, chr(30) ORDER BY turn) AS shown
                   FROM conversations GROUP BY conv_id)
        SELECT conv_id, n + CASE WHEN role = 'system' THEN 0 ELSE 1 END AS n_messages,
               CASE WHEN role = 'system' THEN shown ELSE 'system:{fixed.DEFAULT_SYSTEM}' || chr(30) || shown END AS messages FROM s""",
)
def template_chat(t):
    ready = cv.for_template(cv.nest(t("conversations")), "qwen3")
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return ready.select(
        "conv_id", F.size("messages").cast("bigint").alias("n_messages"), F.array_join(lines, "\x1e").alias("messages")
    )
