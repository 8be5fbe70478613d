"""Multiple-choice items, answers, accuracy and model ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkmill import fixed
from talkmill.functions import grading as gr
from talkmill.operators import evaluation as ev
from talkmill.plans.registry import query


def raw_items(t):
    """Benchmark texts as questions with choices and answers made from the key;
    one third have lettered choices, half of the answers are numbers."""
    lettered = F.col("item_id") % 3 == 0
    letters = ["A", "B", "C", "D"]
    choices = F.array(
        *[
            F.concat(F.when(lettered, f"{x}) ").otherwise(""), F.lit(f"choice {i} of "), F.col("item_id"))
            for i, x in enumerate(letters)
        ]
    )
    place = F.col("item_id") % 4
    answer = F.when(F.col("item_id") % 2 == 0, place.cast("string")).otherwise(
        F.get(F.array(*[F.lit(x.lower()) for x in letters]), place.cast("int"))
    )
    return t("benchmark").select(
        F.concat(F.lit("mmlu-"), F.col("item_id")).alias("id"), "item_id", F.col("text").alias("question"),
        choices.alias("choices"), answer.alias("answer"),
    )


def items(t):
    rows = raw_items(t)
    columns = gr.normalised_item(F.col("id"), F.col("question"), F.col("choices"), F.col("answer"))
    return rows.select("item_id", *columns)


SQL_ITEMS = r"""WITH items AS (
    SELECT item_id, 'mmlu-' || item_id AS id, text AS mcq_question,
           CASE WHEN item_id % 3 = 0
                THEN 'A) choice 0 of ' || item_id || E'\nB) choice 1 of ' || item_id || E'\nC) choice 2 of ' || item_id || E'\nD) choice 3 of ' || item_id || E'\n'
                ELSE 'A. choice 0 of ' || item_id || E'\nB. choice 1 of ' || item_id || E'\nC. choice 2 of ' || item_id || E'\nD. choice 3 of ' || item_id || E'\n' END AS choice,
           ['A', 'B', 'C', 'D'][item_id % 4 + 1] AS answer
    FROM benchmark)"""


@query("mcq_normalise", SQL_ITEMS + " SELECT id, mcq_question, choice, answer FROM items")
def mcq_normalise(t):
    return items(t).drop("item_id")


@query(
    "mcq_prompt",
    SQL_ITEMS
    + rf""", p AS (SELECT id, E'Câu hỏi:\n' || mcq_question || E'\n\nCác lựa chọn:\n' || choice AS body FROM items)
      SELECT id, 'user' AS role, regexp_replace(body, '^\s+|\s+$', '', 'g') AS content FROM p
      UNION ALL SELECT id, 'system', E'{fixed.GRADING_SYSTEM.replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + "n")}' FROM p""",
)
def mcq_prompt(t):
    asked = items(t).select("id", F.explode(gr.grading_messages(F.col("mcq_question"), F.col("choice"))).alias("m"))
    return asked.select("id", "m.role", "m.content")


# Answer forms by (turn number of the item + round); {0} is a letter of the item.
FORMS = [
    "{t} \\boxed{{{0}}}",
    "{t} the answer is {0}",
    "{t} Đáp án: {l} vì vậy",
    "{t} Answer: ({0})({1})",
    "{t} \\boxed{{ {0}, {1} }}",
    "{t}",
    "{t} answer is [{0}]",
    "{t} answer is {n}.5 and (7)",
    "{t} \\boxed{{\\textbf{{{0}}}}}",
    "({0}) or ({1}) {t}",
    "{t} \\boxed{{12.5}}",
    None,
]


def _spark_form(form: str | None):
    if form is None:
        return F.lit(None).cast("string")
    values = {"{t}": F.col("mcq_question"), "{0}": F.col("l0"), "{1}": F.col("l1"), "{l}": F.lower("l0"), "{n}": F.col("item_id").cast("string")}
    return F.concat(*_pieces(form, values, F.lit))


def _sql_form(form: str | None) -> str:
    if form is None:
        return "NULL"
    values = {"{t}": "mcq_question", "{0}": "l0", "{1}": "l1", "{l}": "lower(l0)", "{n}": "CAST(item_id AS VARCHAR)"}
    return " || ".join(_pieces(form, values, lambda x: "'" + x + "'"))


def _pieces(form, values, literal):
    """The parts of a form: values for the marks, literals between them."""
    out, text = [], ""
    i = 0
    while i < len(form):
        mark = next((m for m in values if form.startswith(m, i)), None)
        if mark is None:
            step = 2 if form[i : i + 2] in ("{{", "}}") else 1
            text += form[i]
            i += step
            continue
        if text:
            out.append(literal(text))
        out.append(values[mark])
        text, i = "", i + len(mark)
    if text:
        out.append(literal(text))
    return out


def responses(t, rounds: int = 3):
    """Responses of every item and round in varying forms; some are missing."""
    rows = items(t).withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    letters = F.array(*[F.lit(x) for x in "ABCD"])
    rows = rows.withColumns(
        {
            "l0": F.get(letters, ((F.col("item_id") + F.col("round") - 1) % 4).cast("int")),
            "l1": F.get(letters, ((F.col("item_id") + F.col("round")) % 4).cast("int")),
            "form": (F.col("item_id") + F.col("round")) % len(FORMS),
        }
    )
    text = F.lit(None).cast("string")
    for i, form in enumerate(FORMS):
        text = F.when(F.col("form") == i, _spark_form(form)).otherwise(text)
    return rows.select("item_id", "id", "round", text.alias("response")).filter(F.col("response").isNotNull())


SQL_RESPONSES = (
    SQL_ITEMS
    + """, r0 AS (SELECT items.*, unnest([1, 2, 3]) AS round FROM items),
    r1 AS (SELECT *, ['A', 'B', 'C', 'D'][(item_id + round - 1) % 4 + 1] AS l0, ['A', 'B', 'C', 'D'][(item_id + round) % 4 + 1] AS l1 FROM r0),
    responses AS (SELECT item_id, id, round, CASE (item_id + round) % """
    + str(len(FORMS))
    + " "
    + " ".join(f"WHEN {i} THEN {_sql_form(f)}" for i, f in enumerate(FORMS))
    + " END AS response FROM r1)"
)

_SQL_CHOICES = "A-Fa-f"


def _sql_rule(rule) -> str:
    pattern, front, behind, letters_only = rule
    found = f"regexp_extract_all(t, '{pattern}')[-1]"
    cut = f"substring({found}, {front + 1}, length({found}) - {front + behind})"
    return f"regexp_replace({cut}, '[^{_SQL_CHOICES}]', '', 'g')" if letters_only else cut


def sql_extract(mode: str) -> str:
    """CTEs that add ``extracted`` to ``responses``."""
    rules = gr.NUMBER_RULES if mode == "numeric" else gr.LETTER_RULES
    if mode == "MCQ":
        boxed = f"CASE WHEN regexp_full_match(box, '[{_SQL_CHOICES}]') THEN upper(box) ELSE 'None' END"
    elif mode == "MCQ(multiple)":
        boxed = f"CASE WHEN regexp_full_match(box, '[{_SQL_CHOICES}]*') THEN upper(box) ELSE 'None' END"
    else:
        boxed = "CASE WHEN try_cast(box AS DOUBLE) IS NOT NULL THEN box ELSE 'None' END"
    return rf""", e0 AS (
        SELECT *, string_split(response, '\boxed{{')[-1] AS after_box,
               upper(regexp_replace(regexp_replace(string_split_regex(response, 'Đáp án\s*:')[-1], '^\s+|\s+$', '', 'g'), '[ ,]', '', 'g'))[1:1] AS letter,
               replace(replace(regexp_replace(upper(regexp_replace(response, '^\s+|\s+$', '', 'g')), '[ ,]', '', 'g'), 'AND', ''), ':', '') AS t
        FROM responses),
      e1 AS (SELECT *, string_split(regexp_replace(regexp_replace(string_split(after_box, '}}')[1], '^\s+|\s+$', '', 'g'), '[ ,]', '', 'g'), '\textbf{{')[-1] AS box FROM e0),
      extracted AS (SELECT item_id, id, round, response,
        CASE WHEN contains(response, '\boxed{{') THEN {boxed}
             WHEN contains(response, 'Đáp án') THEN CASE WHEN letter = '' THEN NULL WHEN regexp_full_match(letter, '[{_SQL_CHOICES}]') THEN letter ELSE 'None' END
             ELSE coalesce({', '.join(_sql_rule(r) for r in rules)}, 'None') END AS extracted
        FROM e1)"""


def _register_extract(name: str, mode: str) -> None:
    sql = SQL_RESPONSES + sql_extract(mode) + " SELECT id, CAST(round AS INT) AS round, extracted FROM extracted WHERE response IS NOT NULL"

    @query(name, sql)
    def run(t):
        return responses(t).select("id", "round", gr.extract_answer(F.col("response"), mode).alias("extracted"))


_register_extract("mcq_extract", "MCQ")
_register_extract("mcq_extract_multiple", "MCQ(multiple)")
_register_extract("mcq_extract_numeric", "numeric")

# Responses whose answers are plain to see: the response, and what is to be read
# out of it in each mode.  a and b are two letters; 'None' is no answer, and
# NULL a label without one.
KNOWN = [
    ("item {n} \\boxed{{{a}}}", "a", "a", "'None'"),
    ("item {n} the answer is {a}", "a", "a", "'None'"),
    ("item {n} Đáp án: {la} qq", "a", "a", "a"),
    ("item {n} Answer: ({a})({b})", "a || b", "a || b", "'None'"),
    ("item {n} \\boxed{{ {a}, {b} }}", "'None'", "a || b", "'None'"),
    ("item {n} without", "'None'", "'None'", "'None'"),
    ("item {n} answer is [{a}] qq", "a", "a", "'None'"),
    ("item {n} answer is {n}.5 and (7)", "'None'", "'None'", "n || '.5'"),
    ("item {n} \\boxed{{\\textbf{{{a}}}}}", "a", "a", "'None'"),
    ("({a}) or ({b}) qq", "b", "b", "'None'"),
    ("item {n} \\boxed{{12.5}}", "'None'", "'None'", "'12.5'"),
    ("item {n} Đáp án: 7", "'None'", "'None'", "'None'"),
    ("item {n} Đáp án: ", "NULL", "NULL", "NULL"),
    ("first \\boxed{{{b}}} then \\boxed{{{a}}}", "a", "a", "'None'"),
    ("answer is ({n})", "'None'", "'None'", "n"),
]


def _known_sql(column: int) -> str:
    return "CASE k " + " ".join(f"WHEN {i} THEN {row[column]}" for i, row in enumerate(KNOWN)) + " END"


@query(
    "mcq_known_answers",
    f"""WITH i AS (SELECT p_partkey AS id, p_partkey % {len(KNOWN)} AS k, chr((65 + p_partkey % 4)::INT) AS a, chr((65 + (p_partkey + 1) % 4)::INT) AS b,
          CAST(p_partkey AS VARCHAR) AS n FROM part)
        SELECT id, {_known_sql(1)} AS mcq, {_known_sql(2)} AS multiple, {_known_sql(3)} AS numeric FROM i""",
)
def mcq_known_answers(t):
    letter = F.char(65 + F.col("id") % 4)
    parts = t("part").select(F.col("p_partkey").alias("id")).withColumns(
        {"a": letter, "b": F.char(65 + (F.col("id") + 1) % 4), "n": F.col("id").cast("string")}
    )
    values = {"{a}": F.col("a"), "{b}": F.col("b"), "{la}": F.lower("a"), "{n}": F.col("n")}
    response = F.lit(None).cast("string")
    for i, row in enumerate(KNOWN):
        response = F.when(F.col("id") % len(KNOWN) == i, F.concat(*_pieces(row[0], values, F.lit))).otherwise(response)
    said = parts.select("id", response.alias("response"))
    modes = {"mcq": "MCQ", "multiple": "MCQ(multiple)", "numeric": "numeric"}
    return said.select("id", *[gr.extract_answer(F.col("response"), mode).alias(name) for name, mode in modes.items()])


SQL_SCORES = (
    SQL_RESPONSES
    + sql_extract("MCQ")
    + """, scores AS (SELECT i.item_id, i.id, e.round, CAST(coalesce(e.extracted = i.answer, false) AS INT) AS score,
        CASE WHEN i.item_id % 2 = 0 THEN 'vmlu' ELSE 'mmlu' END AS dataset FROM items i JOIN extracted e USING (id))"""
)


def graded(t):
    questions = items(t).withColumn("dataset", F.when(F.col("item_id") % 2 == 0, "vmlu").otherwise("mmlu"))
    return ev.grade(questions, responses(t).drop("item_id"))


@query("mcq_scores", SQL_SCORES + " SELECT id, CAST(round AS INT) AS round, score, dataset FROM scores")
def mcq_scores(t):
    return graded(t).select("id", "round", "score", "dataset")


@query(
    "mcq_accuracy",
    SQL_SCORES + " SELECT dataset, round(sum(score) / count(*) * 100, 6) AS accuracy FROM scores GROUP BY dataset",
)
def mcq_accuracy(t):
    return ev.accuracy(graded(t), "dataset").withColumn("accuracy", F.round("accuracy", 6))


@query(
    "mcq_macro_mean",
    SQL_SCORES
    + """ SELECT round(avg(accuracy), 6) AS mean_score FROM (SELECT sum(score) / count(*) * 100 AS accuracy FROM scores GROUP BY dataset)""",
)
def mcq_macro_mean(t):
    return ev.macro_mean(ev.accuracy(graded(t), "dataset")).withColumn("mean_score", F.round("mean_score", 6))


@query(
    "mcq_rollup",
    SQL_SCORES
    + """ SELECT dataset, CAST(round AS INT) AS round, count(*) AS n, round(sum(score) / count(*) * 100, 6) AS accuracy
          FROM scores GROUP BY ROLLUP (dataset, round)""",
)
def mcq_rollup(t):
    return ev.accuracy_report(graded(t)).withColumn("accuracy", F.round("accuracy", 6))


SQL_VERSIONS = """WITH versions AS (SELECT event_type AS model, user_id AS version, min(event_id) AS first_event FROM events GROUP BY ALL),
    metrics AS (SELECT event_type || '-' || user_id AS evaluation_id, CASE WHEN user_id % 7 = 3 THEN NULL ELSE round(sum(value), 4) END AS mean_score
                FROM events GROUP BY event_type, user_id),
    scored AS (SELECT model, version, mean_score FROM versions JOIN metrics ON evaluation_id = model || '-' || version
               WHERE version % 5 <> 0 AND mean_score IS NOT NULL)"""


def scored(t):
    """Model versions whose evaluation is found by a tag; some are missing."""
    events = t("events")
    tags = F.when(
        F.col("version") % 5 != 0,
        F.map_from_arrays(
            F.array(F.lit("checkpoint"), F.lit("evaluation_id")),
            F.array(F.col("version").cast("string"), F.concat_ws("-", "model", "version")),
        ),
    ).otherwise(F.map_from_arrays(F.array(F.lit("checkpoint")), F.array(F.col("version").cast("string"))))
    versions = events.groupBy(F.col("event_type").alias("model"), F.col("user_id").alias("version")).agg(
        F.min("event_id").alias("first_event")
    )
    metrics = (
        events.groupBy("event_type", "user_id")
        .agg(F.round(F.sum("value"), 4).alias("total"))
        .select(
            F.concat_ws("-", "event_type", "user_id").alias("evaluation_id"),
            F.when(F.col("user_id") % 7 != 3, F.col("total")).alias("mean_score"),
        )
    )
    return ev.version_scores(versions.withColumn("tags", tags), metrics).select("model", "version", "mean_score")


@query("version_scores", SQL_VERSIONS + " SELECT model, version, mean_score FROM scored")
def version_scores(t):
    return scored(t)


@query(
    "champion_challenger",
    SQL_VERSIONS
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY mean_score DESC, version) AS rn FROM scored)
      SELECT model, version, mean_score, CASE rn WHEN 1 THEN 'champion' ELSE 'challenger' END AS alias FROM r WHERE rn <= 2""",
)
def champion_challenger(t):
    return ev.champions(scored(t), "mean_score")
