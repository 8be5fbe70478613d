"""Text functions over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkmill.functions import markdown as md
from talkmill.functions import text as tx
from talkmill.operators import evaluation as ev
from talkmill.operators import profiling as pf
from talkmill.operators import queues as qu
from talkmill.operators import translate
from talkmill.plans.registry import query, sql_strip, sql_word_count, sql_words
from talkmill.session import shared_path

CJK = r"[\x{4e00}-\x{9fff}]"


@query(
    "mixed_script",
    f"""WITH d AS (
          SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN replace(text, ' the ', ' th中e ') WHEN 2 THEN replace(text, 'e', '中') ELSE text END AS text
          FROM documents),
        w AS (SELECT doc_id, {sql_words('text')} AS ws FROM d)
        SELECT doc_id,
               len(list_filter(ws, lambda x: length(x) > 3 AND regexp_matches(x, '{CJK}')
                     AND len(regexp_extract_all(x, '{CJK}')) / length(x) < 0.5)) > 0
               OR len(list_filter(ws, lambda x: regexp_matches(x, '{CJK}'))) / len(ws) > 0.4 AS mixed
        FROM w""",
)
def mixed_script(t):
    text = (
        F.when(F.col("doc_id") % 4 == 1, F.replace(F.col("text"), F.lit(" the "), F.lit(" th中e ")))
        .when(F.col("doc_id") % 4 == 2, F.replace(F.col("text"), F.lit("e"), F.lit("中")))
        .otherwise(F.col("text"))
    )
    return t("documents").select("doc_id", tx.mixed_script(text).alias("mixed"))


@query(
    "context_questions",
    r"""WITH q AS (
          SELECT conv_id, turn, CASE WHEN conv_id % 5 = 0 THEN replace(text, ' the ', ' Theo ')
                                     WHEN conv_id % 5 = 1 THEN text || ' N.Q.A' ELSE text END AS text
          FROM conversations WHERE role = 'user')
        SELECT conv_id, turn, regexp_matches(lower(text), 'theo|này|giá|trên') OR regexp_matches(text, '[A-Z](\.[A-Z])+\.') AS needs_context,
               regexp_matches(text, '[A-Z](\.[A-Z])+\.') AS initials
        FROM q""",
)
def context_questions(t):
    fifth = F.col("conv_id") % 5
    text = (
        F.when(fifth == 0, F.replace(F.col("text"), F.lit(" the "), F.lit(" Theo ")))
        .when(fifth == 1, F.concat("text", F.lit(" N.Q.A")))
        .otherwise(F.col("text"))
    )
    rows = t("conversations").filter("role = 'user'").withColumn("q", text)
    return rows.select(
        "conv_id",
        "turn",
        tx.needs_context(F.col("q")).alias("needs_context"),
        tx.has_initials(F.col("q")).alias("initials"),
    )


@query(
    "think_strip",
    f"""SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN {sql_strip('text')} WHEN turn % 4 = 2 THEN text || '<think></think>' ELSE text END AS title
        FROM conversations""",
)
def think_strip(t):
    text = (
        F.when(F.col("turn") % 2 == 1, F.concat(F.lit("a <think>\n"), "text", F.lit(" </think> b")))
        .when(F.col("turn") % 4 == 2, F.concat("text", F.lit("<think></think>")))
        .otherwise(F.col("text"))
    )
    return t("conversations").select("conv_id", "turn", tx.think_text(text).alias("title"))


@query(
    "tag_cleanup",
    r"""SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN E'\n' || text || E'\n' ELSE text END AS translated FROM conversations""",
)
def tag_cleanup(t):
    text = F.when(F.col("turn") % 2 == 1, F.concat(F.lit("```text\n"), "text", F.lit("\n```"))).otherwise(
        F.concat(F.lit("<msg>"), "text", F.lit("</msg>"))
    )
    return t("conversations").select("conv_id", "turn", tx.translation_cleanup(text).alias("translated"))


@query(
    "translate_resume",
    """WITH t AS (SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 7 = 3 THEN '' WHEN (conv_id + turn) % 7 = 5 AND turn > 1 THEN NULL ELSE text END AS text FROM conversations),
            s AS (SELECT conv_id, min(turn) FILTER (coalesce(text, '') = '') AS stop FROM t GROUP BY conv_id)
       SELECT conv_id, turn, E'\\nvi ' || text AS translated FROM t JOIN s USING (conv_id) WHERE stop IS NULL OR turn < stop""",
)
def translate_resume(t):
    """A third of the conversations, a part that broke before its commit, then
    everything, and once more."""
    place = (F.col("conv_id") + F.col("turn")) % 7
    text = F.when(place == 3, "").when((place == 5) & (F.col("turn") > 1), None).otherwise(F.col("text"))
    turns = t("conversations").select("conv_id", "turn", text.alias("text"))
    spark = turns.sparkSession
    path = shared_path(spark, "translated")

    def say(rows):
        said = F.concat(F.lit("```text\n<msg>vi "), F.col("text"), F.lit("</msg>```"))
        return rows.withColumn("translated", said)

    translate.translate(turns.filter("conv_id % 3 = 0"), path, say, parts=2)
    say(turns).select("conv_id", "turn", "translated").write.parquet(f"{path}/rows/run=broken")
    translate.translate(turns, path, say, parts=2)
    translate.translate(turns, path, say, parts=2)
    return translate.translated(spark, path)


@query(
    "date_conversion_report",
    """SELECT count(*) AS n_rows, count(*) FILTER (event_id % 10 > 0) AS converted, count(*) FILTER (event_id % 10 = 0) AS failed,
              min(date_trunc('day', ts)) FILTER (event_id % 10 > 0) AS first_day FROM events""",
)
def date_conversion_report(t):
    """The counters of one bulk conversion beside what it has written."""
    spoken = F.when(F.col("event_id") % 10 == 0, "Thứ sáu, ngày 31/02/2024").otherwise(F.date_format("ts", "d/M/yyyy"))
    events = t("events").select("event_id", tx.first_date(spoken).cast("timestamp_ntz").alias("day"))
    counters = {"n_rows": F.lit(True), "converted": F.col("day").isNotNull(), "failed": F.col("day").isNull()}
    written, found = pf.counted_table(events, "dates", **counters)
    return written.agg(*[F.lit(n).alias(name) for name, n in found.items()], F.min("day").alias("first_day"))


@query(
    "parse_dates",
    """SELECT event_id,
              CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN NULL ELSE date_trunc('day', ts) END AS day,
              CASE WHEN event_id % 10 = 1 THEN 'no date' ELSE strftime(ts, '%Y-%m-%dT%H:%M:00') END AS iso
       FROM events""",
)
def parse_dates(t):
    tenth = F.col("event_id") % 10
    spoken = (
        F.when(tenth == 0, "Thứ sáu, ngày 31/02/2024 - 11:39")
        .when(tenth == 1, "no date")
        .otherwise(F.concat(F.lit("Thứ sáu, ngày "), F.date_format("ts", "d/M/yyyy"), F.lit(" - 11:39")))
    )
    plain = F.when(tenth == 1, "no date").otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm"))
    return t("events").select(
        "event_id",
        tx.first_date(spoken).cast("timestamp_ntz").alias("day"),
        tx.iso_time(plain).alias("iso"),
    )


_UNWRAP = r"""regexp_replace({0}, '([^\n])\n([^\n\-*|])', '\1 \2', 'g')"""


@query(
    "markdown_clean",
    rf"""WITH p AS (
           SELECT doc_id, chr(1) || regexp_replace(text || E'\n', ' +', ' ', 'g') || chr(1) AS t FROM documents)
         SELECT doc_id, replace(replace(replace({_UNWRAP.format(_UNWRAP.format('t'))}, chr(1), ''), '** _', '**_'), '_ **', '_**') AS cleaned
         FROM p""",
)
def markdown_clean(t):
    return t("documents").select("doc_id", md.clean_markdown(F.col("text")).alias("cleaned"))


@query(
    "markdown_fences",
    rf"""WITH p AS (SELECT doc_id, text, chr(1) || regexp_replace(text, ' +', ' ', 'g') || chr(1) AS t FROM documents),
         u AS (SELECT doc_id, text, replace(replace(replace({_UNWRAP.format(_UNWRAP.format('t'))}, chr(1), ''), '** _', '**_'), '_ **', '_**') AS tidy FROM p)
         SELECT doc_id, tidy || '```' || text || '```' || tidy AS cleaned FROM u""",
)
def markdown_fences(t):
    fenced = F.concat("text", F.lit("```"), "text", F.lit("```"), "text")
    return t("documents").select("doc_id", md.normalise_markdown(fenced).alias("cleaned"))


@query(
    "table_repair",
    r"""SELECT doc_id, E'| name | size|\n| ---|---|\n| ' || doc_id || ' | ' || n_chars || E'|\n\n\n' || text || E'\n' AS repaired
        FROM documents""",
)
def table_repair(t):
    text = F.concat(
        F.lit("name | size\n---|---\n"), F.col("doc_id"), F.lit(" | "), F.col("n_chars"), F.lit("\n\n"), F.col("text")
    )
    return t("documents").select("doc_id", md.repair_tables(text).alias("repaired"))


@query(
    "sentinel_normalise",
    """SELECT event_id, CASE WHEN event_id % 5 IN (0, 1, 2) THEN NULL ELSE event_type END AS content,
              CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS is_err_link FROM events""",
)
def sentinel_normalise(t):
    fifth, fourth = F.col("event_id") % 5, F.col("event_id") % 4
    worded = t("events").select(
        "event_id",
        F.when(fifth == 0, "nan").when(fifth == 1, "None").when(fifth == 2, "").otherwise(F.col("event_type")).alias("content"),
        F.when(fourth == 0, "True").when(fourth == 1, "False").when(fourth == 2, "nan").alias("is_err_link"),
    )
    return pf.from_words(worded, ["content"], ["is_err_link"])


@query(
    "typed_columns",
    """SELECT event_id, CAST(user_id AS BIGINT) AS user_id, value, '{"k":' || json_extract_string(props, '$.k') || '}' AS props,
              '["' || event_type || '"]' AS tags, value > 10 AS high, ts, event_type FROM events""",
)
def typed_columns(t):
    rows = t("events").select(
        "event_id",
        F.col("user_id").cast("int").alias("user_id"),
        "value",
        F.from_json("props", "k int").alias("props"),
        F.array("event_type").alias("tags"),
        (F.col("value") > 10).alias("high"),
        "ts",
        "event_type",
    )
    return pf.typed(rows)


@query(
    "size_report",
    f"""SELECT CASE WHEN {sql_word_count('text')} < 1000 THEN 'short' ELSE 'long' END AS kind, count(*) AS n
        FROM documents GROUP BY 1""",
)
def size_report(t):
    kind = F.when(tx.word_count(F.col("text")) < 1000, "short").otherwise("long")
    return pf.by_kind(t("documents"), kind)


@query("latest_numeric_version", "SELECT max(user_id) AS latest_version FROM events")
def latest_numeric_version(t):
    tag = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("v"), F.col("user_id"))).otherwise(F.col("user_id").cast("string"))
    return ev.latest_numeric_version(t("events"), tx.version_number(tag))


@query(
    "checkpoint_numbers",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS checkpoint,
              event_type AS model, CAST(user_id AS VARCHAR) AS model_version FROM events""",
)
def checkpoint_numbers(t):
    path = F.concat(F.when(F.col("event_id") % 3 == 0, "out/final-").otherwise("out/checkpoint-"), F.col("event_id"))
    model = F.concat(F.lit("models:/"), F.col("event_type"), F.lit("/"), F.col("user_id"))
    return t("events").select(
        "event_id",
        tx.checkpoint_number(path).alias("checkpoint"),
        tx.registry_name(model).alias("model"),
        tx.registry_version(model).alias("model_version"),
    )


@query("capped_sample", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100")
def capped_sample(t):
    rows = t("documents").select("doc_id", "n_chars")
    return qu.capped(rows, [F.col("n_chars").desc(), F.col("doc_id")], 100)


@query(
    "profile_columns",
    """WITH p AS (
         SELECT 'event_id' AS column_name, CAST(event_id AS VARCHAR) AS v FROM events
         UNION ALL SELECT 'event_type', event_type FROM events UNION ALL SELECT 'props', props FROM events),
       d AS (SELECT column_name, v, row_number() OVER (PARTITION BY column_name ORDER BY v) AS r FROM (SELECT DISTINCT * FROM p))
       SELECT column_name, CASE column_name WHEN 'event_id' THEN 'BIGINT' WHEN 'event_type' THEN 'TEXT' ELSE 'OBJECT' END AS types,
              string_agg(v, ',' ORDER BY v) AS samples
       FROM d WHERE r <= 2 GROUP BY column_name""",
)
def profile_columns(t):
    profile = pf.column_profile(t("events").select("event_id", "event_type", "props"), samples=2)
    return profile.select(
        "column_name", F.array_join("types", ",").alias("types"), F.array_join("samples", ",").alias("samples")
    )


@query(
    "profile_sketches",
    """WITH e AS (SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(user_id AS VARCHAR) AS user_id,
              event_type, CAST(CAST(value AS BIGINT) AS VARCHAR) AS value, props FROM events),
         p AS (SELECT 'event_id' AS c, event_id AS v FROM e UNION ALL SELECT 'ts', ts FROM e UNION ALL SELECT 'user_id', user_id FROM e
           UNION ALL SELECT 'event_type', event_type FROM e UNION ALL SELECT 'value', value FROM e UNION ALL SELECT 'props', props FROM e),
         f AS (SELECT c, v, count(*) AS n FROM p WHERE v IS NOT NULL GROUP BY c, v),
         d AS (SELECT c, CAST(sum(n) AS BIGINT) AS n_values, min(v) AS smallest, max(v) AS largest, count(*) AS n_distinct, max(n) AS most FROM f GROUP BY c)
       SELECT c AS column_name, CASE WHEN c IN ('event_id', 'user_id', 'value') THEN 'BIGINT' WHEN c = 'props' THEN 'OBJECT' ELSE 'TEXT' END AS types,
         n_values, smallest, largest, CASE WHEN n_distinct <= 200 THEN n_distinct END AS n_distinct, CASE WHEN n_distinct <= 200 THEN most END AS most_frequent FROM d""",
)
def profile_sketches(t):
    """All columns of the events, in one scan.  Sketches are exact for few
    values; where there are more, they are left out here."""
    events = t("events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "user_id", "event_type", F.bround("value").cast("bigint").alias("value"), "props"
    )
    few = F.col("n_distinct") <= 200
    return pf.sketch_profile(events).select(
        "column_name",
        F.array_join("types", ",").alias("types"),
        "n_values",
        "smallest",
        "largest",
        F.when(few, F.col("n_distinct")).alias("n_distinct"),
        F.when(few, F.col("top")[0]["count"]).alias("most_frequent"),
    )


@query(
    "row_counts",
    """SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM documents WHERE lang = 'en') AS english""",
)
def row_counts(t):
    docs = t("documents")
    english = pf.row_count(docs, F.col("lang") == "en")
    return pf.row_count(docs).select(F.col("n").alias("documents"), english.scalar().alias("english"))
