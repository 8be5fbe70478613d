"""Dedup, resume, upsert, marking and work queues."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from talkmill import fixed
from talkmill.functions import text as tx
from talkmill.operators import dedup, keyed, membership, queues
from talkmill.plans.registry import query, sql_word_count
from talkmill.session import shared_path, stage
from talkmill.sources.readers import union_all


@query(
    "dedup_last_wins",
    """SELECT max(doc_id) AS doc_id, min(doc_id) AS position, text FROM documents GROUP BY text""",
)
def dedup_last_wins(t):
    return dedup.last_wins(t("documents").select("doc_id", "text"), F.col("text"), "doc_id")


@query("dedup_first_wins", "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def dedup_first_wins(t):
    return dedup.first_wins(t("documents").select("doc_id", "text"), F.col("text"), "doc_id")


@query(
    "insert_new_links",
    """WITH rows AS (SELECT event_id, user_id AS doc_id, value FROM events)
       SELECT doc_id, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM rows
       WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
)
def insert_new_links(t):
    rows = t("events").select("event_id", F.col("user_id").alias("doc_id"), "value")
    return dedup.insert_new(t("labels").select("doc_id"), rows, "doc_id", "event_id")


@query(
    "resume_anti_join",
    """SELECT doc_id, source, n_chars FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def resume_anti_join(t):
    labels = t("labels")
    done = [labels.filter("quality = 1"), labels.filter("toxic = 1")]
    return dedup.not_done(t("documents").select("doc_id", "source", "n_chars"), done, "doc_id")


@query(
    "source_split",
    """SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'valid' ELSE 'invalid' END AS outcome FROM documents""",
)
def source_split(t):
    valid, invalid = dedup.split_known(t("documents").select("doc_id"), t("labels"), "doc_id")
    return union_all([valid.withColumn("outcome", F.lit("valid")), invalid.withColumn("outcome", F.lit("invalid"))])


SQL_STORE = f"""WITH old AS (
      SELECT doc_id AS link, lang AS title, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN 'x' ELSE NULL END AS content,
             CASE WHEN doc_id % 3 = 0 THEN TIMESTAMP '2024-01-01' END AS time, CASE WHEN doc_id % 3 = 0 THEN {sql_word_count('text')} END AS word_count
      FROM documents WHERE doc_id % 11 <> 5),
    new AS (
      SELECT d.doc_id AS link, 'new ' || d.text AS content, TIMESTAMP '2025-01-01' AS time, {sql_word_count("'new ' || d.text")} AS word_count
      FROM documents d JOIN labels USING (doc_id))"""


def store(t):
    """A link store with stored, trivial and missing contents, lacking some links."""
    third = F.col("doc_id") % 3
    stored = third == 0
    return t("documents").filter(F.col("doc_id") % 11 != 5).select(
        F.col("doc_id").alias("link"),
        F.col("lang").alias("title"),
        F.when(stored, F.col("text")).when(third == 1, "x").alias("content"),
        F.when(stored, F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")).alias("time"),
        F.when(stored, tx.word_count(F.col("text"))).alias("word_count"),
    )


@query(
    "link_content_upsert",
    SQL_STORE
    + """SELECT coalesce(o.link, n.link) AS link, title,
            CASE WHEN n.link IS NOT NULL AND NOT coalesce(length(o.content) > 1, false) THEN n.content ELSE o.content END AS content,
            CASE WHEN n.link IS NOT NULL AND NOT coalesce(length(o.content) > 1, false) THEN n.time ELSE o.time END AS time,
            CASE WHEN n.link IS NOT NULL AND NOT coalesce(length(o.content) > 1, false) THEN n.word_count ELSE o.word_count END AS word_count,
            CASE WHEN o.link IS NULL THEN 'inserted' WHEN n.link IS NULL THEN 'none' WHEN coalesce(length(o.content) > 1, false) THEN 'kept' ELSE 'updated' END AS action
         FROM old o FULL JOIN new n ON o.link = n.link""",
)
def link_content_upsert(t):
    return dedup.upsert_content(store(t), new_contents(t))


def new_contents(t):
    fresh = F.concat(F.lit("new "), F.col("text"))
    return t("documents").join(t("labels").select("doc_id"), "doc_id").select(
        F.col("doc_id").alias("link"),
        fresh.alias("content"),
        F.lit(datetime(2025, 1, 1)).cast("timestamp_ntz").alias("time"),
        tx.word_count(fresh).alias("word_count"),
    )


@query(
    "upsert_buckets",
    SQL_STORE
    + """, merged AS (SELECT coalesce(o.link, n.link) AS link, title,
            CASE WHEN n.link IS NOT NULL AND NOT coalesce(length(o.content) > 1, false) THEN n.content ELSE o.content END AS content,
            CASE WHEN n.link IS NOT NULL AND NOT coalesce(length(o.content) > 1, false) THEN n.time ELSE o.time END AS time,
            CASE WHEN n.link IS NOT NULL AND NOT coalesce(length(o.content) > 1, false) THEN n.word_count ELSE o.word_count END AS word_count,
            l.doc_id IS NOT NULL AS seen, quality = 1 AS ok
         FROM old o FULL JOIN new n ON o.link = n.link LEFT JOIN labels l ON l.doc_id = coalesce(o.link, n.link))
       SELECT link, title, content, time, word_count, CASE WHEN seen THEN true END AS message_generated, CASE WHEN seen THEN ok END AS status
       FROM merged WHERE NOT coalesce(title = 'de' AND seen, false)""",
)
def upsert_buckets(t):
    """Contents, then outcomes, then deletions, each a commit of its own."""
    nothing = F.lit(None).cast("boolean")
    links = store(t).withColumns({"message_generated": nothing, "status": nothing})
    spark = links.sparkSession
    path = shared_path(spark, "links")
    keyed.create(links, "link", path, buckets=16)
    contents = new_contents(t)
    keyed.upsert(spark, path, contents, lambda old: dedup.upsert_content(old, contents).drop("action"))
    outcomes = t("labels").select(F.col("doc_id").alias("link"), (F.col("quality") == 1).alias("succeeded"))
    keyed.upsert(spark, path, outcomes, lambda old: dedup.mark_processed(old, outcomes))
    keyed.compact(spark, path)
    keyed.upsert(spark, path, outcomes, lambda old: old.filter("NOT coalesce(title = 'de', false)"))
    return keyed.snapshot(spark, path)


@query("resume_filtered", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_filtered(t):
    """Two earlier outputs, a filter of each, merged and stored."""
    labels = t("labels").select("doc_id", "quality")
    outputs = [labels.filter("quality = 1"), labels.filter("quality IS NULL OR quality <> 1")]
    blocks = membership.blocks_for(labels.count())
    stored = stage(membership.merged([membership.build(o, "doc_id", blocks) for o in outputs]), "filter")
    return membership.not_done(t("documents").select("doc_id", "source"), labels, stored, "doc_id", blocks)


@query("enrich_left", "SELECT l.doc_id AS link, quality, text AS content FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id AND d.lang = 'en'")
def enrich_left(t):
    source = t("documents").filter("lang = 'en'").select(F.col("doc_id").alias("link"), F.col("text").alias("content"))
    return dedup.enrich(t("labels").select(F.col("doc_id").alias("link"), "quality"), source)


@query(
    "mark_processed",
    """SELECT d.doc_id AS link, CASE WHEN l.doc_id IS NOT NULL THEN true END AS message_generated, CASE WHEN l.doc_id IS NOT NULL THEN quality = 1 END AS status
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def mark_processed(t):
    nothing = F.lit(None).cast("boolean")
    rows = t("documents").select(F.col("doc_id").alias("link"), nothing.alias("message_generated"), nothing.alias("status"))
    outcomes = t("labels").select(F.col("doc_id").alias("link"), (F.col("quality") == 1).alias("succeeded"))
    return dedup.mark_processed(rows, outcomes)


def with_flags(t):
    """Documents with missing contents and typed link flags from the labels."""
    labels = t("labels").select("doc_id", (F.col("toxic") == 1).alias("is_err_link"), (F.col("quality") == 1).alias("message_generated"))
    content = F.when(F.col("doc_id") % 4 == 0, F.lit(None)).when(F.col("doc_id") % 4 == 1, "").otherwise(F.col("text"))
    return t("documents").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("link"),
        content.alias("content"),
        "is_err_link",
        "message_generated",
        tx.word_count(F.col("text")).alias("word_count"),
        F.timestamp_add("HOUR", F.col("doc_id"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")).alias("time"),
    )


@query(
    "pending_and",
    """SELECT doc_id AS link FROM documents LEFT JOIN labels USING (doc_id) WHERE doc_id % 4 IN (0, 1) AND coalesce(toxic, 0) = 0""",
)
def pending_and(t):
    return queues.pending_both(with_flags(t)).select("link")


def worded(t):
    """The same flags as words."""
    rows = with_flags(t)
    content = F.when(F.col("content") == "", "nan").otherwise(F.col("content"))
    bad = F.when(F.col("link") % 5 == 0, "nan").when(F.col("is_err_link"), "True").when(~F.col("is_err_link"), "False")
    return rows.withColumns({"content": content, "is_err_link": bad})


@query(
    "pending_or",
    """SELECT doc_id AS link FROM documents LEFT JOIN labels USING (doc_id) WHERE doc_id % 4 IN (0, 1) OR doc_id % 5 = 0 OR coalesce(toxic, 0) = 0""",
)
def pending_or(t):
    return queues.pending_either(worded(t)).select("link")


@query("pending_content", "SELECT doc_id AS link FROM documents WHERE doc_id % 4 IN (0, 1)")
def pending_content(t):
    return queues.pending_content(worded(t)).select("link")


@query(
    "work_queue",
    f"""SELECT doc_id AS link, TIMESTAMP '2024-01-01' + to_hours(doc_id) AS time, {sql_word_count('text')} AS word_count
        FROM documents LEFT JOIN labels USING (doc_id)
        WHERE coalesce(quality, 0) <> 1 AND doc_id % 4 <> 0 AND {sql_word_count('text')} >= 100 AND doc_id >= 24 * 7
        ORDER BY time DESC, link LIMIT 3000""",
)
def work_queue(t):
    return queues.work_queue(with_flags(t), "message_generated", 100, datetime(2024, 1, 8), fixed.GENERATION_LIMIT).select("link", "time", "word_count")


@query("host_delete", r"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, 'example\.net')")
def host_delete(t):
    return dedup.delete_host(t("pages").select("page_id", "url"), r"example\.net", "url")
