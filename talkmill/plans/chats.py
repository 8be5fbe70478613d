"""Chat-store queries: pages, versions, deletes, votes, quotas."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from talkmill.operators import chatstore as ch
from talkmill.operators import versions as vs
from talkmill.plans.registry import query
from talkmill.session import shared_path
from talkmill.sources.readers import union_all


def ntz(value: datetime):
    return F.lit(value).cast("timestamp_ntz")


def order_chats(t):
    """Orders as chats of their customer."""
    return t("orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("userId"),
        F.col("o_orderdate").alias("createdAt"),
        F.when(F.col("o_orderstatus") == "O", "public").otherwise("private").alias("visibility"),
    )


@query(
    "chat_keyset_page",
    """WITH n AS (SELECT o_orderkey AS id, o_custkey AS "userId", row_number() OVER w AS rn, count(*) OVER (PARTITION BY o_custkey) AS n
                  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC))
       SELECT id, "userId", rn, (rn - 1) // 5 AS page, n > ((rn - 1) // 5 + 1) * 5 AS has_more FROM n""",
)
def chat_keyset_page(t):
    return ch.all_pages(order_chats(t), 5).select("id", "userId", "rn", "page", "has_more")


@query(
    "chat_cursor_walk",
    """WITH busy AS (SELECT o_custkey AS u FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1)
       SELECT o_orderkey AS id, (rn - 1) // 5 AS page, n > ((rn - 1) // 5 + 1) * 5 AS has_more
       FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn, count(*) OVER () AS n FROM orders, busy WHERE o_custkey = u)""",
)
def chat_cursor_walk(t):
    """All pages of the busiest user, each opened by the cursor before it."""
    chats = order_chats(t)
    spark = chats.sparkSession
    path = shared_path(spark, "pages")
    ch.write_pages(chats, path, 5)
    return union_all([page.select("id", "page", "has_more") for page in ch.walk_pages(spark, path, busiest(chats)[0])])


SQL_BUSY = """WITH busy AS (SELECT o_custkey AS u FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1),
    mine AS (SELECT o_orderkey AS id, o_orderdate AS created FROM orders, busy WHERE o_custkey = u),
    cur AS (SELECT created FROM (SELECT *, row_number() OVER (ORDER BY created DESC, id DESC) AS rn FROM mine) WHERE rn = 3)"""


def busiest(chats):
    """(user with most chats, id of their third newest chat)."""
    user = chats.groupBy("userId").count().orderBy(F.col("count").desc(), "userId").first()["userId"]
    third = chats.filter(F.col("userId") == user).orderBy(F.col("createdAt").desc(), F.col("id").desc()).limit(3)
    return user, third.collect()[-1]["id"]


@query(
    "chat_page_older",
    SQL_BUSY
    + """, older AS (SELECT id FROM mine WHERE created < (SELECT created FROM cur) ORDER BY created DESC, id DESC LIMIT 4),
      total AS (SELECT count(*) > 4 AS more FROM mine WHERE created < (SELECT created FROM cur))
      SELECT id, more AS has_more FROM older, total""",
)
def chat_page_older(t):
    chats = order_chats(t)
    user, cursor = busiest(chats)
    page, more = ch.keyset_page(chats, user, 4, ending_before=cursor)
    return page.select("id", F.lit(more).alias("has_more"))


@query(
    "chat_page_newer",
    SQL_BUSY
    + """ SELECT id, false AS has_more FROM mine WHERE created > (SELECT created FROM cur) ORDER BY created DESC, id DESC LIMIT 4""",
)
def chat_page_newer(t):
    chats = order_chats(t)
    user, cursor = busiest(chats)
    page, more = ch.keyset_page(chats, user, 4, starting_after=cursor)
    return page.select("id", F.lit(more).alias("has_more"))


@query("point_lookup", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_name = 'Customer#000000042'")
def point_lookup(t):
    return ch.lookup(t("customer").select("c_custkey", "c_name", "c_acctbal"), "c_name", "Customer#000000042")


def event_versions(t):
    """Events of a user as versions of that user's document."""
    return t("events").select(F.col("user_id").alias("id"), "ts", "event_id", "event_type")


ORDER = ["ts", "event_id"]


@query(
    "latest_version",
    """SELECT user_id AS id, ts, event_id, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_version(t):
    return vs.latest(event_versions(t), "id", ORDER)


@query(
    "nth_version",
    """SELECT user_id AS id, coalesce(max(ts) FILTER (rn = 60), TIMESTAMP '2025-01-01') AS version_time
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) GROUP BY user_id""",
)
def nth_version(t):
    return vs.nth_time(event_versions(t), "id", ORDER, 59, datetime(2025, 1, 1))


@query(
    "version_navigation",
    """SELECT event_id, row_number() OVER w AS version_no, lag(ts) OVER w AS prev_time,
              row_number() OVER w = count(*) OVER (PARTITION BY user_id) AS is_latest
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def version_navigation(t):
    return vs.navigation(event_versions(t), "id", ORDER).select("event_id", "version_no", "prev_time", "is_latest")


@query(
    "restore_version",
    """SELECT event_id, version_no FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version_no FROM events)
       WHERE version_no <= 11""",
)
def restore_version(t):
    return vs.restore(event_versions(t), "id", ORDER, 10).select("event_id", "version_no")


SQL_MARKS = """WITH marks AS (SELECT user_id, min(ts) + INTERVAL 20 DAY AS keep_until FROM events GROUP BY user_id)"""


@query(
    "delete_newer_versions",
    SQL_MARKS
    + """ SELECT 'document' AS kind, event_id FROM events JOIN marks USING (user_id) WHERE ts <= keep_until
      UNION ALL SELECT 'suggestion', event_id FROM events JOIN marks USING (user_id) WHERE ts <= keep_until AND event_type = 'click'
      UNION ALL SELECT 'deleted', event_id FROM events JOIN marks USING (user_id) WHERE ts > keep_until""",
)
def delete_newer_versions(t):
    documents = t("events").select(F.col("user_id").alias("id"), F.col("ts").alias("createdAt"), "event_id")
    suggestions = t("events").filter("event_type = 'click'").select(
        F.col("user_id").alias("documentId"), F.col("ts").alias("documentCreatedAt"), "event_id"
    )
    marks = documents.groupBy("id").agg((F.min("createdAt") + F.expr("INTERVAL 20 DAYS")).alias("keep_until"))
    kept, sug, gone = vs.delete_newer(documents, suggestions, marks)
    parts = [(kept, "document"), (sug, "suggestion"), (gone, "deleted")]
    return union_all([df.select(F.lit(kind).alias("kind"), "event_id") for df, kind in parts])


@query(
    "version_diff",
    r"""WITH v AS (SELECT doc_id, text, lag(text) OVER (PARTITION BY source ORDER BY doc_id) AS prev FROM documents),
        s AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '[^.!?]+[.!?]*\s*')) AS new,
                     list_distinct(regexp_extract_all(coalesce(prev, ''), '[^.!?]+[.!?]*\s*')) AS old FROM v)
        SELECT doc_id, CAST(len(list_filter(new, lambda x: NOT list_contains(old, x))) AS BIGINT) AS n_added,
               CAST(len(list_filter(old, lambda x: NOT list_contains(new, x))) AS BIGINT) AS n_removed FROM s""",
)
def version_diff(t):
    changes = vs.sentence_changes(t("documents").select("doc_id", "source", "text"), "source", ["doc_id"], "text")
    return changes.select(
        "doc_id", F.size("added").cast("bigint").alias("n_added"), F.size("removed").cast("bigint").alias("n_removed")
    )


def drafts(t):
    """Three versions of every document: its text; the first sentence moved to
    the end and doubled, each fifth one left out; all sentences reversed."""
    said = vs.sentences(F.coalesce("text", F.lit("")))
    docs = t("documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), said.alias("s"))
    thinned = F.filter("s", lambda x, i: (i > 0) & (i % 5 != 3))
    moved = F.concat(thinned, F.slice("s", 1, 1), F.slice("s", 1, 1))
    contents = F.array(F.col("text"), F.array_join(moved, ""), F.array_join(F.reverse("s"), ""))
    return docs.select("doc_id", F.posexplode(contents).alias("version", "content"))


SQL_DRAFTS = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^.!?]+[.!?]*\s*') AS s FROM documents),
    v AS (SELECT doc_id, 0 AS version, text AS content FROM d UNION ALL
      SELECT doc_id, 1, array_to_string(list_concat(list_filter(s, lambda x, i: i > 1 AND (i - 1) % 5 <> 3), s[1:1], s[1:1]), '') FROM d UNION ALL
      SELECT doc_id, 2, array_to_string(list_reverse(s), '') FROM d),
    c AS (SELECT doc_id, version, regexp_extract_all(content, '[^.!?]+[.!?]*\s*') AS new FROM v)"""


@query(
    "version_edits",
    SQL_DRAFTS
    + """ SELECT doc_id, version, CAST(len(new) AS BIGINT) AS n_new, CAST(len(old) AS BIGINT) AS n_old,
            sha256(array_to_string(new, '')) AS new_sha256, sha256(array_to_string(old, '')) AS old_sha256
          FROM (SELECT *, lag(new) OVER (PARTITION BY doc_id ORDER BY version) AS old FROM c) WHERE version > 0 AND len(new) + len(old) > 0""",
)
def version_edits(t):
    """Both texts of every pair of versions, put together from its script."""
    script = vs.edit_script(drafts(t), "doc_id", ["version"], "content")
    step = F.struct("position", "sentence")

    def side(kind: str):
        said = F.array_sort(F.collect_list(F.when(F.col("kind") != kind, step)))
        return said["sentence"]

    sides = script.groupBy("doc_id", "version").agg(side("removed").alias("new"), side("inserted").alias("old"))
    return sides.select(
        "doc_id",
        "version",
        F.size("new").cast("bigint").alias("n_new"),
        F.size("old").cast("bigint").alias("n_old"),
        F.sha2(F.array_join("new", ""), 256).alias("new_sha256"),
        F.sha2(F.array_join("old", ""), 256).alias("old_sha256"),
    )


@query(
    "suggestion_spans",
    r"""WITH s AS (SELECT doc_id, text, CASE WHEN doc_id % 4 = 0 THEN 'zz' || text ELSE regexp_extract(text, '[^.\s]+\.?\s*$') END AS original FROM documents)
        SELECT doc_id, CAST(CASE WHEN instr(text, original) > 0 THEN instr(text, original) - 1 ELSE 0 END AS BIGINT) AS selection_start,
               CAST(CASE WHEN instr(text, original) > 0 THEN instr(text, original) - 1 + length(original) ELSE 0 END AS BIGINT) AS selection_end FROM s""",
)
def suggestion_spans(t):
    made = F.timestamp_add("HOUR", F.col("doc_id"), ntz(datetime(2024, 1, 1)))
    docs = t("documents").select("doc_id", F.col("source").alias("id"), made.alias("createdAt"), F.col("text").alias("content"))
    tail = F.regexp_extract("content", r"[^.\s]+\.?\s*\z", 0)
    suggestions = docs.select(
        "doc_id",
        F.col("id").alias("documentId"),
        F.col("createdAt").alias("documentCreatedAt"),
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("zz"), "content")).otherwise(tail).alias("originalText"),
    )
    return vs.suggestion_spans(suggestions, docs).select("doc_id", "selection_start", "selection_end")


def store(t):
    """Customers as chats, orders as messages, line items as votes."""
    chats = t("customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    messages = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("chatId"), F.col("o_orderdate").alias("createdAt"))
    owner = messages.select(F.col("id").alias("messageId"), "chatId")
    votes = t("lineitem").select(F.col("l_orderkey").alias("messageId"), "l_linenumber").join(owner, "messageId")
    return chats, messages, votes


@query(
    "cascade_delete",
    """WITH doomed AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
       SELECT 'chat' AS kind, c_custkey AS id, 0 AS n FROM customer WHERE c_custkey NOT IN (FROM doomed)
       UNION ALL SELECT 'message', o_orderkey, 0 FROM orders WHERE o_custkey NOT IN (FROM doomed)
       UNION ALL SELECT 'vote', l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey NOT IN (FROM doomed)
       UNION ALL SELECT 'deleted', c_custkey, 0 FROM doomed""",
)
def cascade_delete(t):
    chats, messages, votes = store(t)
    left = ch.cascade_delete(chats, messages, votes, chats.filter("c_acctbal < 0"))
    kept, kept_messages, kept_votes, deleted = left
    zero = F.lit(0).alias("n")
    return union_all(
        [
            kept.select(F.lit("chat").alias("kind"), "id", zero),
            kept_messages.select(F.lit("message").alias("kind"), "id", zero),
            kept_votes.select(F.lit("vote").alias("kind"), F.col("messageId").alias("id"), F.col("l_linenumber").alias("n")),
            deleted.select(F.lit("deleted").alias("kind"), "id", zero),
        ]
    )


@query(
    "semi_delete",
    """WITH busy AS (SELECT o_custkey AS u FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1),
       gone AS (SELECT o_orderkey FROM orders, busy WHERE o_custkey = u AND o_orderdate >= TIMESTAMP '1997-01-01')
       SELECT 'message' AS kind, o_orderkey AS id, 0 AS n FROM orders WHERE o_orderkey NOT IN (FROM gone)
       UNION ALL SELECT 'vote', l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) AND l_orderkey NOT IN (FROM gone)
       UNION ALL SELECT 'deleted', o_orderkey, 0 FROM gone""",
)
def semi_delete(t):
    _, messages, votes = store(t)
    user, _ = busiest(order_chats(t))
    kept, kept_votes, deleted = ch.delete_after(messages, votes, user, datetime(1997, 1, 1))
    zero = F.lit(0).alias("n")
    return union_all(
        [
            kept.select(F.lit("message").alias("kind"), "id", zero),
            kept_votes.select(F.lit("vote").alias("kind"), F.col("messageId").alias("id"), F.col("l_linenumber").alias("n")),
            deleted.select(F.lit("deleted").alias("kind"), "id", zero),
        ]
    )


@query(
    "messages_of_chats",
    "SELECT o_orderkey AS id, o_custkey AS \"chatId\" FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def messages_of_chats(t):
    _, messages, _ = store(t)
    chats = t("customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"))
    return ch.messages_of(messages, chats).select("id", "chatId")


@query(
    "messages_in_order",
    """SELECT o_orderkey AS id, o_orderdate AS "createdAt" FROM orders
       WHERE o_custkey = (SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1)""",
)
def messages_in_order(t):
    _, messages, _ = store(t)
    user, _ = busiest(order_chats(t))
    return ch.in_time_order(messages, user).select("id", "createdAt")


SQL_VOTES = """WITH v AS (SELECT user_id AS m, user_id % 10 + CASE WHEN event_type = 'view' AND user_id % 3 = 0 THEN 1 ELSE 0 END AS c, value > 8 AS up, event_type, event_id FROM events),
    stored AS (SELECT m, arg_max(c, event_id) AS c, arg_max(up, event_id) AS up FROM v WHERE event_type = 'click' GROUP BY m),
    fresh AS (SELECT m, arg_max(c, event_id) AS c, arg_max(up, event_id) AS up FROM v WHERE event_type = 'view' GROUP BY m)"""


def vote_events(t):
    """Events as votes; some views belong to another chat than the stored vote."""
    chat = F.col("user_id") % 10 + F.when((F.col("event_type") == "view") & (F.col("user_id") % 3 == 0), 1).otherwise(0)
    return t("events").select(
        F.col("user_id").alias("messageId"), chat.alias("chatId"), (F.col("value") > 8).alias("isUpvoted"), "event_type", "event_id"
    )


@query(
    "vote_upsert",
    SQL_VOTES
    + """ SELECT coalesce(s.m, f.m) AS "messageId", coalesce(s.c, f.c) AS "chatId",
             CASE WHEN f.m IS NOT NULL AND (s.c IS NULL OR s.c = f.c) THEN f.up ELSE s.up END AS "isUpvoted"
      FROM stored s FULL JOIN fresh f ON s.m = f.m""",
)
def vote_upsert(t):
    votes = vote_events(t)
    stored = ch.latest_votes(votes.filter("event_type = 'click'"), ["event_id"])
    return ch.upsert_votes(stored, votes.filter("event_type = 'view'"), ["event_id"])


@query(
    "vote_of_answers",
    """WITH first AS (SELECT user_id AS m, arg_min(value > 8, event_id) AS up FROM events GROUP BY user_id)
       SELECT conv_id * 1000 + turn AS "messageId", conv_id AS "chatId", up AS "isUpvoted"
       FROM conversations JOIN first ON m = conv_id * 1000 + turn WHERE role = 'assistant'""",
)
def vote_of_answers(t):
    messages = t("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("conv_id").alias("chatId"), "role")
    return ch.vote_of_answers(messages, vote_events(t), ["event_id"])


NOW = datetime(2024, 1, 29, 12)
SQL_COUNTS = """WITH counts AS (SELECT user_id % 40 AS "userId", count(*) AS n_messages FROM events
    WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-26 12:00:00' GROUP BY 1)"""


def quota_counts(t):
    messages = t("events").select(
        F.col("user_id").alias("chatId"),
        F.when(F.col("event_type") == "error", "assistant").otherwise("user").alias("role"),
        F.col("ts").alias("createdAt"),
    )
    chats = t("events").select(F.col("user_id").alias("id"), (F.col("user_id") % 40).alias("userId")).distinct()
    return ch.message_counts(messages, chats, NOW, hours=72)


@query("quota_counts", SQL_COUNTS + ' SELECT "userId", n_messages FROM counts')
def quota_counts_query(t):
    return quota_counts(t)


@query(
    "quota_breach",
    SQL_COUNTS
    + """ SELECT "userId", n_messages, CASE WHEN "userId" % 2 = 0 THEN 'guest' ELSE 'regular' END AS user_type,
             CASE WHEN "userId" % 2 = 0 THEN 20 ELSE 100 END AS quota
      FROM counts WHERE n_messages > CASE WHEN "userId" % 2 = 0 THEN 20 ELSE 100 END""",
)
def quota_breach(t):
    kind = F.when(F.col("userId") % 2 == 0, "guest").otherwise("regular")
    return ch.over_quota(quota_counts(t).withColumn("user_type", kind))


@query(
    "recency_buckets",
    """SELECT event_id, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-30' THEN 'today' WHEN CAST(ts AS DATE) = DATE '2024-01-29' THEN 'yesterday'
              WHEN ts > TIMESTAMP '2024-01-30 10:00:00' - INTERVAL 7 DAY THEN 'lastWeek'
              WHEN ts > TIMESTAMP '2024-01-30 10:00:00' - INTERVAL 1 MONTH THEN 'lastMonth' ELSE 'older' END AS bucket
       FROM (SELECT event_id, ts - to_days(CAST(event_id % 40 AS INT)) AS ts FROM events)""",
)
def recency_buckets(t):
    now = datetime(2024, 1, 30, 10)
    shifted = F.timestamp_add("DAY", -(F.col("event_id") % 40), F.col("ts"))
    return t("events").select("event_id", ch.recency(shifted, now).alias("bucket"))


@query(
    "quality_rules",
    """SELECT conv_id, turn, concat_ws(',', CASE WHEN NOT length(text) BETWEEN 1 AND 2000 THEN 'length' END, CASE WHEN role <> 'user' THEN 'role' END,
              CASE WHEN conv_id % 3 = 2 THEN 'attachment' END) AS faults FROM conversations""",
)
def quality_rules(t):
    types = F.when(F.col("conv_id") % 3 == 0, F.array(F.lit("image/png"))).when(
        F.col("conv_id") % 3 == 2, F.array(F.lit("image/jpeg"), F.lit("image/gif"))
    )
    faults = ch.request_faults(F.col("text"), F.col("role"), types)
    return t("conversations").select("conv_id", "turn", F.array_join(faults, ",").alias("faults"))


@query(
    "visible_rows",
    "SELECT o_orderkey AS id, o_custkey AS \"userId\" FROM orders WHERE o_orderstatus = 'O' OR o_custkey = 7",
)
def visible_rows(t):
    return ch.visible_to(order_chats(t), F.lit(7)).select("id", "userId")


@query(
    "visibility_update",
    """SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'public' WHEN o_orderstatus = 'O' THEN 'public' ELSE 'private' END AS visibility FROM orders""",
)
def visibility_update(t):
    urgent = t("orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("id"))
    return ch.set_visibility(order_chats(t), urgent, "public").select("id", "visibility")


SQL_DATA_VERSIONS = """WITH versions AS (SELECT CAST(user_id % 4 AS DOUBLE) AS version_number, min(ts) + INTERVAL 10 DAY AS ts, count(*) AS record_count FROM events GROUP BY 1)"""


def data_versions(t):
    return t("events").groupBy((F.col("user_id") % 4).cast("double").alias("version_number")).agg(
        (F.min("ts") + F.expr("INTERVAL 10 DAYS")).alias("timestamp"), F.count(F.lit(1)).alias("record_count")
    )


@query("latest_data_version", SQL_DATA_VERSIONS + " SELECT version_number, record_count FROM versions ORDER BY version_number DESC LIMIT 1")
def latest_data_version(t):
    return vs.latest_version(data_versions(t)).select("version_number", "record_count")


@query("new_since_version", SQL_DATA_VERSIONS + " SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM versions WHERE version_number = 3)")
def new_since_version(t):
    return vs.since_version(t("events").select("event_id", "ts"), data_versions(t), 3.0, "ts")


@query(
    "retrain_trigger",
    SQL_DATA_VERSIONS
    + """ SELECT count(*) AS new_records, count(*) > 500 AS is_train FROM events WHERE ts > (SELECT max(ts) FROM versions WHERE version_number = 3)""",
)
def retrain_trigger(t):
    return vs.retrain_check(vs.since_version(t("events"), data_versions(t), 3.0, "ts"))


@query("new_without_version", "SELECT count(*) AS new_records, true AS is_train FROM events")
def new_without_version(t):
    return vs.retrain_check(vs.since_version(t("events"), data_versions(t), 99.0, "ts"))
