"""Packing, groups, export and the training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkmill.functions import text as tx
from talkmill.operators import conversations as cv
from talkmill.operators import ordered, packing
from talkmill.plans.conversations import SQL_EMPTIED, emptied
from talkmill.plans.registry import query, sql_word_count
from talkmill.session import shared_path
from talkmill.sources import writers

SQL_DOCS = f"""WITH lens AS (SELECT doc_id, {sql_word_count('text')} AS word_count FROM documents),
    short AS (SELECT * FROM lens WHERE word_count < 1000),
    pos AS (SELECT *, row_number() OVER (ORDER BY word_count DESC, doc_id) - 1 AS pos FROM short),
    fit AS (SELECT coalesce(min(pos), (SELECT count(*) FROM short)) AS l2 FROM (
        SELECT pos, word_count + coalesce(lead(word_count) OVER (ORDER BY pos), 0) AS two FROM pos) WHERE two <= 1000),
    packed AS (SELECT pos.*, CASE WHEN pos < l2 THEN pos ELSE l2 + (pos - l2) // 2 END AS chunk_id,
                      CASE WHEN pos < l2 THEN 0 ELSE (pos - l2) % 2 END AS slot FROM pos, fit)"""


def document_lengths(t):
    return t("documents").select("doc_id", tx.word_count(F.col("text")).alias("word_count"))


@query(
    "pack_histogram",
    f"""SELECT word_count, count(*) AS n FROM (SELECT {sql_word_count('text')} AS word_count FROM documents)
        WHERE word_count < 1000 GROUP BY word_count""",
)
def pack_histogram(t):
    short, _ = packing.split_by_length(document_lengths(t), 1000)
    return short.groupBy("word_count").agg(F.count(F.lit(1)).alias("n"))


@query("pack_chunks", SQL_DOCS + " SELECT doc_id, word_count, pos, chunk_id, slot FROM packed")
def pack_chunks(t):
    return packing.pack(document_lengths(t), "doc_id", 1000, 2)


@query(
    "pack_chunks_wide",
    f"""WITH RECURSIVE lens AS (SELECT doc_id, {sql_word_count('text')} AS word_count FROM documents),
        pos AS (SELECT doc_id, word_count, row_number() OVER (ORDER BY word_count DESC, doc_id) - 1 AS pos FROM lens WHERE word_count < 600),
        fits AS (SELECT pos, CASE WHEN w + coalesce(w1, 0) + coalesce(w2, 0) <= 600 THEN 3 WHEN w + coalesce(w1, 0) <= 600 THEN 2 ELSE 1 END AS n
                 FROM (SELECT pos, word_count AS w, lead(word_count) OVER o AS w1, lead(word_count, 2) OVER o AS w2 FROM pos WINDOW o AS (ORDER BY pos))),
        starts AS (SELECT CAST(0 AS BIGINT) AS pos, CAST(0 AS BIGINT) AS chunk_id
                   UNION ALL SELECT s.pos + f.n, s.chunk_id + 1 FROM starts s JOIN fits f USING (pos))
        SELECT doc_id, pos.pos, chunk_id FROM pos ASOF JOIN starts ON pos.pos >= starts.pos""",
)
def pack_chunks_wide(t):
    return packing.pack(document_lengths(t), "doc_id", 600, 3).select("doc_id", "pos", "chunk_id")


SQL_CONV = f"""WITH first AS (SELECT conv_id, min(turn) AS first, arg_min(role, turn) AS role FROM conversations GROUP BY conv_id),
    turns AS (
      SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations GROUP BY conv_id HAVING count(*) > 1)
      UNION ALL
      SELECT conv_id, first - 1, 'system', 'Bạn là trợ lý hữu ích. /no_think' FROM first
      WHERE role <> 'system' AND conv_id IN (SELECT conv_id FROM conversations GROUP BY conv_id HAVING count(*) > 1)),
    lens AS (SELECT conv_id, sum({sql_word_count('text')}) AS word_count FROM turns GROUP BY conv_id),
    pos AS (SELECT *, row_number() OVER (ORDER BY word_count DESC, conv_id) - 1 AS pos FROM lens WHERE word_count < 1000),
    fit AS (SELECT coalesce(min(pos), (SELECT count(*) FROM pos)) AS l2 FROM (
        SELECT pos, word_count + coalesce(lead(word_count) OVER (ORDER BY pos), 0) AS two FROM pos) WHERE two <= 1000),
    packed AS (SELECT pos.*, CASE WHEN pos < l2 THEN pos ELSE l2 + (pos - l2) // 2 END AS chunk_id,
                      CASE WHEN pos < l2 THEN 0 ELSE (pos - l2) % 2 END AS slot FROM pos, fit),
    opening AS (SELECT conv_id, min(turn) AS turn FROM turns GROUP BY conv_id)"""


SQL_SAID = (
    SQL_CONV
    + """, long AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS chunk_id FROM lens WHERE word_count >= 1000),
        said AS (
          SELECT chunk_id, CAST(-1 AS BIGINT) AS slot, turn, 'system' AS role, text, 'merged' AS kind FROM turns JOIN packed USING (conv_id) JOIN opening USING (conv_id, turn) WHERE slot = 0
          UNION ALL
          SELECT chunk_id, slot, turn, role, text, 'merged' FROM turns JOIN packed USING (conv_id) WHERE role IN ('user', 'assistant')
          UNION ALL
          SELECT chunk_id, CASE WHEN c.turn IS NULL THEN -1 ELSE 0 END, t.turn, t.role, t.text, 'long'
          FROM turns t JOIN long USING (conv_id) LEFT JOIN conversations c ON c.conv_id = t.conv_id AND c.turn = t.turn)"""
)


@query("pack_merge", SQL_SAID + " SELECT chunk_id, slot, turn, role, text, kind FROM said")
def pack_merge(t):
    return packing.training_messages(t("conversations"))


@query(
    "training_set",
    SQL_SAID
    + f""", units AS (
          SELECT kind, chunk_id, CASE WHEN kind = 'long' THEN greatest(turn, 0) // 4096 ELSE 0 END AS part,
                 CAST(sum({sql_word_count('text')}) AS BIGINT) AS word_count, count(*) AS n_messages,
                 md5(string_agg(role || ':' || text, chr(30) ORDER BY slot, turn)) AS messages_md5
          FROM said GROUP BY 1, 2, 3),
        places AS (
          SELECT kind, group_id, row_number() OVER (ORDER BY md5(kind || '/' || group_id || '/0'), kind, group_id) - 1 AS place
          FROM (SELECT DISTINCT kind, chunk_id // 16 AS group_id FROM units))
        SELECT units.*, group_id, place FROM units JOIN places ON places.kind = units.kind AND group_id = chunk_id // 16""",
)
def training_set(t):
    rows = packing.training_set(t("conversations"))
    path = shared_path(rows.sparkSession, "training_set")
    order = ["place", "chunk_id", "part"]
    writers.rolling_json(rows.repartitionByRange(*order).sortWithinPartitions(*order), path)
    back = rows.sparkSession.read.schema(rows.schema).json(path)
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return back.select(
        "kind", "chunk_id", "part", "word_count", F.size("messages").cast("bigint").alias("n_messages"),
        F.md5(F.array_join(lines, "\x1e")).alias("messages_md5"), "group_id", "place",
    )


def worn(t):
    """Conversations with some empty turns and some CJK text."""
    turns = emptied(t)
    marked = (F.col("conv_id") % 5 == 2) & (F.col("turn") == 1)
    return turns.withColumn("text", F.when(marked, F.concat("text", F.lit(" 中文"))).otherwise(F.col("text")))


SQL_WORN = SQL_EMPTIED.replace("WITH t AS (", "WITH e AS (").replace("FROM t GROUP BY conv_id)", "FROM e GROUP BY conv_id)")


@query(
    "usable_conversations",
    SQL_WORN
    + f""", kept AS (
        SELECT e.*, count(*) OVER (PARTITION BY conv_id) AS n_left, max(turn) OVER (PARTITION BY conv_id) AS last,
               coalesce(cut_role = 'assistant', false) AS answer_empty
        FROM e JOIN cuts USING (conv_id)
        WHERE (cut IS NULL OR turn < cut) AND NOT (conv_id % 5 = 2 AND conv_id IN (SELECT conv_id FROM conversations WHERE turn = 1))),
      good AS (SELECT * FROM kept WHERE n_left - CAST(answer_empty AS INT) > 1 AND (NOT answer_empty OR turn < last))
      SELECT conv_id, count(*) AS n_messages,
             CAST(sum({sql_word_count('text')}) + CASE WHEN arg_min(role, turn) = 'system' THEN 0 ELSE 7 END AS BIGINT) AS word_count
      FROM good GROUP BY conv_id""",
)
def usable_conversations(t):
    return packing.usable(cv.measure(worn(t))).select("conv_id", "n_messages", "word_count")


@query(
    "batch_groups",
    SQL_DOCS
    + """, long AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS item FROM lens WHERE word_count >= 1000)
        SELECT 'short' AS kind, chunk_id // 16 AS group_id, chunk_id AS item, doc_id FROM packed
        UNION ALL
        SELECT 'long', item // 16, item, doc_id FROM long""",
)
def batch_groups(t):
    return packing.training_groups(document_lengths(t), "doc_id")


@query(
    "batch_groups_partial",
    SQL_DOCS
    + """, long AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS item FROM lens WHERE word_count >= 1000)
        SELECT 'short' AS kind, chunk_id // 16 AS group_id, chunk_id AS item, doc_id FROM packed
        WHERE chunk_id // 16 * 16 + 16 <= (SELECT max(chunk_id) + 1 FROM packed)
        UNION ALL
        SELECT 'long', item // 16, item, doc_id FROM long WHERE item // 16 * 16 + 16 <= (SELECT count(*) FROM long)""",
)
def batch_groups_partial(t):
    return packing.shuffle_groups(
        packing.training_groups(document_lengths(t), "doc_id", drop_tail="partial")
    ).drop("shuffle_key")


@query(
    "export_chunks",
    """WITH n AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
       SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, rn, (rn - 1) // 5000 AS chunk FROM n""",
)
def export_chunks(t):
    rows = t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return packing.export_chunks(rows, [F.col("o_orderdate"), F.col("o_orderkey")], 5000)


@query(
    "index_assign",
    """SELECT url, 100 + row_number() OVER (ORDER BY page_id) AS idx FROM pages""",
)
def index_assign(t):
    return ordered.index_rows(t("pages").select("page_id", "url"), 100, [F.col("page_id")]).drop("page_id")


@query("next_index", "SELECT max(CASE WHEN page_id % 7 = 0 THEN NULL ELSE page_id END) + 1 AS next_index FROM pages")
def next_index(t):
    text = F.when(F.col("page_id") % 7 == 0, "nan").otherwise(F.col("page_id").cast("string"))
    return ordered.next_index(t("pages").select(text.alias("idx")), "idx")
