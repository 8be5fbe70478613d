"""The operators of this package as queries over the given tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm import (
    byte_bpe, chat_format, circulant_minhash, cuckoo, filter_audit, heap_kmeans, html_text, kmeans_tree, mixing, ngram_join, quality, token_counts, toxicity,
)
from talkmill.llm.common import small_batches, stage
from talkmill.sources.readers import table


def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, [("user", said), ("assistant", said)])], "conv_id long, messages array<struct<role:string,content:string>>")
    return chat_format.read_back(chat_format.format_conversations(table(spark, folder, "conversations"), probe))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cuckoo.exact_copies(table(spark, folder, "documents"))


def _ranks() -> dict[bytes, int]:
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Digests are staged, a few columns a row: so texts meet the tasks in
    small batches, whatever the session's setting is."""
    ranks = _ranks()
    ids = F.col("ids")
    with small_batches(docs.sparkSession):
        return stage(byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN).select(
            "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(byte_bpe.ids_text(ids), 256).alias("ids_sha256"),
            F.sha2(byte_bpe.decoded(ids, ranks), 256).alias("decoded_sha256"),
        ), "digests")


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(table(spark, folder, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows, drawn = mixing.mixing_plan(table(spark, folder, "documents"))
    # What the shards hold of each row.
    copies = drawn.groupBy(F.struct("doc_id", "again").alias("_row")).agg(F.count("*").alias("n"))
    taken = rows.withColumn("_row", F.struct("doc_id", "again")).join(copies, "_row", "left")
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.coalesce("n", F.lit(0))).alias("taken"))


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(table(spark, folder, "pages"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans_tree.nearest(table(spark, folder, "embeddings"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _centroid_digest(components: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, components)).encode()).hexdigest()


def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return heap_kmeans.cluster_report(table(spark, folder, "embeddings"), _centroid_digest)


def op13_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return circulant_minhash.near_copies(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_formatting, op2_token_counts, op3_exact_dedup, op4_byte_bpe, op5_ngram_jaccard_join, op6_mixing, op7_html_extraction,
        op8_toxicity, op9_quality, op10_nearest_neighbours, op11_filter_audit, op12_centroid_clustering, op13_minhash_dedup,
    )
}

_TEXT = "coalesce(text, '')"
_PLAIN = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')"



def _linked_sql(width: int, least: int, kept: str = "") -> str:
    """Components of similar sets of word runs."""
    return rf"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i:i + {width - 1}], ' '))) END AS s FROM words),
grams AS MATERIALIZED (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS g FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM shared WHERE 100 * common >= {least} * (na + nb - common)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id{kept} FROM sets JOIN least ON a = doc_id"""


def _clusters_sql(clusters: int, rounds: int) -> str:
    """Lloyd rounds over integer components, step by step."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (SELECT row, any_value(v.c) AS c, any_value(vec_id) AS vec_id,
  min(list_sum(list_transform(list_zip(v.c, k.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {clusters} + k.k) AS best
  FROM v CROSS JOIN cent{i} k GROUP BY row)""")
        if i < rounds:
            steps.append(f"""
cell{i} AS (SELECT best % {clusters} AS k, unnest(c) AS x, generate_subscripts(c, 1) AS p FROM near{i}),
sum{i} AS (SELECT k, p, sum(x)::BIGINT AS s, count(*) AS n FROM cell{i} GROUP BY k, p),
mean{i} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY p) AS c FROM sum{i} GROUP BY k),
cent{i + 1} AS MATERIALIZED (SELECT o.k, coalesce(m.c, o.c) AS c FROM cent{i} o LEFT JOIN mean{i} m ON m.k = o.k)""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS c
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
cent0 AS MATERIALIZED (SELECT k, c FROM (SELECT c, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, c) - 1 AS k FROM v) WHERE k < {clusters}),{','.join(steps)},
done AS (SELECT vec_id, (best % {clusters})::INT AS cluster, (best // {clusters})::BIGINT AS distance FROM near{rounds})
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256 FROM done JOIN cent{rounds} ON k = cluster"""


#: DuckDB SQL for the results that SQL can express.
ORACLES: dict[str, str] = {
    "op1_chat_formatting": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (SELECT *, regexp_replace(regexp_replace(text,
    '(<)(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|startoftext\|>|s>|/s>|<SYS>>|</SYS>>)', '\1\\\2\3', 'g'),
    '(\[)(\\*)(INST\]|/INST\])', '\1\\\2\3', 'g') AS safe FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>' || role || chr(10) || safe || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id""",
    "op3_exact_dedup": rf"""
WITH t AS (SELECT doc_id, length({_TEXT}) AS chars, sha256({_PLAIN}) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h)::BIGINT AS group_size,
  row_number() OVER w = 1 AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h ORDER BY chars DESC, doc_id ASC NULLS LAST)""",
    "op5_ngram_jaccard_join": _linked_sql(5, 75),
    "op11_filter_audit": rf"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, {_TEXT} AS t,
    list_filter(string_split_regex({_TEXT}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
said AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failed AS MATERIALIZED (SELECT t.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {{
    'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), 'D': regexp_matches(t, '[#$%&*|]'),
    'E': coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY t), false)}} AS f FROM t LEFT JOIN said ON said.doc_id = t.doc_id),
long AS MATERIALIZED (SELECT part, good, toxic, count(*) AS n, f.A AS a, f.B AS b, f.C AS c, f.D AS d, f.E AS e FROM failed GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (SELECT p.l || q.l || r.l || s.l || u.l AS filter_order FROM letter p, letter q, letter r, letter s, letter u
  WHERE len(list_distinct([p.l, q.l, r.l, s.l, u.l])) = 5),
cells AS (SELECT part, good, toxic, n, filter_order, step, list_filter(['A', 'B', 'C', 'D', 'E'],
    lambda x: CASE x WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END) AS fails,
    filter_order[step] AS own, filter_order[1:step - 1] AS before
  FROM long, orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)),
judged AS (SELECT *, list_contains(fails, own) AS bad, len(list_filter(fails, lambda x: contains(before, x))) > 0 AS gone FROM cells),
steps AS (SELECT part, filter_order, step, any_value(own) AS own,
  coalesce(sum(n) FILTER (NOT gone AND NOT bad), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND bad), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (gone AND bad), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (bad AND len(fails) = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(n) FILTER (NOT gone AND bad AND good = 1), 0)::BIGINT AS good_lost,
  coalesce(sum(n) FILTER (NOT gone AND bad AND toxic = 1), 0)::BIGINT AS toxic_lost FROM judged GROUP BY part, filter_order, step)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM steps""",
    "op12_centroid_clustering": _clusters_sql(16, 3),
    "op13_minhash_dedup": _linked_sql(4, 80, ", doc_id = component_id AS kept"),
}
