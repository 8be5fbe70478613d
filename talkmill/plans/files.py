"""Round trips through files: every query writes the given tables to the shared
folder and reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmill.operators import conversations as cv
from talkmill.operators import packing, profiling
from talkmill.plans.registry import query
from talkmill.session import shared_path
from talkmill.sources import readers, writers

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TURN = "conv_id bigint, turn bigint, role string, text string"


def broken_lines(docs: DataFrame, path: str) -> None:
    """Documents as JSON lines, each tenth followed by a broken line."""
    line = F.to_json(F.struct(*docs.columns))
    cut = F.concat(F.substring(line, F.lit(1), F.length(line) - 1), F.lit("}}"))
    lines = F.when(F.col("doc_id") % 10 == 0, F.array(line, cut)).otherwise(F.array(line))
    docs.select(F.explode(lines).alias("value")).write.text(path)


@query("io_jsonl_tolerant", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def io_jsonl_tolerant(t):
    docs = t("documents")
    path = shared_path(docs.sparkSession, "lines")
    broken_lines(docs, path)
    return readers.json_lines(docs.sparkSession, path, DOCUMENT)


@query("io_line_report", "SELECT count(*) AS valid, count(*) FILTER (doc_id % 10 = 0) AS malformed FROM documents")
def io_line_report(t):
    docs = t("documents")
    path = shared_path(docs.sparkSession, "lines")
    broken_lines(docs, path)
    return readers.line_report(docs.sparkSession, path)


@query(
    "io_mixed_union",
    """SELECT conv_id AS id, turn, role, text, NULL AS lang FROM conversations
       UNION ALL SELECT doc_id, NULL, NULL, text, lang FROM documents""",
)
def io_mixed_union(t):
    turns, docs = t("conversations"), t("documents")
    spark = turns.sparkSession
    path = shared_path(spark, "mixed")
    # One JSON array per conversation and file of arrays; documents as lines.
    entry = F.to_json(F.struct(F.col("conv_id").alias("id"), "turn", "role", "text"))
    arrays = turns.select(F.concat(F.lit("["), entry, F.lit("]")).alias("value"))
    arrays.write.option("lineSep", "\n").text(f"{path}/arrays")
    docs.select(F.to_json(F.struct(F.col("doc_id").alias("id"), "text", "lang")).alias("value")).write.text(f"{path}/lines")
    first = readers.json_array_lines(spark, f"{path}/arrays", "id bigint, turn bigint, role string, text string")
    second = readers.json_lines(spark, f"{path}/lines", "id bigint, text string, lang string")
    return readers.union_all([first, second])


def array_files(docs: DataFrame, path: str) -> None:
    """Documents as JSON arrays of neighbouring ids, one array in each file."""
    block = F.floor(F.col("doc_id") / 500).alias("block")
    entry = F.to_json(F.struct("doc_id", "text", "lang"))
    arrays = docs.groupBy(block).agg(F.concat(F.lit("["), F.array_join(F.collect_list(entry), ","), F.lit("]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


@query("io_json_arrays", "SELECT doc_id, text, lang FROM documents")
def io_json_arrays(t):
    docs = t("documents")
    path = shared_path(docs.sparkSession, "arrays")
    array_files(docs, path)
    return readers.json_arrays(docs.sparkSession, path, "doc_id bigint, text string, lang string", "*.txt")


ARRAY_BYTES = 256 << 20  # bytes of texts in one array


def long_arrays(docs: DataFrame, path: str) -> None:
    """All documents as arrays over several lines, in the order of their ids;
    one array in each file, of a size that one task can write and several
    read.  Small tables give one."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // ARRAY_BYTES))
    bounds = docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.001) if n > 1 else []
    part = sum((F.when(F.col("doc_id") >= b, 1).otherwise(0) for b in bounds), F.lit(0))
    rows = docs.select(part.alias("part"), "doc_id", F.to_json(F.struct("doc_id", "text", "lang")).alias("entry"))
    inside = Window.partitionBy("part").orderBy("doc_id")
    begin = F.when(F.row_number().over(inside) == 1, "[ ").otherwise(", ")
    end = F.when(F.lead(F.lit(1)).over(inside).isNull(), "\n]").otherwise("")
    rows.select("part", F.concat(begin, "entry", end).alias("value")).write.partitionBy("part").text(path)


@query("io_split_array", "SELECT doc_id, text, lang FROM documents")
def io_split_array(t):
    docs = t("documents")
    spark = docs.sparkSession
    path = shared_path(spark, "array")
    long_arrays(docs, path)
    return readers.split_json_arrays(spark, path, "doc_id bigint, text string, lang string", "*.txt")


@query(
    "io_mixed_directory",
    """SELECT doc_id, NULL::BIGINT AS conv_id, text, true AS named FROM documents
       UNION ALL SELECT NULL, conv_id, text, true FROM conversations""",
)
def io_mixed_directory(t):
    docs, turns = t("documents"), t("conversations")
    path = shared_path(docs.sparkSession, "directory")
    array_files(docs, f"{path}/arrays")
    turns.select("conv_id", "text").write.json(f"{path}/lines")
    both = readers.mixed_directory(
        docs.sparkSession, path, "doc_id bigint, text string, lang string", "conv_id bigint, text string", "*.txt", "*.json"
    )
    return both.select("doc_id", "conv_id", "text", (F.length("file_name") > 0).alias("named"))


@query("io_csv_results", "SELECT doc_id, text, lang, n_chars FROM documents")
def io_csv_results(t):
    docs = t("documents").select("doc_id", "text", "lang", "n_chars")
    path = shared_path(docs.sparkSession, "csv")
    writers.csv_results(docs, path)
    reader = docs.sparkSession.read.schema("doc_id bigint, text string, lang string, n_chars bigint")
    return reader.option("header", True).option("escape", '"').option("multiLine", True).csv(path)


@query("io_append", "SELECT event_type, count(*) * 2 AS n FROM events GROUP BY event_type")
def io_append(t):
    events = t("events").select("event_id", "event_type")
    path = shared_path(events.sparkSession, "append")
    writers.append(events, path)
    writers.append(events, path)
    stored = readers.collection(events.sparkSession, path, columns=("event_type",))
    return stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("io_rolling_files", "SELECT count(*) AS n, true AS within_limit FROM events")
def io_rolling_files(t):
    events = t("events").select("event_id", "value")
    path = shared_path(events.sparkSession, "rolling")
    writers.rolling_json(events, path, 1000)
    rows = events.sparkSession.read.schema("event_id bigint, value double").json(path)
    per_file = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("k"))
    return per_file.agg(F.sum("k").alias("n"), (F.max("k") <= 1000).alias("within_limit"))


@query(
    "io_split_write",
    "SELECT doc_id, CASE WHEN doc_id % 4 = 0 OR lang = 'de' THEN 'bad' ELSE 'good' END AS outcome FROM documents",
)
def io_split_write(t):
    docs = t("documents").select("doc_id", "lang", F.when(F.col("doc_id") % 4 != 0, F.col("text")).alias("content"))
    path = shared_path(docs.sparkSession, "split")
    writers.split_write(docs, (F.col("lang") != "de") & F.col("content").isNotNull(), path)
    return docs.sparkSession.read.schema("doc_id bigint, outcome string").json(path)


@query(
    "io_chunked_export",
    """SELECT (rn - 1) // 5000 AS chunk, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high
       FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) GROUP BY 1""",
)
def io_chunked_export(t):
    rows = t("orders").select("o_orderkey", "o_orderdate")
    path = shared_path(rows.sparkSession, "export")
    writers.chunked(packing.export_chunks(rows, [F.col("o_orderdate"), F.col("o_orderkey")], 5000), path)
    back = rows.sparkSession.read.schema("o_orderkey bigint, chunk bigint").json(path)
    return back.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")
    )


@query(
    "export_resume",
    """SELECT o_orderkey, o_orderdate, rn, (rn - 1) // 5000 AS chunk
       FROM (SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)""",
)
def export_resume(t):
    """An export that broke after a third of its chunks, then the rest."""
    rows = t("orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"))
    spark = rows.sparkSession
    path = shared_path(spark, "export")
    numbered = packing.export_chunks(rows, [F.col("o_orderdate"), F.col("o_orderkey")], 5000)
    writers.export_committed(numbered.filter("chunk % 3 = 0"), path)
    writers.export_committed(numbered, path)
    back = writers.read_export(spark, path, "o_orderkey bigint, o_orderdate string, rn bigint")
    kind = t("orders").schema["o_orderdate"].dataType
    return back.withColumn("o_orderdate", F.col("o_orderdate").cast(kind))


@query("io_manifest", "SELECT 'conv_' || conv_id % 3 AS name, 'conv_' || conv_id % 3 || '.jsonl' AS file_name, 'role' AS role_tag FROM conversations GROUP BY 1, 2")
def io_manifest(t):
    named = t("conversations").select(F.concat(F.lit("conv_"), F.col("conv_id") % 3, F.lit(".jsonl")).alias("file_name"))
    return writers.manifest(named).select("name", "entry.file_name", F.col("entry.tags.role_tag").alias("role_tag"))


@query(
    "io_manifest_scan",
    "SELECT count(*) AS n_rows, true AS all_named, true AS all_tagged FROM documents",
)
def io_manifest_scan(t):
    docs = t("documents")
    spark = docs.sparkSession
    path = shared_path(spark, "scanned")
    writers.rolling_json(docs, path, 500)
    scanned = spark.read.schema(DOCUMENT).json(path).select("_metadata.file_name")
    entries = writers.manifest(scanned).select(
        "name", "entry.file_name", (F.col("entry.tags.content_tag") == "content").alias("tagged")
    )
    per_file = scanned.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
    return per_file.join(entries, "file_name", "left").agg(
        F.sum("n").alias("n_rows"),
        F.bool_and(F.coalesce(F.concat("name", F.lit(".json")) == F.col("file_name"), F.lit(False))).alias("all_named"),
        F.bool_and(F.coalesce("tagged", F.lit(False))).alias("all_tagged"),
    )


@query(
    "io_json_results",
    "SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM (SELECT lang, n_chars FROM documents UNION ALL SELECT lang, n_chars FROM documents) GROUP BY lang",
)
def io_json_results(t):
    docs = t("documents").select("lang", "n_chars")
    path = shared_path(docs.sparkSession, "results")
    writers.json_results(docs, path)
    writers.json_results(docs, path)
    back = docs.sparkSession.read.schema("lang string, n_chars bigint").json(path)
    return back.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query(
    "io_corpus_size",
    """SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes, sum(strlen(text) + 1) / (1024 * 1024) AS megabytes, true AS has_files
       FROM documents WHERE text IS NOT NULL""",
)
def io_corpus_size(t):
    docs = t("documents").select("text").filter(F.col("text").isNotNull())
    path = shared_path(docs.sparkSession, "size")
    docs.write.text(path)
    return profiling.corpus_size(docs.sparkSession.read.text(path)).select(
        "bytes", "megabytes", (F.col("files") > 0).alias("has_files")
    )


@query(
    "io_template_tables",
    """SELECT conv_id, turn, 'sft' AS origin FROM conversations WHERE conv_id % 2 = 0 AND role <> 'system'
       UNION ALL SELECT conv_id, turn, 'thinking' FROM conversations WHERE conv_id % 2 = 0 AND role = 'assistant'""",
)
def io_template_tables(t):
    rows = t("conversations").withColumn("version", F.concat(F.lit("v"), F.col("conv_id") % 2))
    tables = {
        "sft": rows.filter("role <> 'system'").withColumn("origin", F.lit("sft")),
        "thinking": rows.filter("role = 'assistant'").withColumn("origin", F.lit("thinking")),
    }
    return readers.read_for_template(tables, "qwen3", "v0").select("conv_id", "turn", "origin")


@query("io_warehouse_scan", "SELECT conv_id, turn, text FROM conversations WHERE role = 'user'")
def io_warehouse_scan(t):
    turns = t("conversations")
    return readers.warehouse(
        turns.sparkSession, "SELECT conv_id, turn, text FROM {turns} WHERE role = 'user'", turns=turns
    )


@query("io_training_files", "SELECT conv_id, count(*) AS n_messages FROM conversations GROUP BY conv_id")
def io_training_files(t):
    nested = cv.nest(t("conversations")).withColumn("word_count", F.size("messages"))
    path = shared_path(nested.sparkSession, "train")
    writers.upload_batches(nested, path)
    back = readers.json_lines(
        nested.sparkSession, path, "conv_id bigint, messages array<struct<role:string,content:string>>"
    )
    return back.groupBy("conv_id").agg(F.sum(F.size("messages")).alias("n_messages"))
