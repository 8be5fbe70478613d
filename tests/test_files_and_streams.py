import datetime as dt
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talkmill.functions import batches
from talkmill.operators import generate, metrics
from talkmill.operators import versions as vs
from talkmill.session import shared_path
from talkmill.sources import readers, writers
from talkmill.streaming import follow

LINES = ['{"id": 1, "x": "a"}', "[1]", '{"id": 2', '{"id": 3, "x": "b"}}', "{'id': 4}", "", '{"id": 5, "x": "c]"} ', "7", '{"id": 6}, {"id": 7}']


def parses(line):
    try:
        json.loads(line)
        return True
    except ValueError:
        return False


def test_tolerant_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(LINES))
    path = str(tmp_path)
    assert [r["id"] for r in readers.json_lines(spark, path, "id int, x string").orderBy("id").collect()] == [1, 5]
    kept = readers.json_lines(spark, path, "id int, x string", keep_bad=True)
    assert kept.filter("_corrupt IS NOT NULL").count() == len(LINES) - 2
    report = readers.line_report(spark, path).first()
    good = sum(map(parses, LINES))
    assert (report["valid"], report["malformed"]) == (good, len(LINES) - good)


def test_mixed_directory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.json").write_text('[{"id": 1, "x": "a"},\n {"id": 2, "x": "b"}]')
    (tmp_path / "b.jsonl").write_text('{"id": 3, "y": "c"}\nbroken\n')
    rows = readers.mixed_directory(spark, str(tmp_path), "id int, x string", "id int, y string").orderBy("id").collect()
    assert [(r["id"], r["x"], r["y"], r["file_name"]) for r in rows] == [
        (1, "a", None, "a.json"),
        (2, "b", None, "a.json"),
        (3, None, "c", "b.jsonl"),
    ]
    names = writers.manifest(readers.mixed_directory(spark, str(tmp_path), "id int")).orderBy("name").collect()
    assert [(r["name"], r["entry"]["file_name"]) for r in names] == [("a", "a.json"), ("b", "b.jsonl")]


def test_templates():
    assert readers.template_tables("qwen3") == ["thinking", "sft"]
    assert readers.template_tables("r1") == ["thinking"]
    assert readers.template_tables("llama") == ["sft"]


def test_log_metrics(spark):
    lines = ['{"current_steps": 5, "loss": 0.5, "lr": 1e-4, "step": 9, "ok": true, "t": "7", "n": null, "d": {"a": 1}}', '{"loss": -2}', "no", '{"a": 1}}', '[{"a": 1}]']
    rows = metrics.log_metrics(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert sorted((r["step"] or -1, r["key"], r["metric"]) for r in rows) == [
        (-1, "loss", -2.0),
        (5, "current_steps", 5.0),
        (5, "loss", 0.5),
        (5, "lr", 0.0001),
        (5, "ok", 1.0),
    ]


def test_generation_failures_are_per_row(spark):
    def make():
        def run(text):
            if "bad" in text:
                raise ValueError("no")
            return "### Question: q ### Answer: a"

        return run

    docs = spark.createDataFrame([("l1", "t", "good"), ("l2", "t", "bad")], "link string, time string, content string")
    made = generate.generate_pairs(docs, make)
    assert sorted((r["link"], r["failure"]) for r in made.collect()) == [("l1", None), ("l2", "ValueError: no")]
    assert sorted(map(tuple, generate.outcomes(made).collect())) == [("l1", True), ("l2", False)]


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 0, minute, second)


def stream_of(spark, tmp_path, batches, schema):
    """A file per batch, read one at a time in order."""
    for i, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, schema).coalesce(1)
        frame.write.mode("append").parquet(str(tmp_path / "in" / f"b{i}"))
    paths = str(tmp_path / "in" / "*")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(paths)


def test_late_rows_are_left_out_of_the_series(spark, tmp_path):
    schema = "ts timestamp, gpu string, value double"
    batches = [
        [(at(0, 1), "0", 1.0), (at(0, 14), "0", 2.0), (at(0, 16), "0", 5.0)],
        [(at(30), "0", 7.0)],
        # Lateness is judged by the mark of the batch before.
        [(at(30, 1), "0", 1.0)],
        [(at(0, 2), "0", 100.0), (at(29, 50), "0", 3.0)],
    ]
    stream = stream_of(spark, tmp_path, batches, schema)
    got = follow.to_latest(follow.series(stream, "gpu"), ["step", "gpu"], "t-series")
    rows = {r["step"]: (r["n"], r["sum_value"]) for r in got.collect()}
    assert rows == {at(0): (2, 3.0), at(0, 15): (1, 5.0), at(30): (2, 8.0), at(29, 45): (1, 3.0)}


def test_stalls(spark, tmp_path):
    schema = "ts timestamp, run string"
    batches = [[(at(0), "r"), (at(2), "r"), (at(0), "s")], [(at(10), "r")], [(at(20), "r"), (at(21), "s")]]
    stream = stream_of(spark, tmp_path, batches, schema)
    got = follow.to_table(follow.stalls(stream, "run", 180), "t-stalls").collect()
    assert sorted((r["run"], r["last_activity"], r["n"]) for r in got) == [("r", at(2), 2), ("r", at(10), 1), ("s", at(0), 1)]


def test_stall_limits():
    assert follow.stall_limit(started=False, completed=False) == 1440
    assert follow.stall_limit(started=True, completed=False) == 180
    assert follow.stall_limit(started=True, completed=True) == 300


def test_new_items_once(spark, tmp_path):
    schema = "path string"
    stream = stream_of(spark, tmp_path, [[("a",), ("a",), ("b",)], [("a",), ("c",)]], schema)
    got = follow.to_table(follow.new_items(stream, "path"), "t-items").collect()
    assert sorted(r["path"] for r in got) == ["a", "b", "c"]


@pytest.mark.parametrize("threshold, made", [(500, [1.0]), (4, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])])
def test_version_trigger(spark, tmp_path, threshold, made):
    versions, rows = shared_path(spark, "t-versions"), shared_path(spark, "t-rows")
    spark.createDataFrame([(1.0, "", at(0), 0, "DONE")], vs.VERSION_SCHEMA).write.parquet(versions)
    stream = stream_of(spark, tmp_path, [[(at(i),) for i in range(1, 6)], [(at(i),) for i in range(20, 24)]], "ts timestamp")
    run = follow.version_trigger(versions, rows, lambda: at(6), threshold=threshold)
    follow.run_available(stream.writeStream.foreachBatch(run), f"{rows}-checkpoint")
    found = spark.read.parquet(versions).orderBy("version_number").collect()
    assert [r["version_number"] for r in found] == made
    assert all(r["training_status"] == "PENDING" for r in found[1:])


def test_gauge_patterns_are_whole(spark):
    rows = spark.createDataFrame([("m", "n1", "1", 2.0), ("m", "n11", "1", 3.0)], "metric string, instance string, gpu string, value double")
    got = metrics.select_gauge(rows, "m", instance="n1", scale=10).collect()
    assert [(r["instance"], r["value"]) for r in got] == [("n1", 20.0)]


def test_split_write_is_one_pass(spark, tmp_path):
    rows = spark.range(10).select("id", F.when(F.col("id") < 3, F.lit("x")).alias("content"))
    writers.split_write(rows, F.col("content").isNotNull(), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert {r["outcome"]: r["count"] for r in back.groupBy("outcome").count().collect()} == {"good": 3, "bad": 7}


def test_generators_hold_few_prompts(spark, monkeypatch):
    """Prompts reach the generator by stretches of bounded bytes; the other
    columns, and whole batches as data frames, stay out of Python."""
    texts = pa.array(["a" * 40, None, "b" * 300, "é" * 30, "c"])
    assert list(batches.by_size(texts, 100)) == [(0, 2), (2, 1), (3, 2)]
    assert list(batches.by_size(pa.array([], pa.string()), 100)) == []
    docs = spark.createDataFrame([(i, "x" * i, 2**60 + i if i % 2 else None) for i in range(50)], "id int, prompt string, `odd name` bigint")
    got = generate.respond(docs, lambda: lambda text: None if text == "x" else text.upper())
    assert "InPandas" not in got._jdf.queryExecution().executedPlan().toString()
    want = {(i, "x" * i, 2**60 + i if i % 2 else None, None if i == 1 else "X" * i, None) for i in range(50)}
    assert {tuple(r) for r in got.collect()} == want
