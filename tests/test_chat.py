import datetime as dt

import pytest
from pyspark.sql import functions as F

from talkmill.operators import chatstore as ch
from talkmill.operators import dedup, profiling, queues
from talkmill.operators import versions as vs

T = [dt.datetime(2024, 1, d) for d in range(1, 10)]


@pytest.fixture()
def chats(spark):
    rows = [("a", "u", T[0]), ("b", "u", T[1]), ("c", "u", T[2]), ("z", "other", T[3])]
    return spark.createDataFrame(rows, "id string, userId string, createdAt timestamp")


def ids(df):
    return [r["id"] for r in df.collect()]


def test_keyset_pages(chats):
    page, more = ch.keyset_page(chats, "u", 2)
    assert (ids(page), more) == (["c", "b"], True)
    assert ch.next_cursor(page, more) == "b"
    page, more = ch.keyset_page(chats, "u", 2, ending_before="b")
    assert (ids(page), more) == (["a"], False) and ch.next_cursor(page, more) is None
    page, more = ch.keyset_page(chats, "u", 2, starting_after="a")
    assert (ids(page), more) == (["c", "b"], False)
    with pytest.raises(ch.UnknownCursor):
        ch.keyset_page(chats, "u", 2, ending_before="nope")
    with pytest.raises(ValueError):
        ch.keyset_page(chats, "u", 2, starting_after="a", ending_before="b")


def test_all_pages(chats):
    got = {r["id"]: (r["page"], r["has_more"]) for r in ch.all_pages(chats, 2).collect()}
    assert got == {"c": (0, True), "b": (0, True), "a": (1, False), "z": (0, False)}


def test_versions(spark):
    docs = spark.createDataFrame(
        [("d", T[i], f"Text {i}. Same.") for i in range(3)], "id string, createdAt timestamp, content string"
    )
    sug = docs.select(F.col("id").alias("documentId"), F.col("createdAt").alias("documentCreatedAt"), F.lit("Same.").alias("originalText"))
    marks = spark.createDataFrame([("d", T[0])], "id string, keep_until timestamp")
    kept, sug_kept, gone = vs.delete_newer(docs, sug, marks)
    assert [r["createdAt"] for r in kept.collect()] == [T[0]] and sug_kept.count() == 1
    assert sorted(r["createdAt"] for r in gone.collect()) == [T[1], T[2]]
    assert vs.latest(docs, "id", ["createdAt"]).first()["createdAt"] == T[2]
    assert vs.restore(docs, "id", ["createdAt"], 1).count() == 2
    assert vs.nth_time(docs, "id", ["createdAt"], 5, T[8]).first()["version_time"] == T[8]
    assert vs.nth_time(docs, "id", ["createdAt"], 1, T[8]).first()["version_time"] == T[1]
    changes = vs.sentence_changes(docs, "id", ["createdAt"], "content").orderBy("createdAt").collect()
    assert [(r["added"], r["removed"]) for r in changes] == [
        (["Text 0. ", "Same."], []),
        (["Text 1. "], ["Text 0. "]),
        (["Text 2. "], ["Text 1. "]),
    ]
    spans = vs.suggestion_spans(sug.withColumn("originalText", F.when(F.col("documentCreatedAt") == T[0], "Same.").otherwise("none")), docs)
    assert sorted((r["selection_start"], r["selection_end"]) for r in spans.collect()) == [(0, 0), (0, 0), (8, 13)]


def test_delete_after(spark):
    messages = spark.createDataFrame([("m1", "c", T[0]), ("m2", "c", T[1]), ("m3", "x", T[2])], "id string, chatId string, createdAt timestamp")
    votes = spark.createDataFrame([("m1", "c"), ("m2", "c"), ("m3", "x")], "messageId string, chatId string")
    kept, kept_votes, gone = ch.delete_after(messages, votes, "c", T[1])
    assert sorted(ids(kept)) == ["m1", "m3"] and ids(gone) == ["m2"]
    assert sorted(r["messageId"] for r in kept_votes.collect()) == ["m1", "m3"]


def test_votes(spark):
    schema = "messageId string, chatId string, isUpvoted boolean"
    stored = spark.createDataFrame([("m1", "c", True), ("m2", "c", True)], schema)
    new = spark.createDataFrame([("m1", "c", False, 1), ("m1", "c", True, 2), ("m1", "c", False, 3), ("m2", "x", False, 1), ("m3", "c", False, 1)], schema + ", n int")
    got = {r["messageId"]: (r["chatId"], r["isUpvoted"]) for r in ch.upsert_votes(stored, new, ["n"]).collect()}
    assert got == {"m1": ("c", False), "m2": ("c", True), "m3": ("c", False)}


def test_quota_refuses_the_one_after_the_limit(spark):
    now = dt.datetime(2024, 1, 2)
    chats = spark.createDataFrame([("c", "u")], "id string, userId string")
    for sent, over in ((20, 0), (21, 1)):
        messages = spark.range(sent).select(F.lit("c").alias("chatId"), F.lit("user").alias("role"), F.lit(now).alias("createdAt"))
        counts = ch.message_counts(messages, chats, now).withColumn("user_type", F.lit("guest"))
        assert ch.over_quota(counts).count() == over


def test_request_faults(values):
    ddl = "t string, r string, a array<string>"
    rows = [("hi", "user", ["image/png"]), ("", "user", None), ("x" * 2001, "assistant", ["text/html"]), ("x" * 2000, "user", [])]
    assert values(ch.request_faults, *rows, ddl=ddl) == [[], ["length"], ["length", "role", "attachment"], []]


def test_dedup(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")], "link string, n int, v string")
    assert sorted(map(tuple, dedup.last_wins(rows, F.col("link"), "n").select("position", "link", "v").collect())) == [(1, "a", "z"), (2, "b", "y")]
    assert sorted(r["v"] for r in dedup.first_wins(rows, F.col("link"), "n").collect()) == ["x", "y"]
    target = spark.createDataFrame([("b",)], "link string")
    assert [r["v"] for r in dedup.insert_new(target, rows, "link", "n").collect()] == ["x"]


def test_pending_forms(spark):
    typed = spark.createDataFrame([("a", None, None), ("b", "", True), ("c", "text", False), ("d", "", False)], "link string, content string, is_err_link boolean")
    assert [r["link"] for r in queues.pending_both(typed).collect()] == ["a", "d"]
    worded = spark.createDataFrame([("a", "nan", "True"), ("b", "x", "False"), ("c", "x", "True"), ("d", "", "True")], "link string, content string, is_err_link string")
    assert [r["link"] for r in queues.pending_either(worded).collect()] == ["a", "b"]
    assert [r["link"] for r in queues.pending_content(worded).collect()] == ["a", "d"]


def test_counters(spark):
    rows, seen = profiling.counted(spark.range(10), even=F.col("id") % 2 == 0, large=F.col("id") > 7)
    assert rows.count() == 10
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"even": 5, "large": 2}


def test_typed_floats(spark):
    rows = spark.createDataFrame([(1.7, [1], {"a": 1})], "f double, l array<int>, m map<string,int>")
    assert tuple(profiling.typed(rows).first()) == (1.7, "[1]", '{"a":1}')
    assert profiling.typed(rows, float_to_int=True).first()["f"] == 1
