"""Upserts by bucket, membership filters, committed exports, resumable
translation, page seeks, run counters and one-pass profiles."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from talkmill.operators import chatstore, keyed, membership, profiling, translate
from talkmill.sources import commits, writers


def data_files(path):
    return {str(f): (f.stat().st_mtime_ns, f.stat().st_size) for f in Path(path, "data").rglob("*.parquet")}


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def by_text(model):
    return sorted(model.items(), key=repr)


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"v{i}") for i in range(1000)]
    keyed.create(spark.createDataFrame(rows, "id bigint, v string"), "id", path, buckets=16)
    return path, dict(rows)


def test_upsert_touches_its_buckets_only(spark, table):
    path, model = table
    before = data_files(path)
    batch = spark.createDataFrame([(i,) for i in (3, 500, 5000, None)], "id bigint")

    def change(old):
        # Changes one, deletes one, adds one.
        kept = old.filter("id = 3").withColumn("v", F.lit("changed"))
        return kept.unionByName(spark.createDataFrame([(5000, "new")], old.schema))

    touched = keyed.upsert(spark, path, batch, change)
    model |= {3: "changed", 5000: "new"}
    del model[500]
    assert rows_of(keyed.snapshot(spark, path)) == by_text(model)
    after = data_files(path)
    assert {f: after[f] for f in before} == before  # nothing stored was touched
    fresh = [f for f in after if f not in before]
    assert len(touched) <= 3 and {int(f.split("bucket=")[1].split("/")[0]) for f in fresh} == set(touched)
    assert spark.read.parquet(*fresh).count() == 3


def test_upserts_add_up_and_compact(spark, table):
    path, model = table
    rng = random.Random(1)
    for step in range(4):
        keys = rng.sample(range(1200), 40)
        batch = spark.createDataFrame([(k, f"s{step}") for k in keys], "id bigint, v string")
        gone = {k for k in keys if k % 5 == 0}
        keyed.upsert(spark, path, batch, lambda old, b=batch: b.filter("id % 5 <> 0"))
        model = {k: v for k, v in model.items() if k not in gone} | {k: f"s{step}" for k in keys if k not in gone}
        assert rows_of(keyed.snapshot(spark, path)) == by_text(model)
    before = data_files(path)
    done = keyed.compact(spark, path, share=0.2)
    state = keyed.State(spark, path)
    assert done and not {e["bucket"] for e in state.deltas} & set(done)
    assert rows_of(state.rows()) == by_text(model)
    assert all(data_files(path)[f] == before[f] for f in before)
    assert keyed.compact(spark, path, share=0.2) == []


def test_failed_upsert_leaves_the_old_state(spark, table, monkeypatch):
    path, model = table
    batch = spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, v string")

    def broken(*_):
        raise OSError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", broken)
        with pytest.raises(OSError):
            keyed.upsert(spark, path, batch, lambda old: batch)
    assert rows_of(keyed.snapshot(spark, path)) == by_text(model)
    with pytest.raises(Exception, match="lost inside"):
        fails = F.raise_error(F.lit("lost inside")).cast("string")
        keyed.upsert(spark, path, batch, lambda old: old.withColumn("v", fails))
    keyed.upsert(spark, path, batch, lambda old: batch)
    assert rows_of(keyed.snapshot(spark, path)) == by_text(model | {1: "x", 2: "y"})


def test_keyed_edges(spark, tmp_path):
    path = str(tmp_path / "empty")
    with pytest.raises(ValueError):
        keyed.snapshot(spark, path)
    empty = spark.createDataFrame([], "id string, n int")
    keyed.create(empty, "id", path, buckets=4)
    assert keyed.snapshot(spark, path).count() == 0 and keyed.upsert(spark, path, empty, lambda old: old) == []
    keyed.upsert(spark, path, spark.createDataFrame([("a",)], "id string"), lambda old: spark.createDataFrame([("a", None)], "id string, n int"))
    assert rows_of(keyed.snapshot(spark, path)) == [("a", None)]
    # A key that is neither stored nor returned changes nothing.
    assert keyed.upsert(spark, path, spark.createDataFrame([("b",)], "id string"), lambda old: old) == []


def test_membership_filter(spark):
    known = spark.createDataFrame([(f"k{i}",) for i in range(3000)] + [("k1",), (None,)], "link string")
    blocks = membership.blocks_for(3000)
    halves = [known.filter("length(link) < 5 OR link IS NULL"), known.filter("length(link) >= 5")]
    stored = membership.merged([membership.build(h, "link", blocks) for h in halves])
    assert rows_of(stored) == rows_of(membership.build(known, "link", blocks))
    rows = spark.createDataFrame([(f"{p}{i}", i) for p in "kx" for i in range(3000)] + [(None, 7), ("x1", 8)], "link string, n int")
    marked = membership.marked(rows, stored, "link", blocks)
    assert marked.filter("link LIKE 'k%' AND NOT _maybe").count() == 0
    assert marked.filter("NOT coalesce(link, '') LIKE 'k%' AND _maybe").count() < 3000 * 0.05
    left = membership.not_done(rows, known, stored, "link", blocks)
    assert rows_of(left) == rows_of(rows.filter("link IS NULL OR link LIKE 'x%'"))
    # What the filter clears is not shuffled.
    clear = marked.filter(~F.col("_maybe"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(link" not in clear and "BroadcastHashJoin" in clear
    none = membership.build(known.limit(0), "link", 1)
    assert membership.not_done(rows, known.limit(0), none, "link", 1).count() == rows.count()
    assert [membership.blocks_for(n) for n in (0, 1, 3276, 3277, 10_000)] == [1, 1, 1, 2, 4]


def test_filter_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(membership, "BROADCAST_BYTES", 1)
    rows = spark.range(10).withColumnRenamed("id", "link")
    assert membership.not_done(rows, rows.filter("link < 4"), None, "link", 1).count() == 6


def test_export_goes_on_after_a_break(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "export")
    rows = spark.range(1000).select(F.col("id").alias("rn"), (F.col("id") * 7).alias("v"), F.floor(F.col("id") / 100).alias("chunk"))
    real, calls = commits.commit, []

    def breaks(*args):
        calls.append(args)
        if len(calls) == 3:
            raise OSError("lost")
        real(*args)

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", breaks)
        with pytest.raises(OSError):
            writers.export_committed(rows, path, chunks_per_commit=2)
    assert writers.read_export(spark, path, "rn bigint, v bigint").count() == 400
    before = data_files_of(path)
    assert writers.export_committed(rows, path, chunks_per_commit=2) == 6
    assert {f: data_files_of(path)[f] for f in before} == before
    back = writers.read_export(spark, path, "rn bigint, v bigint")
    assert rows_of(back.select("rn", "v", "chunk")) == rows_of(rows)
    facts = {r["chunk"]: r["n"] for r in writers.exported_chunks(spark, path).collect()}
    assert facts == {c: 100 for c in range(10)}
    # Unchanged chunks are left; a changed one is written again and replaces the old.
    assert writers.export_committed(rows, path) == 0
    changed = rows.withColumn("v", F.when(F.col("rn") == 250, -1).otherwise(F.col("v")))
    assert writers.export_committed(changed, path) == 1
    assert rows_of(writers.read_export(spark, path, "rn bigint, v bigint").select("rn", "v", "chunk")) == rows_of(changed)
    assert writers.export_committed(rows.limit(0), str(tmp_path / "none")) == 0
    assert writers.read_export(spark, str(tmp_path / "none"), "rn bigint").count() == 0


def data_files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path, "data").rglob("part-*")}


def test_translation_resumes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "translated")
    turns = [(c, t, "" if (c + t) % 5 == 4 else None if (c + t) % 11 == 10 else f"text {c} {t}") for c in range(40) for t in range(c % 6)]
    frame = spark.createDataFrame(turns + [(None, 0, "lost")], "conv_id bigint, turn bigint, text string")
    seen = []

    def translator(rows):
        seen.append(sorted({r[0] for r in rows.select("conv_id").distinct().collect()}))
        return rows.withColumn("translated", F.concat(F.lit("<msg>"), F.upper("text"), F.lit("</msg>")))

    real, calls = commits.commit, []

    def breaks(*args):
        calls.append(args)
        if len(calls) == 3:
            raise OSError("lost")
        real(*args)

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", breaks)
        with pytest.raises(OSError):
            translate.translate(frame, path, translator)
    first = {i for part in seen[:2] for i in part}
    seen.clear()
    translate.translate(frame, path, translator)
    assert first and not first & {i for part in seen for i in part}  # finished ones are not asked again
    want = []
    for conv in range(40):
        for c, t, text in sorted(x for x in turns if x[0] == conv):
            if not text:
                break
            want.append((c, t, text.upper()))
    assert rows_of(translate.translated(spark, path)) == sorted(want, key=repr)
    assert translate.translate(frame, path, translator) == 0
    assert rows_of(translate.translated(spark, path)) == sorted(want, key=repr)
    more = spark.createDataFrame([(99, 0, "late")], "conv_id bigint, turn bigint, text string")
    assert translate.translate(frame.unionByName(more), path, translator) == 1


def test_page_seeks(spark, tmp_path):
    path = str(tmp_path / "pages")
    rng = random.Random(2)
    chats = [(i, "hot" if i % 2 else f"u{i % 7}", rng.randrange(50)) for i in range(600)]
    frame = spark.createDataFrame(chats, "id bigint, userId string, createdAt int")
    chatstore.write_pages(frame, path, 10)
    want = {(r["userId"], r["page"], r["id"], r["rn"], r["has_more"]) for r in chatstore.all_pages(frame, 10).collect()}
    found = set()
    for user in {u for _, u, _ in chats}:
        for number, page in enumerate(chatstore.walk_pages(spark, path, user)):
            rows = page.collect()
            assert {r["page"] for r in rows} == {number}
            assert page.select(F.input_file_name()).distinct().count() == 1
            found |= {(r["userId"], r["page"], r["id"], r["rn"], r["has_more"]) for r in rows}
    assert found == want
    page, _ = chatstore.open_page(spark, path, "hot")
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "PushedFilters: [IsNotNull(userId)" in plan
    assert chatstore.open_page(spark, path, "nobody")[0].count() == 0
    with pytest.raises(chatstore.UnknownCursor):
        chatstore.open_page(spark, path, "hot", -5)


def test_counters_come_with_the_table(spark):
    rows = spark.range(100).withColumn("v", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")))
    written, found = profiling.counted_table(rows, "counted", good=F.col("v").isNotNull(), bad=F.col("v").isNull(), none=F.lit(False))
    assert found == {"good": 90, "bad": 10, "none": 0} and written.count() == 100
    _, empty = profiling.counted_table(rows.limit(0), "counted", good=F.lit(True))
    assert empty == {"good": 0}


def test_profile_in_one_scan(spark, tmp_path):
    rows = [(i, f"t{i % 3}", None, float(i) if i % 2 else None, "[1]" if i % 4 else '{"a": 1}', "") for i in range(5000)]
    frame = spark.createDataFrame(rows, "id bigint, kind string, void string, `a.b` double, js string, blank string")
    frame.write.parquet(str(tmp_path / "p"))
    profile = profiling.sketch_profile(spark.read.parquet(str(tmp_path / "p")), top=2)
    got = {r["column_name"]: r for r in profile.collect()}
    assert set(got) == {"id", "kind", "a.b", "js", "blank"}  # not the one that is null throughout
    assert got["kind"]["n_distinct"] == 3 and got["kind"]["types"] == ["TEXT"]
    assert {(t["item"], t["count"]) for t in got["kind"]["top"]} <= {("t0", 1667), ("t1", 1667), ("t2", 1666)}
    assert abs(got["id"]["n_distinct"] - 5000) < 250 and (got["id"]["smallest"], got["id"]["largest"]) == ("0", "999")
    assert got["js"]["types"] == ["ARRAY", "OBJECT"] and got["js"]["top"][0]["count"] == 3750
    assert got["a.b"]["n_values"] == 2500 and got["blank"]["smallest"] == ""
    again = profiling.sketch_profile(spark.read.parquet(str(tmp_path / "p")))
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert profiling.sketch_profile(frame.limit(0)).count() == 0
