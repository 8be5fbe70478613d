"""Edit scripts of versions, stall phases of streams, splittable JSON arrays,
against plain models."""

import datetime as dt
import json
import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from talkmill.functions import alignment
from talkmill.operators import versions
from talkmill.plans import files
from talkmill.sources import readers
from talkmill.streaming import follow


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def rebuilt(kinds, places, old, new):
    """(old, new) as the script tells them; kept items must be equal."""
    before, after = [], []
    for kind, place in zip(kinds, places):
        if kind == alignment.REMOVED:
            before.append(old[place])
        else:
            after.append(new[place])
            if kind == alignment.KEPT:
                before.append(new[place])
    return before, after


@pytest.mark.parametrize("seed", range(40))
def test_scripts_rebuild_both_sides(seed):
    rng = random.Random(seed)
    letters = rng.choice([2, 5, 1000])
    old = [rng.randrange(letters) for _ in range(rng.randrange(60))]
    new = list(old) if seed % 3 else [rng.randrange(letters) for _ in range(rng.randrange(60))]
    for _ in range(rng.randrange(8)):
        at = rng.randrange(len(new) + 1)
        new[at : at + rng.randrange(3)] = rng.sample(range(letters), min(letters, rng.randrange(3)))
    kinds, places = alignment.edit_steps(np.array(old, np.int64), np.array(new, np.int64))
    assert rebuilt(kinds, places, old, new) == (old, new)
    if len(set(old)) == len(old) and len(set(new)) == len(new):
        assert kinds.count(alignment.KEPT) == common_length(old, new)
    pairs = alignment._between(np.array(old, np.int64), np.array(new, np.int64), 0, 0)
    assert len(pairs) == common_length(old, new)


def test_moved_and_doubled_sentences(spark):
    texts = {
        "a": ["One. Two. Three.", "Two. Three.One. ", "Two. Two. Three.One. "],
        "b": ["Same! Same! End", None, "", "New? "],
        "c": ["Alone."],
    }
    rows = [(k, n, t, 1) for k, said in texts.items() for n, t in enumerate(said)]
    frame = spark.createDataFrame(rows, "id string, version int, content string, position int")
    script = versions.edit_script(frame, "id", ["version"], "content").collect()
    got = {}
    for r in sorted(script, key=lambda r: (r["id"], r["version"], r["position"])):
        got.setdefault((r["id"], r["version"]), []).append((r["kind"], r["sentence"]))
    assert got == {
        ("a", 1): [("removed", "One. "), ("kept", "Two. "), ("kept", "Three."), ("inserted", "One. ")],
        ("a", 2): [("kept", "Two. "), ("inserted", "Two. "), ("kept", "Three."), ("kept", "One. ")],
        ("b", 1): [("removed", "Same! "), ("removed", "Same! "), ("removed", "End")],
        ("b", 3): [("inserted", "New? ")],
    }
    changes = {(r["id"], r["version"]): (sorted(r["added"]), sorted(r["removed"]), r["version_no"]) for r in versions.sentence_changes(frame, "id", ["version"], "content").collect()}
    assert changes[("a", 0)] == (["One. ", "Three.", "Two. "], [], 1)
    assert changes[("a", 2)] == ([], [], 3) and changes[("b", 1)] == ([], ["End", "Same! "], 2)
    assert changes[("b", 3)] == (["New? "], [], 4) and len(changes) == len(rows)


def test_texts_stay_out_of_staged_tables(spark, monkeypatch):
    staged = []
    real = versions.stage
    for module in ("talkmill.operators.versions", "talkmill.operators.ordered", "talkmill.session"):
        monkeypatch.setattr(f"{module}.stage", lambda df, label: staged.append(df.columns) or real(df, label))
    frame = spark.createDataFrame([("a", 1, "One. Two."), ("a", 2, "One.")], "id string, version int, content string")
    versions.edit_script(frame, "id", ["version"], "content").count()
    versions.sentence_changes(frame, "id", ["version"], "content").count()
    assert staged and all("content" not in columns for columns in staged)


def test_latest_by_packed_and_plain_orders(spark):
    rng = random.Random(4)
    start = dt.datetime(1960, 1, 1)
    ties = [-(2**63) + 1, -1, 0, 2**63 - 1]
    rows = [(k, start + dt.timedelta(days=rng.randrange(40_000)), rng.choice(ties), rng.random(), f"{k}-{n}") for k in range(20) for n in range(30)]
    # Many equal times, a null time, and a key with null times only.
    rows += [(k, start + dt.timedelta(days=50_000), tie, 0.5, f"{k}-t{n}") for k in range(0, 20, 2) for n, tie in enumerate(ties)]
    rows += [(3, None, 5, 2.0, "3-null"), (99, None, 5, 0.1, "99-5"), (99, None, 7, 0.2, "99-7")]
    rows = list({(r[0], r[1], r[2]): r for r in rows}.values())
    frame = spark.createDataFrame(rows, "id int, ts timestamp, tie bigint, x double, name string")

    def best(order):
        return sorted(max((r for r in rows if r[0] == k), key=order)[4] for k in {r[0] for r in rows})

    def latest(order):
        found = versions.latest(frame, "id", order)
        assert found.columns == frame.columns
        return sorted(r["name"] for r in found.collect())

    assert latest(["ts", "tie"]) == best(lambda r: (r[1] is not None, r[1] or start, r[2]))
    assert latest(["x", "name"]) == best(lambda r: (r[3], r[4]))


def model_of_phases(events, interval, watermark):
    """Polls one after the other."""
    out = []
    for key in {k for k, _, _ in events}:
        polls = {}
        for k, ts, kind in events:
            if k == key and ts // interval * interval + interval <= watermark:
                polls.setdefault(ts // interval * interval, set()).add(kind)
        run = None
        last_poll = max(polls, default=0) + 200 * interval
        poll = min(polls, default=last_poll)
        while poll < last_poll:
            kinds = polls.get(poll, set())
            if run is None and kinds:
                run = {"begun": poll, "last": None, "quiet": 0, "n": 0, "done": False}
            if run is not None:
                run["done"] |= "done" in kinds
                run["quiet"] = 0 if "work" in kinds else run["quiet"] + 1
                if "work" in kinds:
                    run["last"], run["n"] = poll, run["n"] + 1
                if run["quiet"] >= follow.stall_polls(run["last"] is not None, run["done"]):
                    if poll + interval < watermark or kinds:
                        phase = "completed" if run["done"] else "running" if run["last"] is not None else "not started"
                        out.append((key, phase, run["begun"], run["last"], poll + interval, run["n"]))
                    run = None
            poll += interval
    return sorted(out, key=repr)


def phase_rows(frame):
    seconds = [F.unix_seconds(c).alias(c) for c in ("begun", "last_activity", "stalled_at")]
    return sorted((tuple(r) for r in frame.select("job", "phase", *seconds, "active_polls").collect()), key=repr)


def write_events(spark, path, events):
    rows = [(k, dt.datetime.fromtimestamp(ts, dt.timezone.utc), kind) for k, ts, kind in events]
    spark.createDataFrame(rows, "job string, ts timestamp, kind string").coalesce(1).write.mode("append").parquet(path)


def phases(spark, path):
    stream = spark.readStream.schema("job string, ts timestamp, kind string").parquet(path)
    return follow.stall_phases(stream, "job", F.col("kind") == "work", F.col("kind") == "done", 15, "60 seconds")


def test_stall_phases_and_restart(spark, tmp_path):
    rng = random.Random(7)
    events = []
    for k in range(12):
        at = 1_700_000_000 + k
        for _ in range(40):
            at += rng.choice([5, 20, 100, 200, 400, 1500])
            events.append((f"j{k}", at, rng.choices(["work", "wait", "done"], [6, 3, 1])[0]))
    events.append(("quiet", 1_700_000_000, "wait"))
    # A hot job: many events in few polls.
    events += [("hot", 1_700_000_000 + n // 50, "work") for n in range(3000)]
    newest = max(ts for _, ts, _ in events)
    want = model_of_phases(events, 15, newest - 60)
    assert {p for _, p, *_ in want} == {"not started", "running", "completed"}

    path = str(tmp_path / "once")
    write_events(spark, path, events)
    assert phase_rows(follow.to_table(phases(spark, path), "phases")) == want

    # The same events in time order over three runs of the stream, each from
    # the checkpoint of the one before.
    path, out = str(tmp_path / "twice"), str(tmp_path / "out")
    events.sort(key=lambda e: e[1])
    for third in range(3):
        write_events(spark, path, events[third * len(events) // 3 : (third + 1) * len(events) // 3])
        writer = phases(spark, path).writeStream.outputMode("append").format("parquet").option("path", out)
        follow.run_available(writer, str(tmp_path / "checkpoint"))
    assert phase_rows(spark.read.parquet(out)) == want


NASTY = ["}", '"', "\\", "{", "[", "]", ",", "\n", "é", "\\\"}", "a", "😀", " "]


@pytest.fixture()
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "400"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_split_arrays(spark, tmp_path, small_blocks):
    rng = random.Random(3)
    schema = "id bigint, text string, nested struct<a: array<struct<b: string>>, c: string>, extra string"
    objects = [
        {"id": i, "text": "".join(rng.choices(NASTY, k=rng.randrange(25))), "nested": {"a": [{"b": rng.choice(NASTY)}] * rng.randrange(3), "c": "}{"}}
        for i in range(120)
    ]
    folder = tmp_path / "arrays"
    folder.mkdir()
    (folder / "big.json").write_text(json.dumps(objects[:80], indent=1, ensure_ascii=False))
    (folder / "flat.json").write_text(" \n" + json.dumps(objects[80:119]))
    (folder / "object.json").write_text(json.dumps(objects[119]))
    (folder / "empty.json").write_text("[]")
    (folder / "blank.json").write_text("  \n")
    pieces = readers._closing_pieces(spark, str(folder), "*.json")
    assert pieces.rdd.getNumPartitions() > 50
    got = readers.split_json_arrays(spark, str(folder), schema)
    want = readers.json_arrays(spark, str(folder), schema)

    def plain(frame):
        return sorted((r.asDict(recursive=True) for r in frame.collect()), key=lambda d: d["id"])

    assert plain(got) == plain(want.filter("id IS NOT NULL")) and got.count() == 120
    (folder / "odd.json").write_text('[1, "x}", {"id": 500}, null, {"id": "no number"}, [2, [{"id": 7}]], {"id": 501, "text": "t"}, 3 ]')
    odd = [r["id"] for r in readers.split_json_arrays(spark, str(folder), "id bigint", "odd.json").collect()]
    assert sorted(odd) == [500, 501]


def test_runs_are_followed_without_grouping_frames(monkeypatch):
    """A call per key must not build grouped frames: there are many keys."""
    state = SimpleNamespace(exists=False, getCurrentWatermarkMs=lambda: 10**9, update=lambda kept: None, setTimeoutTimestamp=lambda ms: None)
    frames = [pd.DataFrame({"poll": [0, 0, 15], "active": [True, False, False], "completed": [False, True, False]})]
    monkeypatch.setattr(pd.DataFrame, "groupby", None)
    names = ["job", "phase", "begun", "last", "at", "n"]
    out = list(follow._follow_runs(15, names)(("j",), iter(frames), state))
    assert [tuple(r) for r in pd.concat(out).itertuples(index=False)] == [("j", "completed", 0, 0, follow.stall_polls(True, True) * 15 + 15, 1)]


def test_long_arrays_come_in_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ARRAY_BYTES", 100)
    docs = [(i, "t]}" * 10, "x") for i in range(30)] + [(7, "again", None), (None, None, "y")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    files.long_arrays(frame, str(tmp_path / "a"))
    found = sorted((tmp_path / "a").rglob("*.txt"))
    assert len(found) > 5 and max(f.stat().st_size for f in found) < 700
    assert all(isinstance(json.loads(f.read_text()), list) for f in found)
    got = readers.split_json_arrays(spark, str(tmp_path / "a"), "doc_id bigint, text string, lang string", "*.txt")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, docs))
    files.long_arrays(frame.limit(0), str(tmp_path / "none"))
    assert readers.split_json_arrays(spark, str(tmp_path / "none"), "doc_id bigint", "*.txt").count() == 0
