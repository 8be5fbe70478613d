"""Odd inputs of the corpus operators: clashing names, repeated ids, broken
pages, mixed layouts; and parts of them against plain models."""

import collections
import gc
import hashlib
import json
import random
import time
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talkmill.llm import byte_bpe, chat_format, cuckoo, html_text, kmeans_tree, labelled, mixing, ngram_join, queries, toxicity, trie
from talkmill.llm import common

CLASHES = ["gone", "_gone", "fate", "Sha", "chars", "place", "_row", "again", "shard", "own_id", "digest", "a.b"]


@pytest.fixture(scope="module")
def clashing(spark):
    words = [f"w{k}" for k in range(300)]
    pick = random.Random(1)
    texts = [" ".join(pick.choices(words, k=60)) for _ in range(6)]
    rows = [(i, texts[i % 6] + (" tail" if i == 7 else ""), f"s{i % 2}", *(["x"] * len(CLASHES))) for i in range(12)]
    # One id with rows that stay and rows that go.
    rows += [(0, texts[1] + " longer  ", "s0", *(["y"] * len(CLASHES))), (None, "alone", None, *(["z"] * len(CLASHES)))]
    return spark.createDataFrame(rows, ["doc_id", "text", "source", *CLASHES])


def test_stages_keep_columns_of_any_name(clashing):
    for kept in (cuckoo.without_copies(clashing), ngram_join.one_of_each(clashing), mixing.mixed(clashing)):
        assert kept.columns == clashing.columns
        rows = kept.collect()
        assert rows and {tuple(r) for r in rows} <= {tuple(r) for r in clashing.collect()}
    texts = [(r["text"] or "").replace(" ", "") for r in cuckoo.without_copies(clashing).collect()]
    assert len(texts) == len(set(texts)) == len({(r["text"] or "").replace(" ", "") for r in clashing.collect()})
    assert common.unused(["A", "_a", "b"], "a", "b", "c") == ["__a", "_b", "c"]


def test_index_outgrows_its_buckets(spark, monkeypatch):
    monkeypatch.setattr(cuckoo, "KEYS_PER_BUCKET", 4)
    docs = spark.createDataFrame([(i, f"text {i // 2}") for i in range(120)], "doc_id long, text string")
    rows = cuckoo.digests_of(docs)
    small = cuckoo.CuckooIndex.empty(spark, 8)
    index = small.insert(rows.where("doc_id < 10")).insert(rows.where("doc_id >= 10"))
    assert small.buckets == 2 and index.buckets >= 60 / 4
    assert sorted((r["doc_id"], r["copies"]) for r in index.keys().collect()) == [(i, 2) for i in range(0, 120, 2)]
    again = index.insert(rows)
    assert again.keys().agg(F.sum("copies")).first()[0] == 240 and again.keys().count() == 60
    assert index.delete(rows.where("doc_id < 60")).keys().count() == 30


PAGES = {
    "<a href=/o'neil>Link</a><p>two words</p><p>don't stop</p><p>end</p>": "Link two words don't stop end",
    '<p title="a>Hello</p>': "Hello",
    "<p title='a>b' data-x=\"c>d\">Hello</p>": "Hello",
    "<div role='main'><p>in</p></div><p>out</p>": "in",
    "<div role=main><p>in</p></div><p>out</p>": "in",
    "<p>a</p><xmp>if <b> &amp;</xmp><p>z</p>": "a if <b> &amp; z",
    "<p/>one<br/>two<img src=x>three": "one two three",
    "<article><p>One</p><div class='social-history'>Two</div></article>": "One Two",
    "<div class='layout has-sidebar'><article>One</article></div>": "One",
    "<article>" + "word " * 100 + "<div class='press-share'>" + "said " * 100 + "</div></article>": "word " * 100 + "said " * 99 + "said",
}
BOXES = (
    "article-comments reader-comments user-comments fb-comments disqus_thread article-share article-ad sticky-ad video-ad adsbygoogle "
    "cookie-policy-banner author-newsletter-box articleComments"
).split()


def read(page):
    found = html_text.segments(page).texts
    return " ".join(t for t, _, _ in ([s for s in found if s[1]] or found))


def test_pages_as_html_reads_them():
    assert {p: read(f"<body>{p}</body>") for p in PAGES} == PAGES
    for name in BOXES:
        for mark in (f'class="{name}"', f"id={name}", f"class='x {name}'"):
            page = f"<body><article><p>One two three</p><div {mark}><p>gone text</p></div><p>four</p></article></body>"
            assert read(page) == "One two three four", mark


def test_open_tags_take_linear_time():
    begun = time.perf_counter()
    read_page = html_text.segments("<div><p>x</p>" * 75_000)  # a megabyte
    assert len(read_page.texts) == 75_000 and time.perf_counter() - begun < 8
    left = html_text.left_texts(["x"] * 75_000, [i for _, _, i in read_page.texts], read_page.above, read_page.numbers, {read_page.numbers[40_000]})
    assert len(left) == 20_000  # a link for each div and each p


def test_templates_by_brute_force(spark):
    """Boxes on many pages of a host go, whatever holds them; counted anew here."""
    pick = random.Random(5)
    boxes = [f"<div>box {k}</div>" for k in range(6)]
    pages, boxed = [], {}
    for host in ("a.org", "b.org"):
        for k in range(20):
            own = sorted(pick.sample(range(6), pick.randrange(4)))
            boxed[host, k] = own
            body = f"<p>Page {k} of {host}</p>" + "".join(boxes[b] for b in own)
            pages.append((len(pages), f"http://{host}/{k}", f"<body><section><section>{body}</section></section></body>"))
    counts = collections.Counter((host, b) for (host, _), own in boxed.items() for b in own)
    gone = {(h, b) for (h, b), n in counts.items() if n >= html_text.LEAST_PAGES and n >= html_text.LEAST_SHARE * 20}
    got = {r["url"]: r["text"] for r in html_text.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert gone
    for (host, k), own in boxed.items():
        want = [f"Page {k} of {host}", *(f"box {b}" for b in own if (host, b) not in gone)]
        assert got[f"http://{host}/{k}"] == " ".join(want)


def test_layouts_record_by_record(spark):
    records = [
        {"conv_id": 1, "messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]},
        {"conv_id": 2, "prompt": "p", "completion": "c"},
        {"conv_id": 3, "instruction": "i", "input": "", "output": "o", "more": {"x": [1, None]}},
        {"conv_id": 4, "conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
        {"conv_id": 5, "messages": []},
        {"conv_id": 6, "turn": 3, "role": "user", "text": "t"},
        {"text": "u", "role": "bot", "turn": 0, "conv_id": 7},
    ]
    frame = spark.createDataFrame([(json.dumps(r), "x") for r in records] + [(None, "y")], "record string, conv_id string")
    got = sorted(map(tuple, chat_format.canonical_records(frame, "record").collect()))
    assert got == [
        (1, 0, "user", "a"), (1, 1, "assistant", ""), (2, 0, "user", "p"), (2, 1, "assistant", "c"), (3, 0, "user", "i"), (3, 1, "assistant", "o"),
        (4, 0, "user", "h"), (4, 1, "assistant", "g"), (6, 3, "user", "t"), (7, 0, "bot", "u"),
    ]
    for bad in ('{"conv_id": 1, "other": 2}', "no json", "[1]"):
        with pytest.raises(ValueError, match="layout"):
            chat_format.canonical_records(spark.createDataFrame([(bad,)], "record string"), "record")
    assert chat_format.canonical_records(frame.limit(0), "record").count() == 0


def test_ids_of_any_width(spark):
    rows = spark.createDataFrame([(1, 0, "user", "hi")], "conv_id int, turn smallint, role string, text string")
    assert [tuple(r) for r in chat_format.canonical_turns(rows).collect()] == [(1, 0, "user", "hi")]


def brute_nearest(vectors, every, k):
    chosen = {}
    for i, v in vectors:
        chosen[i] = min(chosen.get(i, v), v)
    out = []
    for q in sorted(i for i in chosen if i % every == 0):
        near = sorted((-sum(a * b for a, b in zip(chosen[q], v)), i) for i, v in chosen.items() if i != q)[:k]
        out += [(q, n, i) for n, (_, i) in enumerate(near, 1)]
    return out


def test_one_id_several_vectors_and_split_bins(spark, monkeypatch):
    random_ = np.random.default_rng(8)
    rows = [(i, [float(x) for x in np.round(random_.normal(size=4), 3)]) for i in range(400)]
    rows += [(20, [9.0, 0.0, 0.0, 0.0]), (40, rows[40][1]), (41, [0.5, 0.5, 0.5, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = brute_nearest(rows, 20, 5)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in kmeans_tree.nearest(frame, k=5, target=1.0).collect())
    assert got == want
    # Few queries to a task: bins with more visitors go to several.
    monkeypatch.setattr(kmeans_tree, "STREAM", 3)
    monkeypatch.setattr(kmeans_tree, "LEAST_BLOCK", 64)
    again = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in kmeans_tree.nearest(frame, k=5, target=1.0).collect())
    assert again == want


def test_vectors_move_once_whatever_the_queries(spark):
    points = spark.createDataFrame([(i, 0, i % 3, [1.0, float(i)]) for i in range(90)], "id long, leaf long, bin long, v array<double>")

    def rows_held(n):
        asked = [(1000 + q, b, [1.0, 0.0], [0], [0]) for q in range(n) for b in range(3)]
        visits = spark.createDataFrame(asked, "id long, bin long, v array<double>, leaves array<int>, steps array<int>")
        plan = kmeans_tree._search(points, visits, 2)
        assert plan.count() == 6 * n
        return plan._jdf.queryExecution().optimizedPlan().toString().count("Generate")

    assert rows_held(2) == rows_held(50) == 1


def test_training_sample_has_a_row_per_id(spark):
    docs = spark.createDataFrame([(1, "b")] * 50 + [(1, "a"), (2, "c"), (2, None), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (None, 1)], "doc_id long, toxic int")
    rows = labelled.training_rows(docs, labels, 100, label_columns=["toxic"]).collect()
    assert sorted((r["id"], r["text"], r["toxic"]) for r in rows) == [(1, "a", 1), (2, "", 0)]


def test_chain_feeds_earlier_categories_to_later_ones():
    random_ = np.random.default_rng(3)
    x = random_.normal(size=(400, 3)).astype(np.float32)
    first = (x[:, 0] + 0.3 * random_.normal(size=400) > 0).astype(np.float32)
    second = ((first + 0.2 * random_.normal(size=400) > 0.5) & (x[:, 1] > -1)).astype(np.float32)
    fold = np.arange(400) % toxicity.FOLDS
    unseen = toxicity.out_of_fold(lambda f: x, [first, second], fold)
    # No row's own labels are in its out-of-fold probabilities.
    for row in (0, 17):
        flipped = [y.copy() for y in (first, second)]
        for y in flipped:
            y[row] = 1 - y[row]
        assert np.allclose(toxicity.out_of_fold(lambda f: x, flipped, fold)[row, 0], unseen[row, 0])
    weights = toxicity.fit_weights(x, [first, second], unseen)
    assert [len(w) for w in weights] == [4, 5]
    got = toxicity.chain_probabilities(weights, x)
    one = 1 / (1 + np.exp(-(x @ weights[0][:3] + weights[0][3])))
    two = 1 / (1 + np.exp(-(np.c_[x, one] @ weights[1][:4] + weights[1][4])))
    assert np.allclose(got, np.c_[one, two], atol=1e-6)
    assert ((got[:, 1] > 0.5) == second).mean() > 0.85


def test_fitting_reaches_the_optimum():
    random_ = np.random.default_rng(1)
    x, y = random_.normal(size=(300, 4)), (random_.random(300) > 0.5).astype(float)
    w = toxicity.fit_linear(x, y)
    full = np.c_[x, np.ones(300)]
    slope = full.T @ (1 / (1 + np.exp(-full @ w)) - y) + np.r_[w[:-1], 0]
    assert np.abs(slope).max() <= 1e-4 * 300


def brute_linked(ids, sets, num, den):
    root = dict(zip(ids, ids))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            s, t = set(sets[a].tolist()), set(sets[b].tolist())
            if den * len(s & t) >= num * len(s | t):
                low, high = sorted((find(ids[a]), find(ids[b])))
                root[high] = low
    return sorted((i, find(i)) for i in ids)


@pytest.mark.parametrize("seed", range(30))
def test_trie_against_brute_force(seed):
    pick = random.Random(seed)
    bases = [pick.sample(range(200), pick.randrange(1, 40)) for _ in range(4)]
    sets = []
    for _ in range(pick.randrange(1, 40)):
        own = list(pick.choice(bases))
        for _ in range(pick.randrange(5)):
            own.append(pick.randrange(200)) if not own or pick.random() < 0.5 else own.pop(pick.randrange(len(own)))
        sets.append(np.unique(np.array(own or [1], np.uint64)))
    ids = pick.sample(range(10_000), len(sets))
    num = pick.choice([50, 75, 80, 100])
    assert sorted(trie.linked(ids, sets, num, 100)) == brute_linked(ids, sets, num, 100)


def test_trie_of_unlinked_sets_is_quick():
    random_ = np.random.default_rng(0)
    sets = [np.unique(np.r_[np.array([1, 2], np.uint64), random_.integers(10, 2**62, 60).astype(np.uint64)]) for _ in range(2000)]
    begun = time.perf_counter()
    assert len(trie.linked(list(range(2000)), sets, 75, 100)) == 2000
    assert time.perf_counter() - begun < 10


def test_support_answers_are_packed_per_batch(spark):
    """One row per batch and bucket comes back, not one per document."""
    docs = spark.createDataFrame([(i, " ".join(f"w{(i // 2) * 7 + k}" for k in range(30))) for i in range(400)], "id long, text string").repartition(4)
    sent = docs.mapInArrow(ngram_join._pack_support(5, 3), ngram_join.SENT)
    answers = sent.groupBy("bucket").applyInArrow(ngram_join._count_support, ngram_join.ANSWER)
    assert answers.where("places is not null").count() <= sent.count()
    facts = {r["id"]: r for r in answers.groupBy("batch").applyInArrow(ngram_join._sum_support, ngram_join.FACTS).collect()}
    sets = {r["id"]: {tuple(r["text"].split()[k : k + 5]) for k in range(26)} for r in docs.collect()}
    held = collections.Counter(g for s in sets.values() for g in s)
    assert {i: r["support"] for i, r in facts.items()} == {i: sum(held[g] > 1 for g in s) for i, s in sets.items()}
    assert all(r["n"] == len(sets[i]) for i, r in facts.items())


def test_decoding_concatenates_bytes(spark):
    ranks = {bytes([k]): k for k in range(256)} | {b"\xff\x00": 256, "é".encode(): 257}
    rows = spark.createDataFrame([([256, 257, 0, 255],), ([],), (None,), ([999],)], "ids array<int>")
    got = [r[0] for r in rows.select(byte_bpe.decoded(F.col("ids"), ranks)).collect()]
    assert got == [b"\xff\x00\xc3\xa9\x00\xff", b"", None, None]


def test_plans_of_the_fold_do_not_hold_the_ranks(spark, monkeypatch):
    """The driver makes and keeps a plan's text, with all literals, several times."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    sizes, stage = [], byte_bpe.stage

    def seen(df, label):
        sizes.append(len(df._jdf.queryExecution().toString()))
        return stage(df, label)

    monkeypatch.setattr(byte_bpe, "stage", seen)
    rows = spark.createDataFrame([("one two two three",), ("one two the three",)], "text string")
    found = byte_bpe.stretch_table(rows, ranks, public_tokenizers.PATTERN)
    sizes.append(len(found._jdf.queryExecution().toString()))
    got = {r["stretch"]: list(r["ids"]) for r in found.collect()}
    assert got == {w: byte_bpe.merged(w.encode(), ranks) for w in ("one", " two", " three")}
    assert len(sizes) >= 4 and max(sizes) < 50_000


def test_commonest_stretches_by_a_cut(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN", 10)
    counts = [(f"s{k}", n) for k, n in enumerate([500, 400, 300, 90, 80, 5, 5, 5, 5, 5, 5, 1, 1])]
    rows = spark.createDataFrame(counts + [("s0", 3)], "stretch string, n long")
    found = {r[0] for r in byte_bpe._commonest(rows).collect()}
    assert {"s0", "s1", "s2", "s3", "s4"} == found
    assert byte_bpe._commonest(rows.limit(0)).count() == 0


def test_remembered_words_stay_within_bytes(monkeypatch):
    monkeypatch.setattr(byte_bpe, "RARE", 1000)
    ranks = {bytes([k]): k for k in range(256)}
    memory = byte_bpe.Remembered()
    for k in range(50):
        word = f"word{k}".encode()
        assert np.frombuffer(memory.find(word, ranks), np.int32).tolist() == list(word)
    assert 0 < len(memory.ids) <= 4 and memory.size <= 1000


def test_byte_bpe_sends_few_texts_at_once(spark, monkeypatch):
    """Executors hold each batch several times, also where the session allows large ones."""

    def sizes_instead_of_ids(pattern, shared):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "ids": pa.array([[len(b)]] * len(b), pa.list_(pa.int32()))})

        return run

    def stretches(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"stretch": [f"rows {len(b)}"] * 2, "n": [1, 1]})

    monkeypatch.setattr(byte_bpe, "_encode", sizes_instead_of_ids)
    monkeypatch.setattr(byte_bpe, "_count_stretches", stretches)
    counted, commonest = [], byte_bpe._commonest
    monkeypatch.setattr(byte_bpe, "_commonest", lambda df: counted.extend(df.collect()) or commonest(df))
    rows = spark.range(3000).selectExpr("id as doc_id", "'a text' as text").coalesce(1)
    sizes = {hashlib.sha256(str(k).encode()).hexdigest(): k for k in range(1, 3001)}
    before = spark.conf.get(common.ARROW_ROWS)
    try:
        for given, most in (("10000", common.BATCH_ROWS), ("0", common.BATCH_ROWS), ("100", 100)):
            spark.conf.set(common.ARROW_ROWS, given)
            counted.clear()
            found = queries.bpe_digests(rows).collect()
            assert sorted(r["doc_id"] for r in found) == list(range(3000))
            assert max(sizes[r["ids_sha256"]] for r in found) == most
            assert max(int(r["stretch"].split()[1]) for r in counted) == most
            assert spark.conf.get(common.ARROW_ROWS) == given
        with pytest.raises(ValueError), common.small_batches(spark):
            raise ValueError
        assert spark.conf.get(common.ARROW_ROWS) == given
    finally:
        spark.conf.set(common.ARROW_ROWS, before)


def test_byte_bpe_tasks_leave_no_words_behind():
    """A worker outlives its tasks: what one remembers must end with it."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known, ids = pa.array(["zz"], pa.large_string()), pa.array([[1]], pa.list_(pa.int32()))
    rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some rare words", None]})
    run = byte_bpe._encode(public_tokenizers.PATTERN, SimpleNamespace(value=(known, ids, ranks)))
    assert [len(r["ids"]) > 0 for out in run(iter([rows])) for r in out.to_pylist()] == [True, False]
    gc.collect()
    assert not [x for x in gc.get_objects() if isinstance(x, byte_bpe.Remembered)]
