"""Operators of the corpus package against brute force, on small fixtures."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from talkmill.llm import byte_bpe, chat_format, cuckoo, html_text, kmeans_tree, mixing, ngram_join, quality, token_counts, toxicity
from talkmill.session import stage
from tests.compare import difference, duck_rows, spark_rows

WORDS = "the of and to in is it you that he was for on are with as his they at be this have from".split()
DOCS = "doc_id long, text string, source string, id string, row int, digest string, n long"


def text_of(seed, n):
    return " ".join(random.Random(seed).choices([w + str(k) for w in WORDS for k in range(40)], k=n))


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, text_of(i, 40 + i), f"s{i % 4}") for i in range(30)]
    rows += [(40, None, None), (41, "", "s1"), (42, " \t\n", "s1"), (43, "Three short Words", "s2"), (44, "three  short\nwords", "s2")]
    # A chain of near copies, exact copies, and a long text.
    chain = text_of(99, 200).split()
    for k in range(8):
        rows.append((60 + k, " ".join(chain[: 200 - 12 * k]), "s0"))
    rows += [(80 + k, text_of(7, 47), "s0") for k in range(5)] + [(90, text_of(5, 30_000), "s3"), (91, "x" * 20_000, "s3")]
    rows += [(3, text_of(3, 43), "s3"), (None, "no id here at all today", "s1"), (None, "no id here at all today", "s1")]
    return spark.createDataFrame([(*r, "clash", 1, "clash", 5) for r in rows], DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_chat_layouts_and_digests(spark):
    said = "</s>[INST] ok [/INST]"
    flat = [(1, 0, "user", said), (1, 1, "assistant", "<\\/s> <\\\\|im_end|> <s<s>[[INST]"), (1, 2, "assistant", None), (2, 0, "odd\n\\n<s>", "x<"), (2, 1, None, "/s>"), (None, None, "assistant", "é\n")]
    frames = [
        spark.createDataFrame(flat, chat_format.TURN).withColumn("extra", F.lit(1)),
        spark.createDataFrame([(5, [("human", "hi"), ("gpt", said)])], "conv_id long, conversations array<struct<`from`:string,value:string>>"),
        spark.createDataFrame([(6, "do", None, "done"), (7, "do", "this", "so")], "conv_id long, instruction string, input string, output string"),
        spark.createDataFrame([(8, [])], "conv_id long, messages array<struct<role:string,content:string>>"),
    ]
    turns = flat + [(5, 0, "user", "hi"), (5, 1, "assistant", said), (6, 0, "user", "do"), (6, 1, "assistant", "done"), (7, 0, "user", "do\n\nthis"), (7, 1, "assistant", "so")]
    formatted = chat_format.format_conversations(*frames)
    for control in chat_format.Template().control:
        inner = F.expr("substring(formatted, 13, length(formatted) - 23)")
        assert formatted.where(F.contains(inner, F.lit(control))).count() == 0
    want = collections.defaultdict(list)
    for conv, _, role, text in turns:
        want[conv].append((role or "", text or ""))
    got = {r["conv_id"]: r for r in chat_format.read_back(formatted).collect()}
    assert set(got) == set(want)
    for conv, said_turns in want.items():
        trained = "".join(t for r, t in said_turns if r == "assistant")
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said_turns).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(trained.encode()).hexdigest()
        assert (got[conv]["n_turns"], got[conv]["loss_chars"]) == (len(said_turns), len(trained))
    with pytest.raises(ValueError):
        chat_format.canonical_turns(spark.range(3))


def test_token_counts(spark, documents, nothing, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = ["a <|endoftext|> b<|startoftext|>c", "É é ́x  İ I'LL", "日本 12 🙂", "a   b\n\n c", " x  y"]
    rows = documents.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(odd, 1000)), "doc_id long, text string"))
    got = [(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(rows, path).collect()]
    want = []
    for r in rows.collect():
        text = r["text"] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False))
        want.append((r["doc_id"], len(text.encode()), n, n > 2048))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(nothing, path).count() == 0
    data = np.frombuffer(("ab " * 50 + "c" * 40 + " d").encode(), np.uint8)
    parts = list(token_counts.split_at_blanks(data, np.array([0, len(data)]), 16))
    assert b"".join(p.tobytes() for p, _, _ in parts) == data.tobytes() and all(p[-1] == 32 for p, _, _ in parts[:-1])


def brute_copies(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        plain = re.sub(r"[\x20\x09-\x0D]+", "", r["text"] or "")
        groups[plain].append(r)
    return groups


def test_exact_copies(documents, nothing):
    groups = brute_copies(documents.collect())
    got = cuckoo.exact_copies(documents).collect()
    assert len(got) == documents.count() and sum(r["kept"] for r in got) == len(groups)
    sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        group = sha[r["text_sha256"]]
        best = min(group, key=lambda d: (-len(d["text"] or ""), d["doc_id"] is None, d["doc_id"] or 0))
        assert (r["keep_id"], r["group_size"]) == (best["doc_id"], len(group))
    left = cuckoo.without_copies(documents)
    assert left.columns == documents.columns and sorted(len(v) for v in brute_copies(left.collect()).values()) == [1] * len(groups)
    assert cuckoo.exact_copies(nothing).count() == 0 and cuckoo.without_copies(nothing).count() == 0


def test_cuckoo_filter_and_index(spark, documents):
    random_ = random.Random(4)
    bucket, digests = cuckoo.Bucket(), [random_.randbytes(32) for _ in range(5000)]
    for d in digests:
        bucket.put(d, 1, 1, (0, False, 0, 0))
    assert bucket.filter.mask > 63 and all(d in bucket.filter for d in digests)  # it has grown
    for d in digests[:2500]:
        bucket.take(d)
    assert all(d in bucket.filter for d in digests[2500:]) and set(bucket.keys) == set(digests[2500:])
    assert sum(d in bucket.filter for d in digests[:2500]) < 50
    # Two texts with one fingerprint and one pair of cells stay two.
    a, b = digests[0], digests[0][:8] + digests[1][8:]
    for d in (a, b, a):
        bucket.put(d, 1, 1, (0, False, 0, 0))
    assert bucket.keys[a][1] == 2 and bucket.keys[b][1] == 1

    rows = cuckoo.digests_of(documents)
    index = cuckoo.CuckooIndex.empty(spark, 10).insert(rows)
    again = index.insert(rows)
    assert again.keys().agg(F.sum("copies")).first()[0] == 2 * rows.count() and again.keys().count() == index.keys().count()
    gone = index.keys().orderBy("digest").limit(5)
    assert index.delete(gone).keys().join(gone, "digest").count() == 0
    assert index.delete(gone).insert(rows.join(gone.select("digest"), "digest", "left_semi")).keys().count() == index.keys().count()


def test_byte_bpe(spark, documents, nothing, monkeypatch):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pick = random.Random(1)
    odd = ["a   b\n\n c\t\td  ", " lead", "trail ", "日本語 12345 🙂🙂", "\x1c \x1d a", "<|endoftext|> don't", "a  b 　c"]
    odd += ["".join(pick.choices(" \n\t 　ab1!'é日", k=pick.randint(0, 30))) for _ in range(300)]
    rows = documents.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(odd, 1000)), "doc_id long, text string"))
    for known in (1 << 17, 20):  # with the table, and nearly without
        monkeypatch.setattr(byte_bpe, "KNOWN", known)
        found = byte_bpe.encode(rows, ranks, public_tokenizers.PATTERN).withColumn("back", byte_bpe.decoded(F.col("ids"), ranks)).collect()
        got = collections.Counter((r["doc_id"], tuple(r["ids"]), bytes(r["back"])) for r in found)
        texts = [(r["doc_id"], r["text"] or "") for r in rows.collect()]
        assert got == collections.Counter((i, tuple(theirs.encode_ordinary(t)), t.encode()) for i, t in texts)
    table = byte_bpe.stretch_table(rows.select("text"), ranks, public_tokenizers.PATTERN).collect()
    assert table and all(list(r["ids"]) == theirs.encode_ordinary(r["stretch"]) for r in table)
    assert byte_bpe.encode(nothing, ranks, public_tokenizers.PATTERN).count() == 0


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else ({tuple(words)} if words else set())


@pytest.mark.parametrize("block", [ngram_join.BLOCK, 300])
def test_ngram_join(documents, nothing, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    sets = [(r["doc_id"], shingle_set(r["text"])) for r in documents.collect()]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    named = [(i, s) for i, s in sets if i is not None and s]
    for k, (i, a) in enumerate(named):
        for j, b in named[:k]:
            if 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    want = sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)
    assert sorted((tuple(r) for r in ngram_join.similar_documents(documents).collect()), key=repr) == want
    if block == 300:
        left = ngram_join.one_of_each(documents)
        assert sorted(r["doc_id"] for r in left.where("doc_id is not null").collect()) == sorted(i for i, _ in sets if i is not None and find(i) == i)
        assert ngram_join.similar_documents(nothing).count() == 0 and ngram_join.one_of_each(nothing).count() == 0


def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    capped, total = set(), 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in capped]
        each = (total - sum(2 * sizes[s] for s in capped)) / max(1, sum(w[s] for s in open_))
        over = {s for s in open_ if each * w[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else each * w[s] for s in names}
        capped |= over


def test_mixing(documents, nothing):
    rows, drawn = mixing.mixing_plan(documents, shard_words=2000)
    plan = rows.collect()
    sizes = collections.Counter()
    for r in documents.collect():
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    want = brute_targets(sizes)
    taken = collections.Counter()
    assert len(plan) == documents.count()
    for r in plan:
        assert r["copies"] <= 2 and r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["copies"] * r["size"]
    for s in ("s0", "s1", "s2"):
        assert abs(taken[s] - want[s]) <= 0.1 * want[s] + 3
    copies = drawn.collect()
    assert len(copies) == sum(r["copies"] for r in plan) == len({(r["doc_id"], r["again"], r["pass"]) for r in copies})
    again, drawn_again = mixing.mixing_plan(documents.repartition(5), shard_words=2000)
    assert sorted(map(tuple, drawn_again.collect()), key=repr) == sorted(map(tuple, copies), key=repr)
    out = mixing.mixed(documents, shard_words=2000)
    assert out.columns == documents.columns and out.count() == len(copies)
    assert mixing.mixed(nothing).count() == 0
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", [17, 18, 19])
def test_mixing_meets_targets_beside_a_long_document(spark, seed):
    """One document of a third of its source's words, first, last or midway in the order."""
    rows = [(s * 1000 + i, "w " * (5 if i else 1000), f"s{s}") for s in range(4) for i in range(401)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan, drawn = mixing.mixing_plan(docs, seed=seed, weights=(1,), share=0.5)
    taken = collections.Counter()
    plan = plan.collect()
    for r in plan:
        taken[r["source"]] += r["copies"] * r["size"]
    assert all(abs(taken[f"s{s}"] - 1500) <= 5 for s in range(4)), taken
    assert drawn.count() == sum(r["copies"] for r in plan)


def test_splitting_tree_is_exact(spark):
    root = spark.createDataFrame([(0, [40, 0, 7, 17])], "node long, counts array<long>")
    leaves = mixing.splitting_tree(root, 3, seed=1).collect()
    assert len(leaves) == 8 and [sum(r["counts"][k] for r in leaves) for k in range(4)] == [40, 0, 7, 17]
    assert {sum(r["counts"]) for r in leaves} == {8} and len({tuple(r["counts"]) for r in leaves}) > 1


def test_main_text(spark):
    page = (
        "<html><head><title>t</title></head><body><header class=site>H</header><nav>n</nav><div class='cookie-notice'>c</div><main><article>"
        "<header><h1>Title &amp; &eacute;&nbsp;x</h1></header><p>One<b>two</b> three<br>four<p>five<ul><li>a<li>b</ul><form>f</form>"
        "<script>if(a<b){}</script><section class='comments'>no</section></article></main><aside>s</aside><footer>f"
    )
    rows = [(1, "http://a.org/1", page), (2, None, None), (3, "x", ""), (3, "x", "plain < text &am")]
    # A box without any mark that recurs on a host, and one that does not.
    rows += [(10 + k, f"https://b.org/{k}", f"<body><div><i>Our site, since 1999</i></div><div>Page {k}</div></body>") for k in range(8)]
    got = collections.Counter(map(tuple, html_text.main_text(spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, host string")).collect()))
    texts = ["Title & é x Onetwo three four five a b", "", "", "plain < text &am"] + [f"Page {k}" for k in range(8)]
    assert got == collections.Counter((i, u, t, len(t)) for (i, u, _), t in zip(rows, texts))
    assert html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def texts_of(spark, rows):
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r["page_id"]: r["text"] for r in got}


def test_copies_of_a_page_are_no_template(spark):
    box = "<body><div><p>{}</p></div></body>"
    rows = [(k, "http://a.org/1", box.format("Text")) for k in range(5)]
    # Variants of one address, with text that differs from call to call; no url at all.
    rows += [(10 + k, f"http://b.org/1?utm_source=x{k}#t{k}", f"<body><div><p>Body</p></div><p>Call {k}</p></body>") for k in range(6)]
    rows += [(20 + k, None, box.format("Unknown")) for k in range(6)]
    # A template beside many copies of one of its pages.
    rows += [(30 + k, f"http://c.org/{k}", f"<body><div>Since 1999</div><p>Page {k}</p></body>") for k in range(6)]
    rows += [(40 + k, "http://c.org/0", "<body><div>Since 1999</div><p>Page 0</p></body>") for k in range(20)]
    want = {k: "Text" for k in range(5)} | {10 + k: f"Body Call {k}" for k in range(6)} | {20 + k: "Unknown" for k in range(6)}
    want |= {30 + k: f"Page {k}" for k in range(6)} | {40 + k: "Page 0" for k in range(20)}
    assert texts_of(spark, rows) == want
    assert html_text.address_of("https://A.org/p?utm_source=f&page=2&gclid=1#top") == "A.org/p?page=2"
    assert html_text.address_of("//a.org/p#!/x") == "a.org/p#!/x" and html_text.address_of(None) is None


def test_class_words_do_not_take_the_article(spark):
    article = "<article><p>One</p></article>"
    pages = {
        f"<div class='layout has-sidebar'><nav>n</nav>{article}</div>": "One",
        f"<div class='no-sidebar'>{article}</div>": "One",
        f"<div id=related-work>{article}</div>": "One",
        f"<div class=widget>{article}<div class=sidebar>s</div></div>": "One",
        "<div class='sidebar right'><main><p>One</p></main></div>": "One",
        "<div class=overlay><p>Most of the text of this page</p></div><p>little</p>": "Most of the text of this page little",
        "<article><p class=notice>One</p><section class=promotion>two</section><p id=share>three</p><p class='code comment'>four</p></article>": "One two three four",
        "<article>One <span class=comment>two</span> <span class='ad'>x</span>three</article>": "One two three",
        # Furniture all the same.
        f"<nav class=x>{article}</nav><p>Two</p>": "Two",
        f"<div class=cookie-notice>long text of a notice, longer than all else</div>{article}": "One",
        f"{article}<div class=comments><article class=comment-body>c</article><article>d, much longer than the text</article></div>": "One",
        f"<main>{article}<div class='post-comments'><article>c, longer</article></div><div class=share-buttons>s</div></main>": "One",
        f"{article}<div class=sidebar><article>teaser</article></div><div class='ad-300x250'>x</div>": "One",
        "<p>Post</p><div id=comments><article>a</article><article>b</article></div>": "Post",
        "<div class=ad>x</div>": "",
        "<article>One<section class=comments>c</section><div class=share>s</div><ul class=related>r</ul></article>": "One",
    }
    rows = [(k, f"http://h{k}.org/", f"<body>{p}</body>") for k, p in enumerate(pages)]
    got = texts_of(spark, rows)
    assert {p: got[k] for k, p in enumerate(pages)} == pages


@pytest.fixture(scope="module")
def judged(spark):
    """Clean and toxic texts of invented words, good and poor ones."""
    pick, rows, labels = random.Random(3), [], []
    for i in range(600):
        words = text_of(i, pick.randint(20, 60)).split()
        toxic = i % 5 == 0
        for _ in range(4 if toxic else 0):
            words[pick.randrange(len(words))] = pick.choice(["gronk", "Blarg!", "snurfing"])
        poor = i % 3 == 0
        text = " | ".join(words) if poor else " ".join(words).capitalize() + "."
        rows.append((i, text))
        if i % 2:
            continue
        labels.append((i, int(not poor), int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "x")]
    labels += [(None, 1, 1), (4, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(judged, nothing):
    docs, labels = judged
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    assert {i for i, r in got.items() if r["rejected"]} == {i for i in range(600) if i % 5 == 0}
    left = toxicity.without_toxic(docs.withColumn("p_toxic", F.lit(1)), labels)
    assert left.count() == docs.count() - 120 and left.columns == ["doc_id", "text", "p_toxic"]
    assert toxicity.toxicity(docs, labels.limit(0)).where("rejected").count() == 0
    assert toxicity.toxicity(nothing, labels).count() == 0


def test_quality(judged, nothing):
    docs, labels = judged
    got = {r["doc_id"]: r for r in quality.quality(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    assert all(got[i]["predicted"] == int(i % 3 != 0) for i in range(600))
    assert quality.quality(nothing, labels).count() == 0 and quality.quality(docs, labels.limit(0)).agg(F.min("score")).first()[0] == 0.5


def test_forest_scores_as_its_trees_say():
    random_ = np.random.default_rng(0)
    x = random_.normal(size=(500, 4)).astype(np.float32)
    forest = quality.fit_forest(x, ((x[:, 0] > 0) & (x[:, 2] < 1)).astype(float), trees=5, depth=3)
    raw = np.full(500, forest.base)
    for t in range(5):
        for i in range(500):
            node = 0
            for _ in range(3):
                node = 2 * node + 1 + int(x[i, forest.feature[t, node]] > forest.threshold[t, node])
            raw[i] += forest.value[t, node - 7]
    assert np.allclose(forest.score(x), 1 / (1 + np.exp(-raw)))


def test_nearest(spark, nothing):
    random_ = np.random.default_rng(2)
    points = random_.normal(size=(1500, 8))
    points[700:900] = points[0]
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(points)]
    bad = [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] + [1.0] * 7), (2060, [None] + [1.0] * 7), (None, [1.0] * 8), (2080, [float("inf")] * 8)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    got = collections.defaultdict(dict)
    for r in kmeans_tree.nearest(frame).collect():
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(got) == list(range(0, 1500, 20))
    hits = 0
    for q, found in got.items():
        scores = points @ points[q]
        scores[q] = -np.inf
        assert sorted(found) == list(range(1, 21)) and all(s == pytest.approx(scores[i]) for i, s in found.values())
        order = np.lexsort((np.arange(1500), -np.round(scores, 9)))[:20]
        hits += len({i for i, _ in found.values()} & set(order.tolist()))
    assert hits >= 0.9 * 20 * len(got)
    few = kmeans_tree.nearest(frame.where("vec_id < 6")).collect()
    assert sorted((r["query_id"], r["rank"]) for r in few) == [(0, k) for k in range(1, 6)]
    assert kmeans_tree.nearest(frame.limit(0)).count() == 0


def test_layout_of_leaves():
    sizes = np.array([3, 0, 4, 25, 2, 9, 1])
    first, bins = kmeans_tree.layout(sizes, 10)
    assert bins.tolist() == [1, 0, 1, 3, 1, 1, 1]
    held = collections.Counter()
    for leaf, size in enumerate(sizes.tolist()):
        for i in range(size):
            held[int(first[leaf]) + i % max(1, int(bins[leaf]))] += 1
    assert max(held.values()) <= 10 and sum(held.values()) == sizes.sum()
    own = range(int(first[3]), int(first[3] + bins[3]))
    assert not any(int(first[leaf]) in own for leaf in (0, 2, 4, 5, 6))


def test_nearest_with_float_vectors_copies_and_repeated_rows(spark):
    random_ = np.random.default_rng(4)
    points = random_.normal(size=(300, 6)).astype(np.float32)
    points[100:200] = points[0]
    rows = [(i, [float(v) for v in p], "x") for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows + rows[::3], "vec_id long, embedding array<float>, rank string")
    got = collections.defaultdict(list)
    for r in sorted(kmeans_tree.nearest(frame, target=1.0).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append(r["vec_id"])
    exact = points.astype(np.float64)
    for q in range(0, 300, 20):
        scores = np.array([(exact[i] * exact[q]).sum() for i in range(300)])
        scores[q] = -np.inf
        assert got[q] == np.lexsort((np.arange(300), -scores))[:20].tolist()


def test_queries_with_sql(spark):
    from talkmill.llm.queries import ORACLES, QUERIES

    folder = "/root/testdata/sf0.001"
    for name, sql in ORACLES.items():
        assert difference(spark_rows(QUERIES[name](spark, folder)), duck_rows(folder, sql)) is None


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    kept = {r["doc_id"] for r in docs.collect()}
    assert got and {r["doc_id"] for r in got} <= kept
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all(r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest() for r in got)


def test_stages_of_the_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    frames, rows = [frame], [frame.collect()]
    for _, function in corpus_pipeline.STAGES:
        frame = stage(function(spark, frame, folder), "stages")
        frames.append(frame)
        rows.append(frame.collect())
    given, clean, single, apart, mix, coded = rows
    assert all(f.columns == frames[0].columns for f in frames[1:5])

    judged = toxicity.toxicity(frames[0], spark.read.parquet(f"{folder}/labels.parquet")).collect()
    rejected = {r["doc_id"] for r in judged if r["rejected"]}
    assert rejected and sorted(clean) == sorted(r for r in given if r["doc_id"] not in rejected)

    groups = brute_copies(clean).values()
    assert sorted(single) == sorted(min(g, key=lambda d: (-len(d["text"] or ""), d["doc_id"])) for g in groups)

    sets = sorted((r["doc_id"], shingle_set(r["text"])) for r in single)
    root = {i: i for i, _ in sets}
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((root[i], root[j]))
                root = {d: low if r == high else r for d, r in root.items()}
    assert len(apart) < len(single) and sorted(apart) == sorted(r for r in single if root[r["doc_id"]] == r["doc_id"])

    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in apart}
    sizes, taken = collections.Counter(), collections.Counter()
    for r in apart:
        sizes[r["source"]] += words[r["doc_id"]]
    copies = collections.Counter(r["doc_id"] for r in mix)
    assert set(mix) <= set(apart) and max(copies.values()) <= 2
    for r in mix:
        taken[r["source"]] += words[r["doc_id"]]
    want = brute_targets(sizes)
    for s, size in sizes.items():
        # No document left brings the source nearer, nor was the last one too many.
        whole, own = int(want[s] // size), [r["doc_id"] for r in apart if r["source"] == s and words[r["doc_id"]]]
        left, more = ([words[i] for i in own if copies[i] == n] for n in (whole, whole + 1))
        assert len(left) + len(more) == len(own)
        off, least = taken[s] - want[s], 1e-6 * want[s]
        assert -off <= min(left, default=0) / 2 + least and off <= max(more, default=0) / 2 + least

    text = {r["doc_id"]: r["text"] or "" for r in mix}
    assert collections.Counter(r["doc_id"] for r in coded) == copies
    assert all(r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest() for r in coded)
    assert collections.Counter(corpus_pipeline.run(spark, folder).collect()) == collections.Counter(coded)
