"""The filter audit, heap-ordered clustering and circulant MinHash against
brute force, on small fixtures."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from talkmill.llm import circulant_minhash as cm
from talkmill.llm import filter_audit, heap_kmeans, term_matrix
from talkmill.llm import queries as corpus
from tests.compare import difference, duck_rows, spark_rows

WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, source string, part string, failed int, words array<int>, `a.b` string"
VOCABULARY = [f"w{k}" for k in range(500)]


def words(seed, n):
    return random.Random(seed).choices(VOCABULARY, k=n)


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, " ".join(words(i, 20 * i + 1)), f"s{i % 3}") for i in range(25)]
    rows += [(30, None, None), (31, "", "s1"), (32, " \t\n\x0b", ""), (33, "One # word", "s2"), (34, "AB" * 30 + " é", "s2"), (35, "x " * 400, "s0")]
    chain = words(99, 400)
    # A chain of near copies, exact copies with other case, a long text.
    rows += [(60 + k, " ".join(chain[: 400 - 20 * k]), "s0") for k in range(9)]
    rows += [(80 + k, " ".join(words(7, 141)), "s0") for k in range(5)] + [(90, " ".join(words(5, 40_000)), "s3"), (91, "y" * 30_000, "s3")]
    rows += [(3, " ".join(words(3, 61)), "s3"), (3, " ".join(chain[:390]), "s3"), (None, "no id here at all", "s1"), (None, "no id here at all", "s1")]
    return spark.createDataFrame([(*r, "clash", 1, [1], "dot") for r in rows], DOCS).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_matrix_shards(spark, documents):
    rows = documents.selectExpr("doc_id", "coalesce(text, '') AS text", "source AS kept")
    matrix, numbered = term_matrix.term_matrix(rows, shard_bytes=500)
    known = {r["number"]: r["word"] for r in numbered.collect()}
    texts = [r["text"] for r in rows.collect()]
    assert sorted(known) == list(range(len(known))) and set(known.values()) == {w for t in texts for w in re.findall(WORD, t)}
    found, shards = [], matrix.collect()
    for r in shards:
        indptr, columns = np.frombuffer(r["indptr"], np.int64), np.frombuffer(r["columns"], np.int64)
        counts = np.frombuffer(r["counts"], np.int32)
        assert len(indptr) == len(r["doc_id"]) + 1 == len(r["kept"]) + 1
        for i, doc in enumerate(r["doc_id"]):
            cells = slice(indptr[i], indptr[i + 1])
            found.append((doc, r["kept"][i], {known[c]: n for c, n in zip(columns[cells].tolist(), counts[cells].tolist())}))
    want = [(r["doc_id"], r["kept"], dict(collections.Counter(re.findall(WORD, r["text"])))) for r in rows.collect()]
    assert len(shards) > 5 and sorted(found, key=repr) == sorted(want, key=repr)
    odd = ["  a bb\x0ba\x1ca \u00a0 \x85 bb\r", "", "\t", "A a"]
    rows, words = term_matrix.words_of(pa.array(odd))
    want = [(i, w) for i, t in enumerate(odd) for w in re.findall(WORD, t)]
    assert list(zip(rows.tolist(), words.to_pylist())) == want


def brute_audit(rows, labels):
    first = {}
    for r in rows:
        if r["doc_id"] is not None:
            first[r["text"] or ""] = min(first.get(r["text"] or "", math.inf), r["doc_id"])
    fails = []
    for r in rows:
        t = r["text"] or ""
        w = re.findall(WORD, t)
        f = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": r["doc_id"] is not None and r["doc_id"] > first[t],
        }
        fails.append((r["source"] or "", labels.get(r["doc_id"], (0, 0)), f))
    out = {}
    shapley = collections.Counter()
    parts = sorted({p for p, _, _ in fails})
    for part in parts:
        own = [(said, f) for p, said, f in fails if p == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(s, f) for s, f in left if f[letter]]
                left = [(s, f) for s, f in left if not f[letter]]
                all_failing = sum(f[letter] for _, f in own)
                unique = sum(f[letter] and sum(f.values()) == 1 for _, f in own)
                out[part, "".join(order), step] = [
                    len(left), len(gone), all_failing - len(gone), unique, sum(s[0] for s, _ in gone), sum(s[1] for s, _ in gone),
                ]
                shapley[part, letter] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark, documents, nothing):
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 90, 2)] + [(4, None, None), (4, 1, 0), (None, 1, 1), (999, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    said = collections.defaultdict(lambda: (0, 0))
    for i, q, t in labels:
        said[i] = (max(said[i][0], q or 0), max(said[i][1], t or 0))
    said.pop(None)
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in filter_audit.audit(documents, frame).collect()}
    assert got == brute_audit(documents.collect(), dict(said))
    assert filter_audit.audit(nothing, frame).count() == 0
    assert filter_audit.audit(documents, frame.limit(0)).where("good_lost > 0 or toxic_lost > 0").count() == 0


def brute_clusters(rows, components=64, clusters=16, rounds=3):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(64 * x) for x in v]))

    def start(r):
        return (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])

    centroids = [v for _, v in sorted(kept, key=start)[:clusters]]

    def nearest():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        own = collections.defaultdict(list)
        for (_, v), (c, _) in zip(kept, nearest()):
            own[c].append(v)
        centroids = [[sum(x) // len(own[c]) for x in zip(*own[c])] if own[c] else old for c, old in enumerate(centroids)]
    return [(vec_id, c, d) for (vec_id, _), (c, d) in zip(kept, nearest())], centroids


@pytest.mark.parametrize("scale", [1.0, 4e5])
def test_clusters(spark, scale):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=64) * scale + (i % 7)).tolist()) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 340)] + [(5, rows[7][1]), (5, rows[5][1]), (None, rows[8][1]), (None, rows[8][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [None] + [1.0] * 63), (904, [math.nan] + [1.0] * 63), (905, [math.inf] + [1.0] * 63)]
    frame = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<double>, cluster int, block int").repartition(4)
    want, centroids = brute_clusters(rows)
    blocks, found, scanned = heap_kmeans.fit(frame, block=64)
    assert found.tolist() == centroids and scanned[0] == len(want) and len(scanned) == 4
    got = heap_kmeans.cluster_report(frame, corpus._centroid_digest, block=64).collect()
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=repr) == sorted(want, key=repr)
    inertia = collections.Counter()
    for _, c, d in want:
        inertia[c] += d
    sums = {c: n if n < 2**63 else None for c, n in (*inertia.items(), ("all", sum(inertia.values())))}
    for r in got:
        text = ",".join(map(str, centroids[r["cluster"]]))
        assert (r["cluster_inertia"], r["inertia"]) == (sums[r["cluster"]], sums["all"])
        assert r["centroid_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_heaps_spare_most_scans(spark):
    """Well separated groups: later rounds pop few vectors or none."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=64) * 0.02 + np.eye(64)[i % 4] * 3).tolist()) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    _, _, scanned = heap_kmeans.fit(frame, clusters=4, rounds=5)
    want, _ = brute_clusters(rows, clusters=4, rounds=5)
    assert scanned[0] == 400 and scanned[-1] < 400
    assert sorted(tuple(r) for r in heap_kmeans.clustered(frame, clusters=4, rounds=5).collect()) == sorted(want)


def test_few_vectors(spark):
    frame = spark.createDataFrame([(1, [0.5] * 64), (2, [0.5] * 64)], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in heap_kmeans.clustered(frame).collect()) == [(1, 0, 0), (2, 0, 0)]
    assert heap_kmeans.cluster_report(frame.limit(0), corpus._centroid_digest).count() == 0
    one = heap_kmeans.clustered(frame.limit(1), clusters=1).collect()
    assert [(r["cluster"], r["distance"]) for r in one] == [(0, 0)]


def shingle_set(text, width):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def brute_components(rows, width=4, num=80):
    sets = [(r["doc_id"], shingle_set(r["text"], width)) for r in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, s), (b, t) in itertools.combinations([x for x in sets if x[0] is not None and x[1]], 2):
        if 100 * len(s & t) >= num * len(s | t):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return [(i, len(s), None if i is None else find(i) if s else i) for i, s in sets]


def test_near_copies(spark, documents, nothing):
    # Many that share a template but are no copies of each other, among copies.
    template = words(1234, 120)
    rng = random.Random(3)
    rows = [(200 + k, " ".join(template + words(5000 + k, 60)), "s") for k in range(40)]
    for k in range(40):
        text = list(template) + words(6000, 100)
        for _ in range(rng.randrange(6)):
            text[rng.randrange(len(text))] = "changed"
        rows.append((300 + k, " ".join(text).upper() if k % 2 else "  ".join(text), "s"))
    more = spark.createDataFrame([(*r, "clash", 1, [1], "dot") for r in rows], DOCS)
    whole = documents.unionByName(more)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in cm.near_copies(whole).collect()]
    assert sorted(got, key=repr) == sorted(brute_components(whole.collect()), key=repr)
    # In small blocks: bucket by bucket, and in parts.
    again = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in cm.near_copies(whole, block=400).collect()]
    assert sorted(again, key=repr) == sorted(got, key=repr)
    kept = cm.near_copies(documents).where("kept").collect()
    assert all(r["doc_id"] in (None, r["component_id"]) for r in kept)
    assert cm.near_copies(nothing).count() == 0


def test_signatures_are_minima_over_shifts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 5, 70_000)] + [np.zeros(0, np.uint64)]
    found = cm.signatures(sets)
    for s, row in zip(sets[:3], found):
        for k in (0, 1, 17, cm.COORDINATES - 1):
            assert row[k] == cm.order(cm.scatter(s) + np.uint32(k)).min()
    assert (found[3] == 2**32 - 1).all()
    sample = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(cm.order(sample))) == len(sample)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    pool = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
    a, b = pool[:1800], pool[200:2000]  # 1600 of 2000 in common
    one, two = cm.signatures([a, b])
    assert abs((one == two).mean() - 0.8) < 0.1
    apart = sum(int(x).bit_count() for x in (cm.sketches(one[None]) ^ cm.sketches(two[None])).view(np.uint64)[0])
    assert apart <= cm.most_different(80, 100) < cm.COORDINATES // 3


@pytest.mark.parametrize("name", ["op5_ngram_jaccard_join", "op11_filter_audit", "op12_centroid_clustering", "op13_minhash_dedup"])
def test_against_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    assert difference(spark_rows(corpus.QUERIES[name](spark, folder)), duck_rows(folder, corpus.ORACLES[name])) is None
