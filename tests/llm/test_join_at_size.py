"""The n-gram join on large groups of near copies."""

from __future__ import annotations

import os
import random
import time
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talkmill import session
from talkmill.llm import common, components, ngram_join, trie
from tests.llm.test_handling import brute_linked


def near_copies(count, length=300, rate=0.06, seed=1):
    """Sets of a text's 5-grams, of which each copy has up to ``rate`` of the words changed."""
    random_ = np.random.default_rng(seed)
    base, sets = random_.integers(0, 2**60, length), []
    for _ in range(count):
        words = base.copy()
        other = random_.random(length) < random_.uniform(0, rate)
        words[other] = random_.integers(0, 2**60, other.sum())
        words = words.astype(np.uint64)
        sets.append(np.unique(sum(words[k : length - 4 + k] * np.uint64(2 * k + 3) for k in range(5))))
    return sets


def test_a_large_group_of_near_copies_is_quick():
    """About half of them are similar to none; a walk of its own for each set took over a minute."""
    sets = near_copies(2400)
    begun = time.perf_counter()
    found = dict(trie.linked(list(range(2400)), sets, 75, 100))
    assert time.perf_counter() - begun < 15
    assert 1 < len(set(found.values())) < 2400
    some = [k for k in range(0, 2400, 40)]
    for i, root in brute_linked(some, [sets[k] for k in some], 75, 100):
        assert found[i] == found[root]


@pytest.mark.parametrize("seed", range(20))
def test_pages_of_any_size(monkeypatch, seed):
    pick = random.Random(seed)
    for name, sizes in {"LEAF": [1, 2, 5, 512], "LEAF_TOKENS": [1, 60, 1 << 18], "FAN": [2, 3, 16], "SLICE": [3, 2048], "EXPANDED": [5, 1 << 21]}.items():
        monkeypatch.setattr(trie, name, pick.choice(sizes))
    bases = [pick.sample(range(200), pick.randrange(1, 40)) for _ in range(4)]
    sets = []
    for _ in range(pick.randrange(1, 60)):
        own = list(pick.choice(bases))
        for _ in range(pick.randrange(6)):
            own.append(pick.randrange(200)) if not own or pick.random() < 0.5 else own.pop(pick.randrange(len(own)))
        sets.append(np.unique(np.array(own or [1], np.uint64)))
    ids, num = pick.sample(range(10_000), len(sets)), pick.choice([50, 75, 80, 100])
    assert sorted(trie.linked(ids, sets, num, 100)) == brute_linked(ids, sets, num, 100)


def alike(spark, groups=5, each=60, length=300):
    """Texts of which each has near copies: two words in 300 differ."""
    pick = random.Random(3)
    rows = []
    for g in range(groups):
        base = [f"w{pick.randrange(10**6)}" for _ in range(length)]
        for k in range(each):
            words = list(base)
            for _ in range(2):
                words[pick.randrange(length)] = f"x{pick.randrange(10**6)}"
            rows.append((g * each + k, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_tables_stay_small_where_all_have_near_copies(spark, monkeypatch):
    """Stored sets, twice, took several times the texts' bytes."""
    docs, sizes = alike(spark), []
    texts = docs.agg(F.sum(F.length("text"))).first()[0]
    stage = session.stage

    def seen(df, label):
        out = stage(df, label)
        sizes.append(sum(os.path.getsize(urlparse(f).path) for f in out.inputFiles() if label != "links"))
        return out

    for module in (session, common, components, ngram_join):
        monkeypatch.setattr(module, "stage", seen)
    found = ngram_join.similar_documents(docs).collect()
    assert {r["component_id"] for r in found} == {0, 60, 120, 180, 240} and len(found) == 300
    assert all(r["component_id"] == r["doc_id"] // 60 * 60 and r["n_shingles"] > 290 for r in found)
    assert sum(sizes) < texts / 2


def test_hashes_are_sent_in_few_bytes_whatever_the_buckets(spark):
    """With more buckets than a document has n-grams, each brought its holder and a run's length."""
    docs = alike(spark, groups=180, each=1).select(F.col("doc_id").alias("id"), "text").coalesce(1)
    for buckets in (3, 500):
        sent = docs.mapInArrow(ngram_join._pack_support(5, buckets), ngram_join.SENT)
        lengths = [F.sum(F.coalesce(F.octet_length(c), F.lit(0))) for c, kind in sent.where("grams is not null").dtypes if kind == "binary"]
        bytes_, hashes = sent.where("grams is not null").agg(sum(lengths[1:], lengths[0]), F.sum(F.octet_length("grams") / 4)).first()
        assert hashes > 10_000 and bytes_ / hashes < 6


def test_common_ngrams_come_with_the_support(spark):
    docs = spark.createDataFrame([(i, f"a b c d e f{i} g{i} h{i}") for i in range(40)], "id long, text string").repartition(4)
    rows = docs.mapInArrow(ngram_join._pack_support(5, 3), ngram_join.SENT).groupBy("bucket").applyInArrow(ngram_join._counting(10), ngram_join.ANSWER)
    facts = rows.groupBy("batch").applyInArrow(ngram_join._sum_support, ngram_join.FACTS).collect()
    (common_,) = [r for r in facts if r["n"] is None]
    (gram,) = [g for _, (s,) in ngram_join._sets(one_text("a b c d e"), 5) for g in s]
    assert common_["c1"] == ngram_join._codes(np.array([gram]), 3).view(np.int64)[0] and common_["support"] >= 8
    assert sorted(r["id"] for r in facts if r["n"] is not None) == list(range(40)) and all(r["support"] == 1 for r in facts if r["n"] is not None)


def one_text(text):
    return pa.RecordBatch.from_pydict({"id": pa.array([0], pa.int64()), "text": [text]})


@pytest.mark.parametrize("top", [1, 200, 255, 256, 65_536, 2**32, 2**63])
def test_small_numbers(top):
    numbers = np.array([0, 3, top, 1], np.uint64)
    data = ngram_join._small(numbers)
    assert len(data) // 4 == next(k for k in (1, 2, 4, 8) if top < 256**k)
    assert ngram_join._from_small(data, 4).tolist() == numbers.tolist()
    assert ngram_join._from_small(ngram_join._small(numbers[:0]), 0).tolist() == []


def test_owners_of_any_distance():
    owners = np.array([-(2**63), 2**63 - 1, 0, 5, -7], np.int64)
    grams = np.full(5, 77, np.uint64)
    rows = pa.Table.from_batches([ngram_join._spread(grams, owners, 4)])
    pairs = ngram_join._share_prefix(rows).to_pylist()
    assert sorted((r["a"], r["b"]) for r in pairs) == [(o, -(2**63)) for o in sorted(owners.tolist())[1:]]
