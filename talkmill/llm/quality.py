"""Text quality by gradient-boosted trees over document statistics.

Statistics are counted from a batch's bytes, all texts at once.  The trees are
histogram trees of one depth: values are binned by quantiles, a level's best
splits are read from sums of gradients per node and bin.  A fitted model is
four arrays (split features and thresholds, leaf values, edges), and scoring
walks all trees of a block of texts level by level in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import arrow_bytes, by_bytes, ship_package, text_of
from talkmill.llm.hashing import IN_WORD, span_hashes, spans, table_of
from talkmill.llm.labelled import training_rows

SAMPLE = 20_000  # labelled documents that a model is fitted on, about
TREES = 80
DEPTH = 4
BINS = 32
RATE = 0.15
LIKELY = 0.3  # score from which a text is predicted to be good
BATCH = 2_000_000

_KINDS = (
    range(97, 123), range(65, 91), range(48, 58), range(128, 256), b" ", b"\n", b"\t\r\x0b\x0c", b".", b",", b"!?;:", b"'\"", b"()[]{}<>",
    b"|", b"#$%&*+=@^_~`/\\", b"-",
)
_KIND = np.zeros(256, np.int64)
for _k, _members in enumerate(_KINDS, 1):
    _KIND[list(_members)] = _k
_LINE = ~table_of(b"\n")


def _repeats(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: distinct values by all, and the commonest value's share."""
    distinct, most = np.ones(len(bounds) - 1), np.zeros(len(bounds) - 1)
    for i, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if high > low:
            own = np.sort(hashes[low:high])
            edges = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
            distinct[i] = (len(edges) - 1) / (high - low)
            most[i] = np.diff(edges).max() / (high - low)
    return distinct, most


def statistics(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of numbers for each text."""
    n, kinds = len(at) - 1, len(_KINDS) + 1
    size = np.diff(at)
    owner = np.repeat(np.arange(n), size)
    share = np.bincount(owner * kinds + _KIND[data], minlength=n * kinds).reshape(n, kinds) / np.maximum(size, 1)[:, None]
    starts, ends, words = spans(data, at, IN_WORD)
    word_owner, length = np.repeat(np.arange(n), words), ends - starts
    some = np.maximum(words, 1)
    per_word = lambda x: np.bincount(word_owner, x, minlength=n) / some
    mean = per_word(length)
    spread = np.sqrt(np.maximum(per_word(length.astype(float) ** 2) - mean**2, 0))
    hashes, bounds = span_hashes(data, starts, ends), np.concatenate([[0], np.cumsum(words)])
    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (word_owner[1:] == word_owner[:-1])
    distinct, common = _repeats(hashes, bounds)
    with np.errstate(over="ignore"):
        triples = hashes.copy()
        triples[:-1] += hashes[1:] * np.uint64(3)
        triples[:-2] += hashes[2:] * np.uint64(7)
    triple_distinct, _ = _repeats(triples, bounds)
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    stops = per_word(np.isin(last, list(b".!?")))
    signs = per_word(~np.isin(_KIND[last], [1, 2, 3, 4]))
    capital = per_word(_KIND[data[starts]] == 2) if len(starts) else np.zeros(n)
    line_starts, line_ends, lines = spans(data, at, _LINE)
    line_distinct, _ = _repeats(span_hashes(data, line_starts, line_ends), np.concatenate([[0], np.cumsum(lines)]))
    return np.column_stack([
        np.log1p(size), np.log1p(words), mean, spread, per_word(again), distinct, common, triple_distinct, stops, signs, capital,
        lines / some, line_distinct, words / np.maximum(lines, 1), per_word(length > 20), per_word(length < 3), share,
    ]).astype(np.float32)


@dataclass
class Forest:
    """Complete trees of one depth: for inner node i of tree t the feature
    ``feature[t, i]`` and ``threshold[t, i]``; its kids are 2i+1 and 2i+2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(int(np.log2(self.value.shape[1])) if self.value.size else 0):
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        leaves = self.value[trees, node - self.feature.shape[1]].sum(1) if self.value.size else 0.0
        return 1 / (1 + np.exp(-(self.base + leaves + np.zeros(len(x)))))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, ridge: float = 1.0) -> Forest:
    """Boosted trees for the logistic loss; without both classes a constant."""
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if len(y) == 0 or y.min() == y.max():
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)])
    feature, threshold, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    raw = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        slope, curve = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            best = np.full(n, 1e-6)
            for f in range(width):
                cell = node * BINS + binned[f]
                g = np.bincount(cell, slope, minlength=n * BINS).reshape(n, BINS).cumsum(1)
                h = np.bincount(cell, curve, minlength=n * BINS).reshape(n, BINS).cumsum(1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
                gain[(h < 1) | (all_h - h < 1)] = 0
                gain[:, len(edges[f]) :] = 0
                b = gain.argmax(1)
                better = gain[np.arange(n), b] > best
                best[better] = gain[np.arange(n), b][better]
                where = np.flatnonzero(better)
                feature[t, first + where], threshold[t, first + where] = f, edges[f][b[where]] if len(edges[f]) else np.inf
            right = x[np.arange(len(y)), feature[t, first + node]] > threshold[t, first + node]
            node = 2 * node + right
        g, h = np.bincount(node, slope, minlength=leaves), np.bincount(node, curve, minlength=leaves)
        value[t] = -rate * g / (h + ridge)
        raw += value[t, node]
    return Forest(feature, threshold.astype(np.float32), value, base)


def _statistics_of(batches):
    for batch in batches:
        data, at = arrow_bytes(batch.column("text"))
        for low, high in by_bytes(np.diff(at), BATCH):
            x = statistics(data[at[low] : at[high]], at[low : high + 1] - at[low])
            part = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("quality"), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "quality", "x"])


def learnable():
    """Ids whose labels may be learned: crc32 of the decimal id, mod 5, not 0."""
    return F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Forest:
    rows = training_rows(docs, labels, sample, label_columns=["quality"], learnable=learnable(), doc_id=doc_id, text=text)
    # About SAMPLE rows of some hundred bytes.
    got = rows.select("id", "quality", "text").mapInArrow(_statistics_of, "id long, quality int, x binary").orderBy("id", "x").toArrow()
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32)
    width = statistics(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1]
    return fit_forest(x.reshape(-1, width), got.column("quality").to_numpy().astype(np.float64))


def _scored(shared):
    def run(batches):
        for batch in batches:
            data, at = arrow_bytes(batch.column("text"))
            out = [np.zeros(0)]
            for low, high in by_bytes(np.diff(at), BATCH):
                x = statistics(data[at[low] : at[high]], at[low : high + 1] - at[low])
                out += [shared.value.score(x[k : k + 512]) for k in range(0, len(x), 512)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(out))], names=["doc_id", "score"])

    return run


def quality(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row.

    ``held_out``: the id's label was not for learning (null ids: false).  The
    score is made from the text alone; null counts as empty, and an empty text
    has a score as well.  Without labels of both classes every score is the
    share of good labels (0.5 without any).  Repeated rows are rows like
    others; an empty table gives an empty one.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id=doc_id, text=text, sample=sample))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    held = ~F.coalesce(learnable(), F.lit(True))
    scored = rows.mapInArrow(_scored(shared), "doc_id long, score double").withColumn("id", F.col("doc_id"))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= LIKELY).cast("int").alias("predicted"))
