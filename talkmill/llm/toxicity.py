"""Toxicity by a chain of linear classifiers over hashed words.

Features are words (runs of letters, A-Z as a-z) and their first four and five
bytes, hashed into 2**20 cells.  The cells that set toxic documents apart are
chosen by counts over the labelled sample, made in Spark.  The categories are
predicted one after the other; each model sees the probabilities of the
categories before it.  For training, those come from models that did not see
the document (out of fold), as later ones will not have seen it either: a
fold's models, and the cells they look at, come from the other folds' counts.

Categories are what the labels say of a document: ``poor`` (quality 0), then
``toxic``.  The labels hold no finer kinds of toxicity.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import arrow_bytes, by_bytes, give_back, ship_package, stage, text_of
from talkmill.llm.hashing import IN_LETTERS, span_hashes, spans
from talkmill.llm.labelled import training_rows

SAMPLE = 8_000  # labelled documents that a model is fitted on, about
CELLS = 1 << 20
MARKERS = 256  # cells with a weight
FOLDS = 5
ROUNDS = 2_000  # of fitting, at most
CATEGORIES = ("poor", "toxic")
BATCH = 2_000_000


def _cells(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and cell of each word and of its beginnings, and words per text."""
    starts, ends, counts = spans(data, at, IN_LETTERS)
    owner = np.repeat(np.arange(len(counts)), counts)
    cells, owners = [], []
    for salt, width in enumerate((None, 4, 5)):
        kept = np.ones(len(starts), bool) if width is None else ends - starts > width
        s, e = starts[kept], ends[kept] if width is None else starts[kept] + width
        cells.append(((span_hashes(data, s, e) + np.uint64(salt)) >> np.uint64(7)).astype(np.int64) & (CELLS - 1))
        owners.append(owner[kept])
    return np.concatenate(owners), np.concatenate(cells), counts


def fold_of(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(8)).astype(np.int64) % FOLDS


def _cell_counts(batches):
    """How many toxic and other documents of each fold have a cell."""
    found = np.zeros((2 * FOLDS, CELLS), np.int32)
    for batch in batches:
        data, at = arrow_bytes(batch.column("text"))
        kind = batch.column("toxic").to_numpy() * FOLDS + fold_of(batch.column("id").to_numpy())
        for low, high in by_bytes(np.diff(at), BATCH):
            owner, cells, _ = _cells(data[at[low] : at[high]], at[low : high + 1] - at[low])
            pairs = np.unique(owner * CELLS + cells)
            kinds = kind[low:high][pairs // CELLS]
            for y in np.unique(kinds).tolist():
                found[y] += np.bincount(pairs[kinds == y] % CELLS, minlength=CELLS).astype(np.int32)
    for y in range(2 * FOLDS):
        some = np.flatnonzero(found[y])
        columns = (some, found[y][some].astype(np.int64), np.full(len(some), y % FOLDS), np.full(len(some), y // FOLDS))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "n", "fold", "toxic"])
    found = None
    give_back()


def _hits(table: np.ndarray, n: int):
    """How often a text has each marker, and its number of words."""

    def of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner, cells, words = _cells(data, at)
        marker = table[cells]
        some = marker >= 0
        hits = np.bincount(owner[some] * n + marker[some], minlength=(len(at) - 1) * n).reshape(-1, n)
        return np.minimum(hits, 65535).astype(np.uint16), words

    return of


def features(hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which markers a text has, how many different ones, their share of all
    words."""
    has = (hits > 0).astype(np.float32)
    share = hits.sum(1) / np.maximum(words, 1)
    return np.concatenate([has, np.log1p(has.sum(1))[:, None], np.log1p(100 * share)[:, None]], axis=1).astype(np.float32)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic model, the constant last: accelerated gradient
    steps until the mean gradient is small, ``ROUNDS`` at most."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    step = 4 / ((x**2).sum(1).mean() * 1.0 + 4 * ridge / max(len(x), 1)) / max(len(x), 1)
    w, ahead = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for k in range(ROUNDS):
        slope = x.T @ (_logistic(x @ ahead) - y) + ridge * np.r_[ahead[:-1], 0]
        if np.abs(slope).max() <= 1e-4 * max(len(x), 1):
            return ahead
        new = ahead - step * slope
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


@dataclass
class Chain:
    """Linear models of the categories in order over markers (``table``: the
    marker of a cell, or -1); ``threshold`` is for the last."""

    table: np.ndarray
    weights: list[np.ndarray]
    threshold: float

    def predict(self, hits: np.ndarray, words: np.ndarray) -> np.ndarray:
        return chain_probabilities(self.weights, features(hits, words))


def chain_probabilities(weights: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """A column per category; each model sees those before it."""
    out: list[np.ndarray] = []
    for w in weights:
        out.append(_logistic(np.concatenate([x, *(p[:, None] for p in out)], axis=1) @ w[:-1] + w[-1]))
    return np.stack(out, axis=1)


def fit_weights(x: np.ndarray, targets: list[np.ndarray], unseen: np.ndarray) -> list[np.ndarray]:
    """Models in chain order; ``unseen`` has the out-of-fold probabilities of
    the categories, which a later model is fitted on."""
    return [fit_linear(np.concatenate([x, unseen[:, :k]], axis=1), y) for k, y in enumerate(targets)]


def out_of_fold(features_of: Callable[[int], np.ndarray], targets: list[np.ndarray], fold: np.ndarray) -> np.ndarray:
    """Probabilities of every row and category by models of the other folds;
    ``features_of`` gives all rows' features by a fold's own markers."""
    unseen = np.zeros((len(fold), len(targets)), np.float32)
    for k, y in enumerate(targets):
        for f in range(FOLDS):
            seen = fold != f
            if seen.any() and not seen.all():
                x = np.concatenate([features_of(f), unseen[:, :k]], axis=1)
                w = fit_linear(x[seen], y[seen])
                unseen[~seen, k] = _logistic(x[~seen] @ w[:-1] + w[-1])
    return unseen


def _best_threshold(score: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap at which F1 is highest."""
    order = np.argsort(-score, kind="stable")
    s, hit = score[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(np.argmax(f1))
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k] / 2)


def _markers(counts: DataFrame, sizes: dict[tuple[int, int], int], left_out: int | None) -> list[int]:
    """Cells of toxic documents, by how far their share is beyond chance, as
    the folds other than ``left_out`` have them."""
    clean, toxic = (float(sum(n for (y, f), n in sizes.items() if y == kind and f != left_out)) for kind in (0, 1))
    own = counts if left_out is None else counts.where(F.col("fold") != left_out)
    sums = own.groupBy("cell").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    lift = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    strong = sums.where(F.col("t") >= 2).withColumn("lift", lift).where("lift > 1")
    top = strong.orderBy(F.desc(F.col("lift") * F.sqrt("t")), "cell").limit(MARKERS)
    return [r["cell"] for r in top.select("cell").collect()]


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Chain | None:
    """A chain from labels (``doc_id, quality, toxic``; an unknown quality is
    not poor); None if they hold one class of ``toxic`` only."""
    ship_package(docs.sparkSession)
    known = labels.withColumn("quality", F.coalesce(F.col("quality").cast("int"), F.lit(1)))
    rows = stage(training_rows(docs, known, sample, label_columns=["toxic", "quality"], doc_id=doc_id, text=text), "training")
    counted = stage(rows.select("id", "text", "toxic").mapInArrow(_cell_counts, "cell long, n long, fold long, toxic long").groupBy("cell", "fold", "toxic").agg(F.sum("n").alias("n")), "cells")
    ids = rows.select("id", "toxic").toArrow()  # about SAMPLE rows
    fold, y = fold_of(ids.column("id").to_numpy()), ids.column("toxic").to_numpy()
    sizes = {(k, f): int(((y == k) & (fold == f)).sum()) for k in (0, 1) for f in range(FOLDS)}
    if not (y == 1).any() or not (y == 0).any():
        return None
    # The markers of the whole sample first, then those of each fold's others.
    chosen = [_markers(counted, sizes, f) or [0] for f in (None, *range(FOLDS))]
    cells = list(dict.fromkeys(c for own in chosen for c in own))
    place = {c: k for k, c in enumerate(cells)}
    table = np.full(CELLS, -1, np.int16)
    table[cells] = np.arange(len(cells))
    counts = _hits(table, len(cells))

    def matrix(batches):
        for batch in batches:
            data, at = arrow_bytes(batch.column("text"))
            for low, high in by_bytes(np.diff(at), BATCH):
                hits, words = counts(data[at[low] : at[high]], at[low : high + 1] - at[low])
                part = batch.slice(low, high - low)
                kept = [part.column(c) for c in ("id", "toxic", "quality")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([r.tobytes() for r in hits], pa.binary()), pa.array(words.astype(np.int64))], names=["id", "toxic", "quality", "hits", "words"])

    # About SAMPLE rows of at most three kilobytes.
    got = rows.select("id", "toxic", "quality", "text").mapInArrow(matrix, "id long, toxic int, quality int, hits binary, words long").orderBy("id").toArrow()
    hits = np.frombuffer(b"".join(got.column("hits").to_pylist()), np.uint16).reshape(len(got), len(cells))
    words = got.column("words").to_numpy()

    def of_markers(own: list[int]) -> np.ndarray:
        return features(hits[:, [place[c] for c in own]], words)

    poor = (got.column("quality").to_numpy() == 0).astype(np.float32)
    y = (got.column("toxic").to_numpy() == 1).astype(np.float32)
    unseen = out_of_fold(lambda f: of_markers(chosen[f + 1]), [poor, y], fold_of(got.column("id").to_numpy()))
    own = np.full(CELLS, -1, np.int16)
    own[chosen[0]] = np.arange(len(chosen[0]))
    chain = Chain(own, fit_weights(of_markers(chosen[0]), [poor, y], unseen), _best_threshold(unseen[:, -1], y))
    del got, hits, table, rows, ids
    give_back()
    return chain


CATEGORIES_P = tuple(f"p_{c}" for c in CATEGORIES)
_SCORED = ", ".join(f"{c} double" for c in CATEGORIES_P) + ", rejected boolean"


def _probabilities(chain: Chain, text: pa.Array) -> np.ndarray:
    counts = _hits(chain.table, int(chain.table.max()) + 1)
    data, at = arrow_bytes(text)
    out = [np.zeros((0, len(CATEGORIES)))]
    for low, high in by_bytes(np.diff(at), BATCH):
        out.append(chain.predict(*counts(data[at[low] : at[high]], at[low : high + 1] - at[low])))
    return np.concatenate(out)


def _scored(shared):
    def run(batches):
        for batch in batches:
            p = _probabilities(shared.value, batch.column("text")).astype(np.float64)
            columns = [pa.array(np.ascontiguousarray(p[:, k])) for k in range(p.shape[1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(p[:, -1] >= shared.value.threshold)], names=["doc_id", *CATEGORIES_P, "rejected"]
            )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``doc_id, p_poor, p_toxic, rejected`` for each row.

    A null or empty text is scored like one without words.  Null ids and
    repeated rows are rows like others.  Without labels of both classes
    nothing is rejected and every probability is 0.  An empty table gives an
    empty one.
    """
    chain = fit(docs, labels, doc_id=doc_id, text=text, sample=sample)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    if chain is None:
        return rows.select("doc_id", *(F.lit(0.0).alias(c) for c in CATEGORIES_P), F.lit(False).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    return rows.mapInArrow(_scored(shared), "doc_id long, " + _SCORED)


def without_toxic(docs: DataFrame, labels: DataFrame, **named) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    chain = fit(docs, labels, **named)
    if chain is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def passes(text: pa.Array) -> pa.Array:
        return pa.array(_probabilities(shared.value, text)[:, -1] < shared.value.threshold)

    passes.__annotations__ = {"text": pa.Array, "return": pa.Array}
    judge = F.arrow_udf(passes, "boolean")
    return docs.where(judge(text_of(named.get("text", "text"))))
