"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector for all grades, ordered thresholds.
A text is cut into parts of equal numbers of words. Features of a part are the words in it and the
beginnings of its longer words, hashed; each counts once. A text's score is the logarithm of the mean
of exp(w.x) over its parts, the parts' mean odds: a text that is toxic all through scores as one of its
parts does, however long it is, and the mean odds of clean parts don't grow with their number. It never
lies below the highest part's w.x less the logarithm of the number of parts, and that bound stands for
it in training. Labels say toxic or not; toxic texts of the training sample are graded 1 to 3 by the
number of the model's features in their fullest part (thirds of the toxic sample), clean ones are grade 0.

The model is fitted on the driver on a sample whose size is a parameter. Grading covers every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart.llm import words as W
from rental_mart.llm.worker import task

#: At most so many labelled texts of each class train the model, and so many features enter it.
SAMPLE, FEATURES = 4000, 8192
HASH_BITS = 22
LEAST_TEXTS = 5
GRADES = 3
BEGINNINGS = (4, 5, 6, 7)
#: Words of a part; the last one also has the words that are left over.
PART = 200
#: Only features that the sample ties to toxic texts enter, by the z value of their log odds: long
#: clean passages then don't outweigh what is toxic in a text. A feature that only ten toxic texts of a
#: rarer language have, and no clean one, has 3.6: at 4 such languages had no features.
LEAST_Z = 3.0
PENALTY, STEPS, RATE = 1.0, 400, 0.05
_GAPS = np.ones(256, bool)
_GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Model:
    index: np.ndarray  # feature numbers, sorted
    weight: np.ndarray
    thresholds: np.ndarray  # one for each step between grades, ascending


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of all words and beginnings of words, the part of each (numbered over all
    texts), and where each text's parts begin."""
    w = W.split(texts, _GAPS)
    total = W.string_totals(_LOWER[w.data], w.start)
    words = np.diff(w.first)
    parts = np.maximum(words // PART, 1)
    first = np.concatenate([[0], np.cumsum(parts)])
    text = np.repeat(np.arange(len(texts)), words)
    part = first[text] + np.minimum((np.arange(len(w.start)) - w.first[text]) // PART, parts[text] - 1)
    found, of = [W.string_hashes(total, w.start, w.end)], [part]
    for n in BEGINNINGS:
        longer = np.flatnonzero(w.end - w.start > n)
        found.append(W.string_hashes(total, w.start[longer], w.start[longer] + n))
        of.append(part[longer])
    number = (np.concatenate(found) >> np.uint64(64 - HASH_BITS)).astype(np.int32)
    return number, np.concatenate(of), first


def _distinct(number: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(of.astype(np.int64) << HASH_BITS | number)
    return (both & ((1 << HASH_BITS) - 1)).astype(np.int32), both >> HASH_BITS


def _sampled(documents: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, toxic, features by part) of the labelled sample, chosen by a hash of the id."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    pick = None
    for toxic in (True, False):
        some = known.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        pick = some if pick is None else pick.union(some)
    chosen = documents.select("doc_id", "text").join(F.broadcast(pick), "doc_id")  # 2 * sample rows at most
    chosen = chosen.dropDuplicates(["text", "toxic"])  # copies would tie all of their words to a class

    @task("toxicity")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                number, of, first = _features(part.column("text"))
                number, of = _distinct(number, of)
                lists = W.list_array(number, np.searchsorted(of, np.arange(first[-1] + 1)), pa.int32())
                parts = pa.ListArray.from_arrays(pa.array(first, pa.int32()), lists)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), parts], ["doc_id", "toxic", "features"])

    return chosen.mapInArrow(read, "doc_id bigint, toxic boolean, features array<array<int>>")


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Trains on at most ``sample`` labelled texts of each class; labels of a document that
    disagree count as toxic, null labels are left out. Without texts of both classes the model
    grades everything 0."""
    empty = Model(np.zeros(0, np.int32), np.zeros(0), np.arange(GRADES) + 20.0)
    # Kept in the executors' memory or on their disks; lost parts are read again.
    sampled = _sampled(documents, labels, sample).persist()
    try:
        sizes = {r["toxic"]: r["n"] for r in sampled.groupBy("toxic").agg(F.sum(F.size("features")).alias("n")).collect()}
        if len(sizes) < 2:
            return empty
        t, c = F.col("t") + 0.5, F.col("c") + 0.5
        odds = F.log(t / (sizes[True] + 1.0 - t)) - F.log(c / (sizes[False] + 1.0 - c))
        z = (odds / F.sqrt(1 / t + 1 / c)).alias("z")
        counted = sampled.select("toxic", F.explode("features").alias("part")).select("toxic", F.explode("part").alias("feature")).groupBy("feature").agg(
            F.sum(F.col("toxic").cast("int")).alias("t"), F.sum((~F.col("toxic")).cast("int")).alias("c"))
        best = counted.filter(F.col("t") + F.col("c") >= LEAST_TEXTS).select("feature", z).filter(F.col("z") >= LEAST_Z).orderBy(F.col("z").desc(), "feature").limit(FEATURES).collect()
        if not best:
            return empty
        index = np.array(sorted(r["feature"] for r in best), np.int32)
        rows = _only(sampled, index).orderBy("doc_id", "toxic").collect()
    finally:
        sampled.unpersist()
    place = [np.searchsorted(index, np.array(r["features"], np.int32)) for r in rows]
    toxic = np.array([r["toxic"] for r in rows])
    held = np.array([len(p) for p in place])
    grade = np.zeros(len(rows), np.int64)
    cuts = np.quantile(held[toxic], [k / GRADES for k in range(1, GRADES)])
    grade[toxic] = 1 + np.searchsorted(cuts, held[toxic], side="left")
    weight, thresholds = _fit(place, grade, len(index), np.log([r["parts"] for r in rows]))
    return Model(index, weight, thresholds)


def _only(sampled: DataFrame, index: np.ndarray) -> DataFrame:
    """The model's features in the fullest part of each text, and the number of its parts."""
    def best(parts: list[list[int]]) -> list[int]:
        held = (x[np.isin(x, index)] for x in (np.array(p, np.int32) for p in parts))
        return max(held, key=len).tolist()

    @task("toxicity")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("features").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array([len(x) for x in texts], pa.int64()), pa.array([best(x) for x in texts], pa.list_(pa.int32()))],
                ["doc_id", "toxic", "parts", "features"],
            )

    return sampled.mapInArrow(read, "doc_id bigint, toxic boolean, parts bigint, features array<int>")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def _mean_odds(score: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text the logarithm of the mean of exp(score) over its parts (at least one each)."""
    if len(first) == 1:
        return np.zeros(0)
    parts = np.diff(first)
    highest = np.maximum.reduceat(score, first[:-1])
    return highest + np.log(np.add.reduceat(np.exp(score - np.repeat(highest, parts)), first[:-1]) / parts)


def _fit(place: list[np.ndarray], grade: np.ndarray, n: int, less: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by gradient steps (Adam) on the penalised likelihood; ``less``
    is taken off each text's score."""
    column = np.concatenate(place).astype(np.int64) if place else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(place)), [len(p) for p in place])
    # The first threshold and the logarithms of the steps between the others.
    theta = np.concatenate([np.zeros(n), [0.0], np.zeros(GRADES - 1)])
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        gaps = np.exp(theta[n + 1 :])
        cut = theta[n] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(row, theta[column], minlength=len(grade)) - less
        edge = np.concatenate([[-np.inf], cut, [np.inf]])
        upper, lower = _sigmoid(edge[grade + 1] - score), _sigmoid(edge[grade] - score)
        p = np.maximum(upper - lower, 1e-12)
        d_up, d_low = upper * (1 - upper) / p, lower * (1 - lower) / p
        by_score = (d_up - d_low) / len(grade)
        g = np.empty_like(theta)
        g[:n] = np.bincount(column, by_score[row], minlength=n) + PENALTY * theta[:n] / len(grade)
        by_cut = np.array([(d_low[grade == k + 1].sum() - d_up[grade == k].sum()) / len(grade) for k in range(GRADES)])
        g[n] = by_cut.sum()
        g[n + 1 :] = np.cumsum(by_cut[::-1])[::-1][1:] * gaps
        mean = 0.9 * mean + 0.1 * g
        spread = 0.999 * spread + 0.001 * g * g
        theta = theta - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
        theta[:n] = np.maximum(theta[:n], 0)  # no feature makes a text less toxic
    return theta[:n], theta[n] + np.concatenate([[0.0], np.cumsum(np.exp(theta[n + 1 :]))])


def grade(documents: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``severity`` (expected grade), ``grade`` (most probable) and ``toxic``
    (a grade above 0 is likelier than grade 0) of every row's whole text.

    A null or empty text has no features and is graded by the thresholds alone. Other columns are
    not read; repeated rows each give their row.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.index, model.weight, model.thresholds))
    out = T.StructType([
        *documents.select(*keep).schema.fields, T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType()), T.StructField("toxic", T.BooleanType()),
    ])

    @task("toxicity")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weight, thresholds = shared.value
        known = np.zeros(1 << HASH_BITS, bool)
        known[index] = True
        for batch in batches:
            for part in W.slices(batch, text_col):
                number, of, first = _features(part.column(text_col))
                mine = known[number]
                number, of = _distinct(number[mine], of[mine])
                by_part = np.bincount(of, weight[np.searchsorted(index, number)], minlength=first[-1])
                score = _mean_odds(by_part, first)
                below = _sigmoid(thresholds[None, :] - score[:, None])
                p = np.diff(np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(p @ np.arange(p.shape[1])), pa.array(p.argmax(1).astype(np.int32)), pa.array(below[:, 0] < 0.5)],
                    [*keep, "severity", "grade", "toxic"],
                )

    return documents.select(*dict.fromkeys((*keep, text_col))).mapInArrow(read, out)
