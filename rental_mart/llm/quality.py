"""Quality rules with thresholds that adapt to each language and source.

Counts come from whole texts. A quantile sketch of each rule's measure is kept for each language and
source: counts by logarithmic bin (relative error below 1 %), which merge by addition, so that Spark
combines them before the shuffle and a hot source costs no more than any other. A group's sketch is
mixed with that of its language, and a language's with that of all documents, as if so many documents
more had been drawn from there. Fences stand beyond low and high quantiles of the mixed sketch, by a
multiple of their distance from the median; a document outside one is rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart.llm import words as W
from rental_mart.llm.graph import cut

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MOST_REPEATED = 50, 50
#: For each measure: the share of documents beyond the quantile, how many of its distances from the
#: median the fence stands beyond it, and the least such distance. A corpus holds some hundredths of
#: texts full of symbols, which also have the longest words: they must lie beyond the quantile.
FENCES = {"word_length": (0.1, 3.0, 0.5), "symbols": (0.1, 0.5, 0.15), "dup_lines": (0.01, 0.5, 0.02), "repeats": (0.01, 0.5, 0.02)}
#: Documents that a language's sketch lends to each of its groups, and that of all to each language:
#: of so many, no single document is more than a hundredth, and none decides its own fence.
LENT = 100.0
_GAMMA = math.log(1.02)


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    w = W.split(texts)
    n, per = len(texts), np.diff(w.first)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    out = {"n_words": per, "n_symbols": _per_text(symbol[w.data], w.texts)}
    out["word_chars"] = _per_text(((w.data & 0xC0) != 0x80) & ~W._SPACE[w.data], w.texts)

    # Lines: each text's start, and behind each line feed.
    feeds = np.flatnonzero(w.data == 10)
    start = np.sort(np.concatenate([w.texts[:-1], feeds + 1]))
    of = np.searchsorted(w.texts[:-1], start, side="right") - 1
    of_feed = np.searchsorted(w.texts, feeds, side="right") - 1
    start = np.concatenate([w.texts[:-1], feeds + 1])
    of = np.concatenate([np.arange(n), of_feed])
    order = np.lexsort((start, of))
    start, of = start[order], of[order]
    last = np.append(of[1:] != of[:-1], True) if n else np.zeros(0, bool)
    end = np.where(last, w.texts[1:][of], np.append(start[1:], 0) - 1) if n else start
    full = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, of = start[full], end[full], of[full]
    line = W.string_hashes(W.string_totals(w.data, start), start, end) + W.mix(of.astype(np.uint64))
    kinds, first = np.unique(line, return_index=True)
    out["n_lines"] = np.bincount(of, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(of[first], minlength=n)

    found, at = W.windows(W.word_hashes(w), w.first, 3)
    of_word = np.repeat(np.arange(n), per)
    _, which, times = np.unique(found + W.mix(of_word[at].astype(np.uint64)), return_inverse=True, return_counts=True)
    twice = at[times[which] > 1] if len(at) else at
    covered = np.zeros(len(w.start), bool)
    for k in range(3):
        covered[twice + k] = True
    out["n_repeat_words"] = np.bincount(of_word[covered], minlength=n)
    return out


def measure(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` columns and the counts of the whole text; a null text counts as empty."""
    out = T.StructType([*df.select(*keep).schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, text_col):
                found = counts(part.column(text_col))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(found[c].astype(np.int64)) for c in COUNTS)], [*keep, *COUNTS])

    return df.select(*dict.fromkeys((*keep, text_col))).mapInArrow(run, out)


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _measures() -> dict[str, F.Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "word_length": F.col("word_chars") / n,
        "symbols": F.col("n_symbols") / n,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / n,
    }


def _mixed(binned: DataFrame, keys: list[str]) -> DataFrame:
    """Each group's bins with what is lent to it; ``docs`` is a weight then. One rule at every size."""
    now = binned.groupBy("measure", "bin").agg(F.sum("docs").cast("double").alias("docs"))
    for depth in range(1, len(keys) + 1):
        mine, above = keys[:depth], keys[: depth - 1]
        own = binned.groupBy(*mine, "measure", "bin").agg(F.sum("docs").cast("double").alias("docs"))
        share = (F.col("docs") / F.sum("docs").over(Window.partitionBy(*above, "measure")) * LENT).alias("docs")
        lender = now.select(*(F.col(k).alias(f"_{k}") for k in above), "measure", "bin", share)
        groups = binned.select(*mine).distinct()
        if above:
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in above]
            lent = groups.join(lender, same)
        else:
            lent = groups.crossJoin(F.broadcast(lender))  # the bins of all documents: some hundreds a measure
        now = own.unionByName(lent.select(own.columns)).groupBy(*mine, "measure", "bin").agg(F.sum("docs").alias("docs"))
    return now


def _of_measure(k: int) -> F.Column:
    return F.create_map(*(x for name, v in FENCES.items() for x in (F.lit(name), F.lit(v[k]))))[F.col("measure")]


def _quantiles(binned: DataFrame, keys: list[str]) -> DataFrame:
    """``low``, ``middle`` and ``high`` of each group and measure, read off the mixed bins."""
    by = Window.partitionBy(*keys, "measure")
    ranked = _mixed(binned, keys).withColumn("below", F.sum("docs").over(by.orderBy("bin"))).withColumn("docs_all", F.sum("docs").over(by))
    value = F.when(F.col("bin").isNull(), 0.0).otherwise(F.exp((F.col("bin") - 0.5) * _GAMMA))
    # Weights are sums of fractions: what is lost in rounding must not decide.
    tail = _of_measure(0)
    pick = lambda q: F.min(F.when(F.col("below") >= F.col("docs_all") * q * (1 - 1e-9), value))
    return ranked.groupBy(*keys, "measure").agg(pick(tail).alias("low"), pick(0.5).alias("middle"), pick(1 - tail).alias("high"))


def sketch(measured: DataFrame, keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Mergeable sketch: documents by group, measure and logarithmic bin (null: zero)."""
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), v.alias("v")) for k, v in _measures().items()))).alias("m")
    sound = measured.filter(~base_failed()).select(*keys, kinds).select(*keys, "m.measure", "m.v")
    bin_of = F.when(F.col("v") > 0, F.ceil(F.log("v") / _GAMMA))
    return sound.groupBy(*keys, "measure", bin_of.alias("bin")).agg(F.count("*").alias("docs"))


def thresholds(sketched: DataFrame, keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """One row for each group: ``<measure>_low`` and ``<measure>_high``."""
    reach, least = _of_measure(1), _of_measure(2)
    low, middle, high = (F.col(c) for c in ("low", "middle", "high"))
    fences = _quantiles(sketched, list(keys)).select(
        *keys, "measure", (low - F.greatest((middle - low) * reach, least)).alias("low"), (high + F.greatest((high - middle) * reach, least)).alias("high"),
    )
    return fences.groupBy(*keys).pivot("measure", list(FENCES)).agg(F.first("low").alias("low"), F.first("high").alias("high"))


def judge(measured: DataFrame, limits: DataFrame, keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Joins the thresholds by group (null equals null) and adds ``base_failed`` and ``kept``.

    A group without any sound document has no thresholds; its documents all fail the base rules.
    """
    limits = limits.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in limits.columns if c not in keys))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    inside = F.lit(True)
    for k, v in _measures().items():
        inside &= F.coalesce(v <= F.col(f"{k}_high"), F.lit(True))
        if k == "word_length":
            inside &= F.coalesce(v >= F.col(f"{k}_low"), F.lit(True))
    return (
        measured.join(limits, same, "left")
        .select(*measured.columns, base_failed().alias("base_failed"), (~base_failed() & inside).alias("kept"))
    )


def rules(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every row.

    Null languages and sources are groups of their own. Repeated rows count as often as they occur.
    Columns other than ``keep`` and the text are not read. The counts are cut to the shared folder:
    the sketch and the verdicts both read them.
    """
    measured = cut(measure(df, text_col, keep))
    return judge(measured, thresholds(sketch(measured)))
