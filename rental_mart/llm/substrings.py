"""Substring dedup: removes word windows that an earlier document (a smaller id) holds too.

Every window of 50 words gets Rabin-Karp hashes to three bases, 93 bits in all. Counting all of them would shuffle more bytes than
the texts hold, so windows that no other document can share are left out first, exactly: the
smallest hash of the 8-word runs inside a window is its anchor; equal windows have equal anchors,
and a text has one anchor for about twenty windows. Only windows whose anchor occurs in two
documents are counted. Repeated windows merge into maximal intervals, which are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rental_mart.llm import words as W
from rental_mart.llm.graph import stash

WIDTH, RUN = 50, 8


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of x[i : i + width] for each i (shorter at the end)."""
    out, span = x, 1
    while span < width:
        step = min(span, width - span)
        out = np.minimum(out, np.append(out[step:], np.full(min(step, len(out)), np.iinfo(x.dtype).max, x.dtype)))
        span += step
    return out


def _hashed(texts: pa.Array, width: int, run: int) -> tuple[W.Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, their hashes, hashes of all windows, their anchors, and the first word of each window."""
    w = W.split(texts)
    hashes = W.word_hashes(w)
    found, at = W.windows(hashes, w.first, width)
    ends = np.minimum(np.arange(len(hashes)) + run, len(hashes))
    low = _sliding_min(W.spans(hashes, np.arange(len(hashes)), ends), width - run + 1)
    return w, hashes, found.view(np.int64), low[at].view(np.int64), at


def _anchors(docs: DataFrame, width: int, run: int) -> DataFrame:
    """Distinct anchors of each text."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                w, _, _, anchor, at = _hashed(part.column("text"), width, run)
                of = np.searchsorted(w.first, at, side="right") - 1
                # Windows side by side nearly always share their anchor.
                new = np.append(True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1]))[: len(at)]
                anchor, of = anchor[new], of[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), part.column("doc_id").take(pa.array(of)), part.column("text_hash").take(pa.array(of))],
                    ["anchor", "doc_id", "text_hash"],
                )

    return docs.mapInArrow(read, "anchor bigint, doc_id bigint, text_hash int")


def _windows(docs: DataFrame, width: int, run: int) -> DataFrame:
    """Hash and first word of each window whose anchor is among the row's shared ones; ``asks``
    where an earlier document has the anchor, ``offers`` where a later one has."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                w, hashes, found, anchor, at = _hashed(part.column("text"), width, run)
                first = np.searchsorted(at, w.first)
                marks = []
                for column in ("asks", "offers"):
                    lists = part.column(column)
                    offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
                    flat = np.asarray(lists.flatten(), np.int64)
                    mark = np.zeros(len(at), bool)
                    for i in range(len(part)):
                        lo, hi = first[i], first[i + 1]
                        mark[lo:hi] = np.isin(anchor[lo:hi], flat[offsets[i] : offsets[i + 1]])
                    marks.append(mark)
                keep = marks[0] | marks[1]
                at, found = at[keep], found[keep]
                of = np.searchsorted(w.first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(W.checks(hashes, at, at + width)), part.column("doc_id").take(pa.array(of)), part.column("text_hash").take(pa.array(of)),
                     pa.array((at - w.first[of]).astype(np.int32)), *(pa.array(m[keep]) for m in marks)],
                    ["window", "check", "doc_id", "text_hash", "at", "asks", "offers"],
                )

    return docs.mapInArrow(read, "window bigint, check int, doc_id bigint, text_hash int, at int, asks boolean, offers boolean")


def _cut_out(docs: DataFrame, width: int) -> DataFrame:
    """Merges the windows at ``at`` into intervals and removes them from the text."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                rows = []
                for text, at, copy in zip(*(part.column(c).to_pylist() for c in ("text", "at", "copy"))):
                    words = (text or "").encode().split()
                    if copy:
                        at = range(0, len(words) - width + 1)
                    spans: list[list[int]] = []
                    for a in sorted(set(at or ())):
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = a + width
                        else:
                            spans.append([a, a + width])
                    kept, last = [], 0
                    for a, b in spans:
                        kept += words[last:a]
                        last = b
                    kept += words[last:]
                    rows.append((len(words), len(words) - len(kept), [{"first": a, "end": b} for a, b in spans], b" ".join(kept).decode()))
                n, gone, spans_, texts = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(spans_, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(texts, pa.string())],
                    ["doc_id", "n_words", "n_removed", "removed", "kept_text"],
                )

    return docs.mapInArrow(read, "doc_id bigint, n_words bigint, n_removed bigint, removed array<struct<first:bigint,end:bigint>>, kept_text string")


def dedup(documents: DataFrame, width: int = WIDTH, run: int = RUN) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept_text), one row per input row.

    ``removed`` has maximal intervals of word numbers (end exclusive); ``kept_text`` the other
    words, joined by one space. A null text has no words. Rows that repeat both id and text get the
    same result; rows that repeat an id with another text are texts of one document, which do not
    count as earlier than each other. A null id is neither earlier nor later than any, so nothing
    is removed from its text or because of it. Other columns are not read. ``run`` is at most
    ``width``.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.hash("text"))
    key = ["doc_id", "text_hash"]  # the hash tells the texts of one id apart
    # Texts that an earlier document holds whole are done: each of their windows starts there too.
    names = ["name", "second_name"]
    whole = docs.filter("doc_id is not null").select(*key, F.xxhash64("text").alias("name"), F.xxhash64(F.lit(1), "text").alias("second_name"))
    earliest = whole.groupBy(*names).agg(F.min("doc_id").alias("first_doc"))
    copies = whole.join(earliest, names).filter("doc_id > first_doc").select(*key).distinct()

    anchors = stash(_anchors(docs.filter("doc_id is not null"), width, run))
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    mine = (
        anchors.join(shared, "anchor").groupBy(*key)
        .agg(F.collect_set(F.expr("if(doc_id > lo, anchor, null)")).alias("asks"), F.collect_set(F.expr("if(doc_id < hi, anchor, null)")).alias("offers"))
        .join(copies, key, "left_anti")
    )
    found = _windows(docs.join(mine, key), width, run)
    first = found.filter("offers").groupBy("window", "check").agg(F.min("doc_id").alias("first_doc"))
    repeats = found.filter("asks").drop("asks", "offers").join(first, ["window", "check"]).filter("doc_id > first_doc").groupBy(*key).agg(F.collect_set("at").alias("at"))
    told = repeats.withColumn("copy", F.lit(False)).unionByName(copies.select(*key, F.lit(None).cast("array<int>").alias("at"), F.lit(True).alias("copy")))
    return _cut_out(docs.join(told, key, "left").select("doc_id", "text", "at", "copy"), width)
