"""N-gram Jaccard join with Bayesian candidate pruning.

Texts with equal sets of five-word shingles form a class, and one representative goes on. Buckets of
equal MinHash bands give candidate pairs; their MinHash values are compared some at a time, and a
pair is dropped as soon as the posterior probability that its similarity reaches the threshold falls
below a tolerance. What survives is gathered into clusters, and inside a cluster every pair is
verified exactly on the shingle sets. No pair is a row: blocks of bounded size are compared as a
whole and return counts and star edges (see blocks.py).

Bands of four values find a pair of similarity 0.8 with probability 1 - 5e-8 (32 bands).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rental_mart.llm import blocks
from rental_mart.llm import words as W
from rental_mart.llm.graph import components, stash
from rental_mart.llm.worker import task

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS, STEP = 32, 4, 16
TOLERANCE = 1e-5
BLOCK, BLOCK_BYTES = 256, 4 << 20
_HASHES = BANDS * ROWS
_A = np.random.default_rng(11).integers(1, 1 << 63, _HASHES, dtype=np.uint64) | np.uint64(1)
_B = np.random.default_rng(12).integers(1, 1 << 63, _HASHES, dtype=np.uint64)


def shingles(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted shingle hashes of each text, and where each text's begin. A text of fewer
    words has one shingle, all of its words; one without words has none."""
    w = W.split(texts)
    hashes = W.word_hashes(w)
    found, at = W.windows(hashes, w.first, width)
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < width))
    whole = W.spans(hashes, w.first[short], w.first[short + 1])
    of = np.concatenate([np.searchsorted(w.first, at, side="right") - 1, short])
    values = np.concatenate([found, whole])
    order = np.lexsort((values, of))
    of, values = of[order], values[order]
    new = np.append(True, (of[1:] != of[:-1]) | (values[1:] != values[:-1]))[: len(of)]
    return values[new], np.searchsorted(of[new], np.arange(len(texts) + 1))


def _names(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of each set."""
    out = []
    for salt in (0x51ED270B, 0xB5297A4D):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(W.mix(values * np.uint64(2) + np.uint64(salt)), out=total[1:])
        out.append(W.mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def minhash(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, hashes) signatures; zeros for texts without shingles."""
    out = np.zeros((len(at) - 1, _HASHES), np.uint32)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        first = at[full]
        for k in range(_HASHES):
            out[full, k] = np.minimum.reduceat(((values * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), first)
    return out


def _signed(docs: DataFrame) -> DataFrame:
    names = [c for c in docs.columns if c == "text_name"]

    @task("jaccard")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 20):
                values, at = shingles(part.column("text"))
                node, second = _names(values, at)
                sign = [s.tobytes() for s in minhash(values, at)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(node), pa.array(second), pa.array(np.diff(at).astype(np.int64)), pa.array(sign, pa.binary()), *(part.column(c) for c in names)],
                    ["doc_id", "node", "second", "n_shingles", "sign", *names],
                )

    return docs.mapInArrow(read, ", ".join(["doc_id bigint, node bigint, second bigint, n_shingles bigint, sign binary", *(f"{c} string" for c in names)]))


def _banded(classes: DataFrame) -> DataFrame:
    @task("jaccard")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sign = np.frombuffer(b"".join(batch.column("sign").to_pylist()), np.uint32).reshape(len(batch), BANDS, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), sign.shape[:2]).copy()
            for k in range(ROWS):
                key = W.mix(key * np.uint64(0x9E3779B97F4A7C15) + sign[:, :, k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64).ravel()), pa.array(np.repeat(np.asarray(batch.column("node")), BANDS))], ["bucket", "node"],
            )

    return classes.select("node", "sign").mapInArrow(read, "bucket bigint, node bigint")


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, hashes: int = _HASHES) -> list[int]:
    """Of k compared values, how many must agree so that the posterior probability of reaching the
    threshold (uniform prior) stays at the tolerance or above, for k = 0, 1, 2, ..."""
    out = []
    for k in range(hashes + 1):
        # 1 - I_t(m + 1, k - m + 1) is the chance of at most m successes in k + 1 trials.
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
        out.append(m)
    return out


def _candidates(threshold: float, tolerance: float):
    least = least_matches(threshold, tolerance)

    def one(table: pa.Table, a: np.ndarray, b: np.ndarray):
        node = np.asarray(table.column("node"))
        sign = np.frombuffer(b"".join(table.column("sign").to_pylist()), np.uint32).reshape(len(node), _HASHES)
        if a is b:
            x, y = np.triu_indices(len(a), 1)
            i, j = a[x], a[y]
        else:
            i, j = np.repeat(a, len(b)), np.tile(b, len(a))
        agree = np.zeros(len(i), np.int64)
        for lo in range(0, _HASHES, STEP):
            agree += (sign[i, lo : lo + STEP] == sign[j, lo : lo + STEP]).sum(1)
            live = agree >= least[lo + STEP]
            i, j, agree = i[live], j[live], agree[live]
            if not len(i):
                return None
        return node, np.zeros(len(node), np.int64), blocks.stars(len(node), i, j)

    return one


def _verified(threshold: float):
    def one(table: pa.Table, a: np.ndarray, b: np.ndarray):
        node, weight = np.asarray(table.column("node")), np.asarray(table.column("copies"))
        raw = table.column("shingles").to_pylist()
        sizes = np.array([len(r) // 8 for r in raw])
        kinds, which = np.unique(np.frombuffer(b"".join(raw), np.uint64), return_inverse=True)
        of = np.repeat(np.arange(len(node)), sizes)
        order = np.argsort(which, kind="stable")
        which, of = which[order], of[order]
        side_a, side_b = np.full(len(node), -1), np.full(len(node), -1)
        side_a[a], side_b[b] = np.arange(len(a)), np.arange(len(b))
        both = np.zeros((len(a), len(b)))
        for lo in range(0, len(kinds), 8192):
            s, e = np.searchsorted(which, [lo, lo + 8192])
            x, y = np.zeros((len(a), 8192), np.float32), np.zeros((len(b), 8192), np.float32)
            k, who = which[s:e] - lo, of[s:e]
            mine = side_a[who] >= 0
            x[side_a[who[mine]], k[mine]] = 1
            mine = side_b[who] >= 0
            y[side_b[who[mine]], k[mine]] = 1
            both += x @ y.T
        union = sizes[a][:, None] + sizes[b][None, :] - both
        near = both >= threshold * union - 1e-9
        if a is b:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        if not len(i):
            return None
        i, j = a[i], b[j]
        links = np.zeros(len(node), np.int64)
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        return node, links, blocks.stars(len(node), i, j)

    return one


def _sets(docs: DataFrame) -> DataFrame:
    """Shingle sets of the rows' texts, where the text has the row's set (ids may repeat)."""
    @task("jaccard")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                values, at = shingles(part.column("text"))
                name, second = _names(values, at)
                mine = np.flatnonzero((name == np.asarray(part.column("node"))) & (second == np.asarray(part.column("second"))))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(mine)) for c in ("node", "copies", "cluster")), pa.array([values[at[m] : at[m + 1]].tobytes() for m in mine], pa.binary())],
                    ["node", "copies", "cluster", "shingles"],
                )

    return docs.mapInArrow(read, "node bigint, copies bigint, cluster bigint, shingles binary").dropDuplicates(["node"])


def text_name(text: F.Column) -> F.Column:
    """Name of a text in ``join(named=True)``; rows are told apart by it where ids repeat."""
    return F.md5(text.cast("string"))


def join(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK, named: bool = False,
) -> DataFrame:
    """(doc_id, class_id, n_links, component_id), one row per input row.

    ``class_id``: smallest id among texts with the same shingle set. ``n_links``: other documents
    with a similarity of at least the threshold, those of the same class included.
    ``component_id``: smallest id reachable by links. A null text, or one without words, links with
    nothing and is a class of its own; so is a row with a null id (its class is null). Rows that
    repeat id and text are documents of their own that link with each other. Other columns are not
    read.

    ``named`` adds ``text_name`` and ``group``, a number that the texts of one component share and
    no others do (ids may repeat, so ``component_id`` may not tell components apart); it is null
    for rows that can't link.
    """
    docs = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        *([text_name(F.col(text_col)).alias("text_name")] if named else []),
    )
    signed = stash(_signed(docs))
    linked = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = stash(
        linked.groupBy("node", "second")
        .agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sign").alias("sign"))
    )

    # Buckets with the same members (the usual case for a pair of copies) are compared once.
    banded = _banded(classes)
    kept = (
        banded.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.min("node").alias("m"))
        .filter("n > 1").groupBy("n", "x", "m").agg(F.min("bucket").alias("bucket"))
    )
    kept = stash(kept.select("bucket", "n"))
    counted = kept.filter(F.col("n") > block).select("bucket", F.ceil(F.col("n") / block).alias("blocks"))
    members = banded.join(kept.select("bucket"), "bucket").join(classes.select("node", "sign"), "node")
    found = blocks.compare(blocks.blocked(members, "bucket", "node", counted), "bucket", _candidates(threshold, tolerance))
    cluster = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))

    clustered = classes.join(cluster.withColumnRenamed("component", "cluster"), "node").select("node", "second", "class_id", "copies", "cluster", "n_shingles")
    clustered = stash(clustered)
    big = clustered.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    big = big.select("cluster", F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("s") * 8 / BLOCK_BYTES)).alias("blocks")).filter("blocks > 1")
    # A shuffle join at every size: the clustered rows grow with the documents.
    sets = _sets(docs.join(clustered.withColumnRenamed("class_id", "doc_id").hint("merge"), "doc_id").select("text", "node", "second", "copies", "cluster"))
    sure = stash(blocks.compare(blocks.blocked(sets, "cluster", "node", big), "cluster", _verified(threshold)))
    links = sure.groupBy("node").agg(F.sum("links").alias("links"))
    group = components(sure.filter("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))

    reach = clustered.select("node", "class_id").join(links, "node").join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = reach.groupBy("component").agg(F.min("class_id").alias("component_id"))
    reach = reach.join(least, "component").select("node", "links", "component", "component_id")
    by_node = classes.select("node", "second", "class_id", "copies").join(reach, "node", "left")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("node")).alias("node")
    more = ["text_name", F.coalesce("component", "node").alias("group")] if named else []
    return signed.select("doc_id", own, "second", *more[:1]).join(by_node, ["node", "second"], "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "class_id", "doc_id").alias("component_id"), *more,
    )
