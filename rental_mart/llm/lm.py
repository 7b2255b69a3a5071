"""Language-model scores from a log-frequency Bloom filter.

The counts of all training words and word pairs are quantised to powers of two; a pair with level q
is a member of the filter as (pair, 1) to (pair, q). A count is read by probing level after level
until one misses, and the middle of the last level found stands for it. The filter goes to the
workers by broadcast, which has a size bound: it is cut into buckets by hash, words and pairs alike,
and as many buckets as the bound allows are broadcast for one pass over the texts and then released.
A pass writes the levels that it finds, two bytes for each position; what several passes find is put
together, and votes and scores are read off the levels.

A pair's probability mixes its relative frequency with the add-one word probability. The weight
depends on the level of the context's count and comes from deleted interpolation over all training
texts: each position votes for the estimate that predicts it better once it is left out itself.

The exact add-one word score (``base_score``) uses exact counts. Words with at least a
``FREQUENT``-th of all tokens (at most ``FREQUENT`` words, whatever the data) are broadcast; the
others are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rental_mart.llm import words as W
from rental_mart.llm.graph import stash
from rental_mart.llm.worker import task

FREQUENT = 200_000
FLUSH = 1 << 21
BUCKET = 1 << 20  # training pairs in a bucket of the filter, about
BITS, PROBES = 8, 4
FILTER_BYTES = 128 << 20
LEVELS = 64
_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_END = _U(0x2545F4914F6CDD1D)
_WORD_SALT = _U(0xA0761D6478BD642F)
_PAIR, _LEVEL = _U(0xD1342543DE82EF95), 0x9E3779B97F4A7C15


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word keys and pair keys of all tokens (words, then the end), context keys, and the index of
    each text's first token. The first token's context is the end of another text."""
    w = W.split(texts)
    hashes = W.string_hashes(W.string_totals(_LOWER[w.data], w.start), w.start, w.end)
    n = len(texts)
    first = w.first + np.arange(n + 1)
    at_end = first[1:] - 1
    token = np.full(first[-1], _END, np.uint64)
    inside = np.ones(first[-1], bool)
    inside[at_end] = False
    token[inside] = hashes
    before = np.concatenate([[_END], token[:-1]])[: len(token)]
    word, context = W.mix(token ^ _WORD_SALT), W.mix(before ^ _WORD_SALT)
    return word, W.mix(context * _PAIR + token), context, first


def _pack(keys: np.ndarray, times: np.ndarray, bits: int, kind: int) -> Iterator[dict]:
    """Sorted distinct keys and their counts, one row for each bucket (the top bits of the key)."""
    bucket = (keys >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else []
    for lo, hi in zip(at, [*at[1:], len(keys)]):
        # The lowest byte goes: 56 bits tell the pairs of a bucket apart.
        low = np.ascontiguousarray(keys[lo:hi]).view(np.uint8).reshape(-1, 8)[:, 1:]
        yield {"kind": kind, "bucket": int(bucket[lo]), "keys": low.tobytes(), "times": times[lo:hi].astype(np.uint32).tobytes()}


_PACKED = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("keys", pa.binary()), ("times", pa.binary())])


def _pairs(docs: DataFrame, bits: int) -> DataFrame:
    """Packed counts of the pairs in training texts, combined over a couple of million tokens."""
    @task("lm")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_pylist(list(_pack(keys, times, bits, 2)), _PACKED)

        for batch in batches:
            for part in W.slices(batch, "text"):
                held.append(_tokens(part.column("text"))[1])
                if sum(map(len, held)) >= FLUSH:
                    yield out()
        if held:
            yield out()

    return docs.filter(~F.col("held_out")).select("text").mapInArrow(read, "kind int, bucket bigint, keys binary, times binary")


def _word_keys(words: pa.Array) -> np.ndarray:
    data, at = W.text_bytes(words)
    hashes = W.string_hashes(W.string_totals(data, at[:-1]), at[:-1], at[1:])
    return W.mix(np.where(np.diff(at) == 0, _END, hashes) ^ _WORD_SALT)


def _words(counted: DataFrame, bits: int) -> DataFrame:
    @task("lm")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _word_keys(batch.column("word"))
            order = np.argsort(keys)
            times = np.minimum(np.asarray(batch.column("n")), np.iinfo(np.uint32).max)
            yield pa.RecordBatch.from_pylist(list(_pack(keys[order], times[order], bits, 1)), _PACKED)

    return counted.mapInArrow(read, "kind int, bucket bigint, keys binary, times binary")


def _positions(keys: np.ndarray, level: int, size: np.ndarray) -> Iterator[np.ndarray]:
    a = W.mix((keys >> _U(8)) + _U(level * _LEVEL % (1 << 64)))
    b = (a >> _U(33)) | _U(1)
    for i in range(PROBES):
        yield (a + _U(i) * b) % size


def _levels(times: np.ndarray) -> np.ndarray:
    return np.frexp(times.astype(np.float64))[1]  # 1 + floor(log2(count))


def build(packed: DataFrame, bits_each: int = BITS) -> DataFrame:
    """(kind, bucket, filter) rows: merged counts of a bucket, as one small Bloom filter with
    ``bits_each`` bits for each member."""
    def read(table: pa.Table) -> pa.Table:
        raw = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint8).reshape(-1, 7)
        keys = np.zeros((len(raw), 8), np.uint8)
        keys[:, 1:] = raw
        keys, which = np.unique(keys.view(np.uint64).ravel(), return_inverse=True)
        times = np.bincount(which, np.frombuffer(b"".join(table.column("times").to_pylist()), np.uint32))
        level = _levels(times)
        size = -(-int(level.sum()) * bits_each // 64) * 64
        bits = np.zeros(size, bool)
        for q in range(1, int(level.max()) + 1):
            for at in _positions(keys[level >= q], q, _U(size)):
                bits[at] = True
        return pa.table({"kind": [table.column("kind")[0]], "bucket": [table.column("bucket")[0]], "filter": pa.array([np.packbits(bits).tobytes()], pa.binary())},
                        schema=pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("filter", pa.binary())]))

    return packed.groupBy("kind", "bucket").applyInArrow(read, "kind int, bucket bigint, filter binary")


class Filter:
    """The buckets of one kind that a pass holds, as one buffer; ``size`` has the bytes of each."""

    def __init__(self, size: np.ndarray, data: np.ndarray):
        self.bits = len(size).bit_length() - 1
        self.size = (size * 8).astype(np.uint64)
        self.offset = np.concatenate([[0], np.cumsum(size)[:-1]])
        self.data = data

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> _U(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key: 0 where it was never counted."""
        kinds, which = np.unique(keys, return_inverse=True)
        bucket = self.bucket(kinds)
        out, size, at = np.zeros(len(kinds), np.int64), self.size[bucket], self.offset[bucket]
        live = np.flatnonzero(size > 0)
        q = 0
        while len(live) and q < LEVELS:
            q += 1
            there = np.ones(len(live), bool)
            for bit in _positions(kinds[live], q, size[live]):
                byte = self.data[at[live] + (bit >> _U(3)).astype(np.int64)]
                there &= (byte >> (7 - (bit & _U(7))).astype(np.uint8)) & 1 == 1
            live = live[there]
            out[live] = q
        return out[which]


#: The middle of each level's counts.
_COUNT = np.concatenate([[0.0], (1.5 * 2.0 ** np.arange(1, LEVELS + 2) - 1) / 2])


def _share(rows: DataFrame, kind: int, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The filters of the buckets that have a size, as one buffer; ``size`` by bucket."""
    at = np.concatenate([[0], np.cumsum(size)])
    data = np.zeros(int(at[-1]), np.uint8)
    held = np.flatnonzero(size)
    if len(held):
        mine = rows.filter((F.col("kind") == kind) & F.col("bucket").between(int(held[0]), int(held[-1])))
        for row in mine.select("bucket", "filter").toLocalIterator():
            data[at[row["bucket"]] : at[row["bucket"] + 1]] = np.frombuffer(row["filter"], np.uint8)
    return size, data


def _sizes(rows: DataFrame, kind: int, bits: int) -> np.ndarray:
    """Bytes of each bucket's filter: one number for each bucket."""
    out = np.zeros(1 << bits, np.int64)
    for r in rows.filter(F.col("kind") == kind).select("bucket", F.length("filter").alias("n")).toLocalIterator():
        out[r["bucket"]] = r["n"]
    return out


def _passes(words: np.ndarray, pairs: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bucket sizes for each pass, 0 where it doesn't hold a bucket: at most ``most`` bytes or one bucket."""
    size, of, held, number = np.concatenate([words, pairs]), [], 0, 0
    for n in size.tolist():
        if held and held + n > most:
            held, number = 0, number + 1
        held += n
        of.append(number)
    mine = [np.where(np.array(of) == k, size, 0) for k in range(number + 1)]
    return [(m[: len(words)], m[len(words) :]) for m in mine]


def _estimates(levels: pa.Array):
    """Of every position: its text, context level, counts of pair, context, word. A text's levels are
    those of its words, then those of its pairs; the first context is an end, as is its last word."""
    offsets = np.frombuffer(levels.buffers()[1], np.int32)[levels.offset : levels.offset + len(levels) + 1].astype(np.int64)
    data = np.frombuffer(levels.buffers()[2], np.uint8) if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    n = np.diff(offsets) // 2
    of = np.repeat(np.arange(len(n)), n)
    local = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    at = offsets[:-1][of] + local
    known = data[np.where(local == 0, at + n[of] - 1, at - 1)]
    both = _COUNT[data[at + n[of]]]
    return of, known, both, np.maximum(_COUNT[known], both), _COUNT[data[at]]


def _bits(n: int, each: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n / each))))


def score(documents: DataFrame, text_col: str = "text", id_col: str = "doc_id", filter_bytes: int = FILTER_BYTES, bits_each: int = BITS) -> DataFrame:
    """Scores of every row: held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text is empty (one token, its end); a null id counts as the empty text when texts are
    held out. Rows that repeat id and text get the same scores, and count as often as they occur in
    training. With no training text, N and V are 0. Other columns are not read. A pass over the
    texts holds filters of ``filter_bytes`` at most, or one bucket's (about a million counts).
    At 8 bits for each member one stranger in forty is taken for a member.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_key"), F.xxhash64("text").alias("text_hash"),
        "doc_id", "text", (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2).alias("held_out"),
    )
    counted = stash(_count_words(docs))
    n_train, n_words = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = {r["word"]: r["n"] for r in counted.filter(F.col("n") * FREQUENT >= n_train).toLocalIterator()}
    sc = documents.sparkSession.sparkContext
    exact = sc.broadcast(frequent)

    word_bits, pair_bits = _bits(n_words, BUCKET), _bits(n_train, BUCKET)
    filters = stash(build(_words(counted, word_bits).unionByName(_pairs(docs, pair_bits)), bits_each))
    key = ["doc_key", "text_hash"]
    read = []
    for k, sizes in enumerate(_passes(_sizes(filters, 1, word_bits), _sizes(filters, 2, pair_bits), filter_bytes)):
        shared = sc.broadcast((_share(filters, 1, sizes[0]), _share(filters, 2, sizes[1])))
        read.append(stash(_level_pass(docs, shared, exact if k == 0 else None), compression="zstd"))
        shared.destroy()
    own = read[0]
    if len(read) > 1:
        own = stash(_together(own, read[1:], key), compression="zstd")
    norm = n_train + n_words + 1
    votes = np.zeros((2, LEVELS + 1))
    for r in _vote(own, n_train).groupBy("level").agg(F.sum("pair").alias("pair"), F.sum("word").alias("word")).collect():
        votes[:, r["level"]] = (r["pair"], r["word"])
    weight = (votes[0] + 0.5) / (votes.sum(0) + 1)
    weight[0] = 0.0
    rare = own.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    joined = (
        rare.join(counted, "word").groupBy("row")
        .agg(F.sum(F.log10(F.col("n") + 1) * F.col("times")).alias("rare_log"), F.sum("times").alias("rare_known"))
    )
    return (
        _scored(own.drop("rare"), weight, norm).join(joined, "row", "left")
        .select(
            F.when(F.col("doc_key") > -(1 << 63), F.col("doc_key")).alias("doc_id"), "held_out", "n_tokens",
            (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(int(n_train)).cast("long").alias("train_tokens"),
            (F.col("exact_log") + F.coalesce("rare_log", F.lit(0.0)) - F.col("n_tokens") * math.log10(norm)).alias("base_score"),
            "score",
        )
    )


def _count_words(docs: DataFrame) -> DataFrame:
    """Exact counts of the tokens in training texts; the end of a text is the empty word."""
    @task("lm")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode() for w in held], pa.string())
            part = pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return part

        for batch in batches:
            for part in W.slices(batch, "text"):
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    held.update(text.lower().split())
                held[b""] += len(part)
                if len(held) >= 400_000:
                    yield out()
        if held:
            yield out()

    return docs.filter(~F.col("held_out")).select("text").mapInArrow(read, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


_ROW = "row bigint, doc_key bigint, text_hash bigint, held_out boolean, n_tokens bigint, known bigint, exact_log double, rare array<struct<word:string,times:int>>, levels binary"


def _level_pass(docs: DataFrame, shared, exact) -> DataFrame:
    """One pass over the texts: the levels of all words and pairs that its buckets hold (0 for the
    others), and in the first pass the exact sums of frequent words and the counts of rare ones."""
    @task("lm")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = (Filter(*x) for x in shared.value)
        logs = {k.encode(): math.log10(v + 1) for k, v in exact.value.items()} if exact is not None else {}
        row_end = TaskContext.get().partitionId() << 33  # a number for each row, fixed once written
        for batch in batches:
            for part in W.slices(batch, "text"):
                word, pair, _, first = _tokens(part.column("text"))
                n = np.diff(first)
                levels = np.empty(2 * len(word), np.uint8)
                at = np.arange(len(word)) + np.repeat(first[:-1], n)
                levels[at], levels[at + np.repeat(n, n)] = words.level(word), pairs.level(pair)
                offsets = (2 * first).astype(np.int32)
                rows, rare, times, ends = [], [], [], [0]
                for text in part.column("text").cast(pa.binary()).to_pylist() if exact is not None else ():
                    held = Counter(text.lower().split())
                    n_tokens = sum(held.values()) + 1
                    held[b""] = 1
                    there = [w for w in held if w in logs]
                    rows.append((n_tokens, sum(held[w] for w in there), math.fsum(logs[w] * held[w] for w in there)))
                    mine = [w for w in held if w not in logs]
                    rare += mine
                    times += map(held.__getitem__, mine)
                    ends.append(len(rare))
                if exact is None:
                    rows, ends = [(0, 0, 0.0)] * len(part), [0] * (len(part) + 1)
                tokens, known, logged = zip(*rows)
                items = pa.StructArray.from_arrays([pa.array(rare, pa.binary()).cast(pa.string()), pa.array(times, pa.int32())], ["word", "times"])
                row, row_end = row_end, row_end + len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row_end), pa.int64()), part.column("doc_key"), part.column("text_hash"), part.column("held_out"),
                     pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(logged, pa.float64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items),
                     pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(levels)])],
                    ["row", "doc_key", "text_hash", "held_out", "n_tokens", "known", "exact_log", "rare", "levels"],
                )

    return docs.select("doc_key", "text_hash", "held_out", "text").mapInArrow(read, _ROW)


def _together(own: DataFrame, more: list[DataFrame], key: list[str]) -> DataFrame:
    """What all passes found: each position's levels are 0 but in the passes that hold its keys."""
    each = more[0].select(*key, "levels")
    for other in more[1:]:
        each = each.unionByName(other.select(*key, "levels"))
    each = each.groupBy(*key).agg(F.collect_set("levels").alias("found"))  # one for each pass at most

    @task("lm")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for levels, found in zip(*(batch.column(c).to_pylist() for c in ("levels", "found"))):
                best.append(np.maximum.reduce([np.frombuffer(x, np.uint8) for x in (levels, *found)]).tobytes())
            names = [c for c in batch.schema.names if c not in ("levels", "found")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(best, pa.binary())], [*names, "levels"])

    return own.join(each, key).select(*own.columns, "found").mapInArrow(read, _ROW)


def _vote(own: DataFrame, n_train: int) -> DataFrame:
    """Votes by context level over training texts: whether the pair or the word predicts better."""
    @task("lm")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = np.zeros((2, LEVELS + 1))
        for batch in batches:
            _, known, both, context, word = _estimates(batch.column("levels"))
            by_pair = np.maximum(both - 1, 0) / np.maximum(context - 1, 1)
            better = by_pair > np.maximum(word - 1, 0) / max(n_train - 1, 1)
            votes += [np.bincount(known[k], minlength=LEVELS + 1)[: LEVELS + 1] for k in (better, ~better)]
        yield pa.RecordBatch.from_arrays([pa.array(range(LEVELS + 1), pa.int32()), pa.array(votes[0]), pa.array(votes[1])], ["level", "pair", "word"])

    return own.filter(~F.col("held_out")).select("levels").mapInArrow(read, "level int, pair double, word double")


def _scored(own: DataFrame, weight: np.ndarray, norm: float) -> DataFrame:
    @task("lm")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, known, both, context, word = _estimates(batch.column("levels"))
            share = weight[known]
            p = share * both / np.maximum(context, 1) + (1 - share) * (word + 1) / norm
            names = [c for c in batch.schema.names if c != "levels"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(np.bincount(of, np.log10(p), minlength=len(batch)))], [*names, "score"])

    return own.mapInArrow(read, _ROW.replace("rare array<struct<word:string,times:int>>, levels binary", "score double"))
