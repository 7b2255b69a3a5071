"""Cross-tokenizer alignment: which tokens of one vocabulary cover the same bytes as which of another.

Vocabulary A is a byte-level BPE (JSON file), B a SentencePiece BPE model with byte fallback. A text
is read by A with one space in front, which B adds itself, so both cover the same bytes.

Texts are shuffled whole, so that each distinct text is tokenised and aligned once, however many
documents hold it; how many do is the weight of its pairs in the corpus-wide counts. Documents get
the measures of their text back over a join by the text's name (two 64-bit hashes).

Inside a task a text is cut before every single space that stands between a character other than a
space and one that is not white space. No token of A or B reaches over such a place, so segments are
aligned on their own, once for each distinct one in a slice of texts, and a bounded cache keeps them.
For the same reason many segments are tokenised as one string; where such a string's tokens don't
join to its own bytes, its segments are tokenised one by one.

Null and empty texts, and texts whose tokens of A or B don't join to the text's own bytes, have no
tokens: zeros and an empty string. Each input row counts as a document of its own, also where an id
is null or repeats.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rental_mart.llm.graph import stash
from rental_mart.llm.words import slices, text_bytes
from rental_mart.llm.worker import keeps, task

#: Segments in one of the cache's two generations; some 500 bytes each.
CACHED_SEGMENTS = 100_000
#: Segments tokenised as one string.
TOGETHER = 64
#: Pair counts that one broadcast holds, 16 bytes each; each further slice is one more pass over the
#: pair lists (not over the texts).
SLICE_PAIRS = 4_000_000
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_TEXTS = (
    "k1 bigint, k2 bigint, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, pairs array<bigint>, times array<int>"
)
_SCORED = "k1 bigint, k2 bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"
_ROWS = pa.schema([*((c, pa.int64()) for c in MEASURES), ("groups", pa.large_string()), ("pairs", pa.list_(pa.int64())), ("lost", pa.bool_())])
_SPACE = "▁"
_WHITE = [c.encode() for c in map(chr, range(0x3001)) if c.isspace()]  # there is none beyond
_NARROW = np.isin(np.arange(256), [w[0] for w in _WHITE if len(w) == 1])
_WIDE = [int.from_bytes(w) for w in _WHITE if len(w) > 1]


def _white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space begins at each place ``at``."""
    white = _NARROW[data[at]]
    wide = np.flatnonzero(data[at] >= 0xC2)
    first, second, third = (np.take(data, at[wide] + i, mode="clip").astype(np.int64) for i in range(3))
    two = first << 8 | second
    white[wide] = np.isin(two, _WIDE) | np.isin(two << 8 | third, _WIDE)
    return white


def _plain_bytes() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _lost(n: int) -> pa.RecordBatch:
    """Rows of segments of which a vocabulary doesn't give the own bytes."""
    zeros = [np.zeros(n, np.int64)] * len(MEASURES)
    return pa.record_batch([*map(pa.array, zeros), pa.array([""] * n, pa.large_string()), pa.array([[]] * n, pa.list_(pa.int64())), pa.array([True] * n, pa.bool_())], schema=_ROWS)


class Aligner:
    """Both vocabularies, and the segments seen last."""

    def __init__(self, a_json: bytes, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        spec = json.loads(a_json)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("vocabulary A must be a byte-level BPE without a normalizer")
        self.a = Tokenizer.from_buffer(a_json)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte_of = _plain_bytes()
        self.a_bytes = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        for token, i in spec["model"]["vocab"].items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        #: Cutting at single spaces is exact only where no piece of B holds one behind another character.
        self.cuts = spec["pre_tokenizer"].get("use_regex", True) and not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces)
        na, nb = len(self.a_bytes), len(pieces)
        mark = [f"{i}," for i in range(na)] + [f"{i}|" for i in range(na)] + [f"{i}," for i in range(nb)] + [f"{i};" for i in range(nb)]
        self.mark = pa.array(mark, pa.large_string())
        #: Row of each segment, and the rows, of the younger and the older generation.
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.rows = self.older_rows = _lost(0)

    def segments(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The segments of all texts, each with the space before it, and the number of each text's
        first one, one more than texts."""
        raw = [f" {t}".encode() for t in texts]
        first = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        data = np.frombuffer(b"".join(raw) + b" ", np.uint8)
        starts = np.zeros(len(data), bool)
        if self.cuts:
            at = np.flatnonzero((data[1:-1] == 0x20) & (data[:-2] != 0x20)) + 1
            starts[at[~_white(data, at + 1)]] = True
        starts[first] = True
        at = np.flatnonzero(starts)
        offsets = pa.py_buffer(at.astype(np.int32))
        return pa.StringArray.from_buffers(len(at) - 1, offsets, pa.py_buffer(data)), np.searchsorted(at, first)

    def align(self, segments: pa.Array, together: int = TOGETHER) -> pa.RecordBatch:
        """Measures, groups (each with its end) and linked pairs of each segment, and whether it is
        lost: a vocabulary doesn't give its own bytes."""
        data, at = text_bytes(segments)
        # Joined are segments that are cut apart again wherever they meet.
        plain = np.full(len(segments), self.cuts)
        long = np.flatnonzero(np.diff(at) > 1)
        plain &= np.isin(np.arange(len(segments)), long[(data[at[long + 1] - 1] != 0x20) & ~_white(data, at[long] + 1)])
        order = np.argsort(~plain, kind="stable")
        data, at = text_bytes(segments.take(pa.array(order)))
        bounds = np.concatenate([np.arange(0, plain.sum(), together), np.arange(plain.sum(), len(order) + 1)])
        raw, ends, held = data.tobytes(), at[bounds].tolist(), np.diff(bounds)
        own = [raw[lo:hi] for lo, hi in zip(ends, ends[1:])]
        strings = [x.decode() for x in own]
        a = [e.ids for e in self.a.encode_batch_fast(strings, add_special_tokens=False)] if own else []
        b = self.b.encode([s[1:] for s in strings], num_threads=1) if own else []
        good = self._fitting(own, a, b)
        fits = np.zeros(len(own), bool)
        fits[good] = True
        kept = np.repeat(fits, held)
        again = np.flatnonzero(~kept & np.repeat(held > 1, held))
        lost = np.flatnonzero(~kept & np.repeat(held == 1, held))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(map(ids.__getitem__, good)), np.int64) for ids in (a, b))
        rows = [self._measured(ids_a, ids_b, np.diff(at)[kept]), _lost(len(lost))]
        if len(again):
            rows.append(self.align(segments.take(pa.array(order[again])), 1))
        place = order[np.concatenate([np.flatnonzero(kept), lost, again])]
        return pa.concat_batches(rows).take(pa.array(np.argsort(place)))

    def _measured(self, ids_a: np.ndarray, ids_b: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        """Rows of segments of ``size`` bytes from the tokens of all of them."""
        if not len(size):
            return _lost(0)
        stop = np.concatenate([[0], np.cumsum(size)])  # of each segment, in bytes of all of them
        end_a, end_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        is_a, is_b = np.zeros((2, stop[-1] + 1), bool)
        is_a[end_a] = is_b[end_b] = True
        both = is_a & is_b
        every, common = np.flatnonzero(is_a | is_b), np.flatnonzero(both)  # a link ends wherever a token ends
        upto_a, upto_b, upto_groups, upto_links = (np.cumsum(x) for x in (is_a, is_b, both, is_a | is_b))
        pairs = ids_a[upto_a[every - 1]] << 32 | ids_b[upto_b[every - 1]]
        # A group's tokens of A stand before its tokens of B.
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        marks = np.empty(len(ids_a) + len(ids_b), np.int64)
        before = np.concatenate([[0], common])[upto_groups[end_a - 1]]
        marks[np.arange(len(ids_a)) + upto_b[before]] = ids_a + n_a * both[end_a]
        marks[np.arange(len(ids_b)) + upto_a[common[upto_groups[end_b - 1]]]] = ids_b + 2 * n_a + n_b * both[end_b]
        told = self.mark.take(pa.array(marks))
        at = np.frombuffer(told.buffers()[1], np.int64)[upto_a[stop] + upto_b[stop]]
        groups = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(at), told.buffers()[2])
        lists = pa.ListArray.from_arrays(pa.array(upto_links[stop], pa.int32()), pa.array(pairs))
        counts = (pa.array(np.diff(upto[stop])) for upto in (upto_a, upto_b, upto_groups, upto_links))
        return pa.record_batch([*counts, groups, lists, pa.array(np.zeros(len(size), bool))], schema=_ROWS)

    def _fitting(self, own: list[bytes], a: list[list[int]], b: list[list[int]]) -> list[int]:
        """Numbers of the segments whose tokens of A and of B join to the segment's own bytes."""
        size, good = np.array([len(x) for x in own]), np.arange(len(own))
        whole = True
        for ids, sizes, strings in ((a, self.a_size, self.a_bytes), (b, self.b_size, self.b_bytes)):
            n = [len(x) for x in ids]
            flat = list(chain.from_iterable(ids))
            got = np.bincount(np.repeat(good, n), sizes[np.array(flat, np.int64)], len(own))
            whole &= (got == size).all() and b"".join(map(strings.__getitem__, flat)) == b"".join(own)
        if whole:
            return good.tolist()
        join = lambda ids, strings: b"".join(map(strings.__getitem__, ids))
        return [i for i, x in enumerate(own) if join(a[i], self.a_bytes) == x and join(b[i], self.b_bytes) == x]

    def lookup(self, segments: pa.Array) -> pa.RecordBatch:
        """The row of each segment; the cache keeps two generations, and what is met again in the
        older one moves to the younger."""
        if len(self.known) > CACHED_SEGMENTS:
            self.older, self.older_rows = self.known, self.rows
            self.known, self.rows = {}, _lost(0)
        known, names = self.known, segments.to_pylist()
        new = np.array([i for i, s in enumerate(names) if s not in known], np.int64)
        if len(new):
            was = np.array([self.older.get(names[i], -1) for i in new.tolist()], np.int64)
            fresh = new[was < 0]
            added = [names[i] for i in np.concatenate([new[was >= 0], fresh]).tolist()]
            known.update(zip(added, range(self.rows.num_rows, self.rows.num_rows + len(added))))
            self.rows = pa.concat_batches([self.rows, self.older_rows.take(pa.array(was[was >= 0])), self.align(segments.take(pa.array(fresh)))])
        return self.rows.take(pa.array(map(known.__getitem__, names), pa.int64()))

    def texts(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Measures (a row for each text), digests, and the distinct pairs of each text with how
        often they are linked in it: offsets, pairs, times."""
        segments, at = self.segments(texts)
        coded = segments.dictionary_encode()
        codes, found = np.asarray(coded.indices).astype(np.int64), self.lookup(coded.dictionary)
        bad = found.column("lost").to_numpy(zero_copy_only=False)
        numbers = np.stack([np.asarray(found.column(c)) for c in MEASURES], axis=1)
        pair_at, pairs = np.asarray(found.column("pairs").offsets, np.int64), np.asarray(found.column("pairs").values)
        which = np.repeat(np.arange(len(texts)), np.diff(at))
        lost = np.bincount(which, bad[codes], len(texts)) > 0
        sums = np.zeros((len(codes) + 1, 4), np.int64)
        np.cumsum(numbers[codes], axis=0, out=sums[1:])
        sums = sums[at[1:]] - sums[at[:-1]]
        sums[lost] = 0
        told = found.column("groups").take(coded.indices)
        ends = np.frombuffer(told.buffers()[1], np.int64)[at].tolist()
        told = memoryview(told.buffers()[2] or b"")
        digests = ["" if gone else hashlib.sha256(told[lo : hi - 1]).hexdigest() for lo, hi, gone in zip(ends, ends[1:], lost.tolist())]
        # Each distinct segment of a text once, then each of its pairs.
        held, often = np.unique(which[~lost[which]] * len(bad) + codes[~lost[which]], return_counts=True)
        which, codes = held // max(1, len(bad)), held % max(1, len(bad))
        size = np.diff(pair_at)[codes]
        first = np.concatenate([[0], np.cumsum(size)])
        take = np.arange(first[-1]) + np.repeat(pair_at[codes] - first[:-1], size)
        rank, index = np.unique(pairs, return_inverse=True)
        keys = np.repeat(which, size) * max(1, len(rank)) + index[take]
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.add.reduceat(np.repeat(often, size)[order], new).astype(np.int32) if len(new) else np.zeros(0, np.int32)
        keys = keys[new]
        offsets = np.searchsorted(keys // max(1, len(rank)), np.arange(len(texts) + 1))
        return sums, digests, offsets, rank[keys % max(1, len(rank))] if len(keys) else np.zeros(0, np.int64), times


@lru_cache(maxsize=1)
def _aligner(a_json: bytes, b_model: bytes) -> Aligner:
    return Aligner(a_json, b_model)


keeps("align", _aligner.cache_clear)


def text_name(text: F.Column | str) -> list[F.Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def aligned_texts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """A row for each distinct text that is not empty: its name (k1, k2), the number of documents
    that hold it, its measures, and its distinct pairs (A id * 2^32 + B id) with how often they are
    linked in it. Written to the shared checkpoint folder and read from there."""
    files = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            files.append(f.read())
    files = docs.sparkSession.sparkContext.broadcast(tuple(files))  # two vocabulary files, whatever the data

    @task("align")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*files.value)
        for batch in batches:
            for part in slices(batch, "text"):
                sums, digests, offsets, pairs, times = aligner.texts(part.column("text").to_pylist())
                at = pa.array(offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("k1", "k2", "copies")), *(pa.array(sums[:, i]) for i in range(4)), pa.array(digests, pa.string()),
                     pa.ListArray.from_arrays(at, pa.array(pairs)), pa.ListArray.from_arrays(at, pa.array(times))],
                    ["k1", "k2", "copies", *MEASURES, "groups_sha256", "pairs", "times"],
                )

    each = docs.select(F.col(text_col).alias("text")).filter("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    return stash(each.select(*text_name("text"), "copies", "text").mapInArrow(run, _TEXTS), compression="zstd")


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, n, best): how many documents hold the pair linked, and whether that is the highest
    count of its A id, ties included. At most as many rows as A has tokens times B's."""
    counts = stash(texts.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("n")))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    top = counts.groupBy("a").agg(F.max("n").alias("most"))
    return stash(counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def scored_texts(texts: DataFrame, counts: DataFrame, slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """Measures of each text with n_best and count_sum. The counts go to the workers in slices of
    at most about ``slice_pairs`` rows, each broadcast for one pass over the pair lists and then
    released; the sums over slices are put together by text."""
    sc = texts.sparkSession.sparkContext
    n = max(1, -(-counts.count() // slice_pairs))
    done = []
    for k in range(n):
        mine = counts.filter(F.pmod(F.xxhash64("pair"), F.lit(n)) == k).select("pair", "n", "best").toArrow()
        pair, best = np.asarray(mine.column("pair")), np.asarray(mine.column("best"))
        order = np.argsort(pair)
        # A pair that is its A id's best has its count negated.
        table = sc.broadcast((pair[order], np.where(best, -1, 1)[order] * np.asarray(mine.column("n"))[order]))
        done.append(stash(texts.drop("copies").mapInArrow(_scorer(table), _SCORED)))
        table.unpersist()
    if n == 1:
        return done[0]
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    same = [F.max(c).alias(c) for c in (*MEASURES, "groups_sha256")]
    return every.groupBy("k1", "k2").agg(*same, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def _scorer(table):
    @task("align")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n = table.value
        for batch in batches:
            lists = batch.column("pairs")
            offsets = np.asarray(lists.offsets, np.int64)
            first, last = offsets[0], offsets[-1]
            mine, times = (np.asarray(batch.column(c).values)[first:last] for c in ("pairs", "times"))
            at = np.searchsorted(pair, mine)
            at[at == len(pair)] = 0
            count = np.where(pair[at] == mine, n[at], 0) if len(pair) else np.zeros(len(mine), np.int64)
            sums = []
            for value in (times * (count < 0), times * np.abs(count)):
                total = np.concatenate([[0], np.cumsum(value)])
                sums.append(pa.array(total[offsets[1:] - first] - total[offsets[:-1] - first]))
            names = ["k1", "k2", *MEASURES, "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *sums], [*names, "n_best", "count_sum"])

    return run


def alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """One row for each input row: its id, n_a, n_b, n_groups, n_links, groups_sha256, n_best and
    count_sum. Other columns are not read, whatever their names."""
    texts = aligned_texts(docs, a_path, b_path, text_col)
    scored = stash(scored_texts(texts, pair_counts(texts), slice_pairs))
    rows = docs.select(F.col(id_col).alias(id_col), F.when(F.col(text_col) != "", F.col(text_col)).alias("_text"))
    named = rows.select(id_col, *(F.when(F.col("_text").isNotNull(), k).alias(f"_{name}") for k, name in zip(text_name("_text"), ("k1", "k2"))))
    joined = named.join(scored, (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*MEASURES, "n_best", "count_sum")]
    return joined.select(id_col, *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
