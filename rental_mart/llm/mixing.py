"""Mixing sources to target weights.

The texts of a source form one stream of words, packed into blocks of ``BLOCK`` words. An output
shard draws how many of its slots each source fills (multinomial); the i-th slot of a source takes
block ``permutation(i mod blocks)`` of that source, the permutation being a keyed bijection of
0..blocks-1 (Feistel rounds with cycle walking), so every block is used once before any is used
again. Draws over all shards scatter around the targets; slots drawn beyond a source's quota are
handed to the sources short of theirs, in order, so every quota is met exactly. A source's last slot
takes only as many words of its block as its target still asks for. Slots and blocks are joined by
(source, block).

Seeds, hashes and orders depend only on the rows, so a rerun gives the same mix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart.llm.graph import stash
from rental_mart.llm.words import WORD, mix, slices, split
from rental_mart.llm.worker import task

BLOCK = 64
SHARD_SLOTS = 1024
SHARD_GROUP = 1024
MOST_REPEATS = 3
WEIGHTS = (5, 2, 1)
BUCKET_WORDS = 1 << 22
MAX_SOURCES = 100_000
SEED = 20240101


def sizes(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_hash): number of words, 0 for a null text."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64("text", "source").alias("text_hash"),
    )


def targets(totals: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> list[float]:
    """Targets of sources given in order: all words shared by weight, none above ``most`` times its
    source's size, the excess reshared by weight among the others until none is above."""
    weight = [weights[i % len(weights)] for i in range(len(totals))]
    left, out, rest = float(sum(n for _, n in totals)), [0.0] * len(totals), list(range(len(totals)))
    while rest:
        all_weight = sum(weight[i] for i in rest)
        above = [i for i in rest if left * weight[i] / all_weight > most * totals[i][1]]
        if not above:
            for i in rest:
                out[i] = left * weight[i] / all_weight
            break
        for i in above:
            out[i] = float(most * totals[i][1])
        left -= sum(out[i] for i in above)
        rest = [i for i in rest if i not in set(above)]
    return out


def source_table(sized: DataFrame, seed: int = 0) -> list[dict]:
    """One row for each source, by code point, null last: its size and target. The one table that
    goes to the driver and to every task; more than MAX_SOURCES sources are refused."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; group them before mixing")
    totals = sorted(((r["source"], r["n"]) for r in rows), key=lambda t: (t[0] is None, t[0] or ""))
    out = []
    for k, ((name, n), target) in enumerate(zip(totals, targets(totals))):
        blocks = -(-n // BLOCK)
        full, left = divmod(round(target), n) if n else (0, 0)
        more, cut = _partial(n, blocks, left, seed + k)
        out.append({"source": name, "source_no": k, "source_size": n, "target": target, "blocks": blocks, "quota": full * blocks + more, "cut": cut})
    return out


def _partial(size: int, blocks: int, words: int, key: int) -> tuple[int, int]:
    """How many blocks in the source's order hold ``words`` words, and how many words too many."""
    if not words:
        return 0, 0
    more, lacking = -(-words // BLOCK), blocks * BLOCK - size  # the source's last block is short
    if lacking and place_of(blocks - 1, blocks, key) < more:
        more = -(-(words + lacking) // BLOCK)
        return more, more * BLOCK - lacking - words
    return more, more * BLOCK - words


def running(df: DataFrame, keys: list[str], chunk: str, order: list, value: str, out: str) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the same keys; chunks come in order of their
    number. Rows are ordered inside a chunk only, and one row for each chunk beyond."""
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    chunks = df.groupBy(*keys, chunk).agg(F.sum(value).alias("_n")).select(*keys, chunk, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        df.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(chunks, [*keys, chunk]).withColumn(out, F.col(out) + F.col("_before")).drop("_before")
    )


def _source_frame(df: DataFrame, sources: list[dict]) -> DataFrame:
    # Arrow rows go to the JVM as they are; from Python rows executors start more Python processes.
    kinds = {"source": pa.string(), "source_no": pa.int32(), "source_size": pa.int64(), "target": pa.float64(), "blocks": pa.int64(), "quota": pa.int64(), "cut": pa.int64()}
    return df.sparkSession.createDataFrame(pa.table({c: pa.array([s[c] for s in sources], kind) for c, kind in kinds.items()}))


def _numbered(sized: DataFrame, sources: list[dict]) -> DataFrame:
    table = _source_frame(sized, sources).withColumnRenamed("source", "_source")
    return sized.join(table, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def pieces(numbered: DataFrame) -> DataFrame:
    """Packs the words of each source: (source_no, block, start, doc_id, text_hash, first, end), one
    row for each block that a text reaches into; ``start`` is the text's place in the stream."""
    chunks = F.greatest(F.ceil(F.col("source_size") / BUCKET_WORDS), F.lit(1))
    placed = numbered.filter("size > 0").withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "text_hash"), chunks))
    placed = running(placed, ["source_no"], "_chunk", [F.xxhash64("doc_id"), F.col("doc_id"), F.col("text_hash")], "size", "start")
    end = F.col("start") + F.col("size")
    block = F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((end - 1) / BLOCK))).alias("block")
    return placed.select("source_no", block, "start", "doc_id", "text_hash", "size").select(
        "source_no", "block", "start", "doc_id", "text_hash",
        F.greatest(F.col("block") * BLOCK - F.col("start"), F.lit(0)).alias("first"),
        F.least((F.col("block") + 1) * BLOCK - F.col("start"), F.col("size")).alias("end"),
    )


def permute(index: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """A keyed bijection of 0..n-1."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> np.uint64(half), out[walk] & mask
        for r in range(rounds):
            left, right = right, left ^ (mix(right + np.uint64((key * 31 + r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & mask)
        out[walk] = (left << np.uint64(half)) | right
        walk = walk[out[walk] >= n]
    return out.astype(np.int64)


def place_of(block: int, n: int, key: int, rounds: int = 6) -> int:
    """The index that ``permute`` sends to a block."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    mask, out = (1 << half) - 1, block
    while True:
        left, right = out >> half, out & mask
        for r in reversed(range(rounds)):
            salt = (key * 31 + r + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
            left, right = right ^ (int(mix(np.array([(left + salt) % (1 << 64)], np.uint64))[0]) & mask), left
        out = left << half | right
        if out < n:
            return out


def _draw(shard: int, slots: int, quotas: np.ndarray, seed: int) -> np.ndarray:
    rng = np.random.Generator(np.random.Philox(key=[seed, shard]))
    return rng.multinomial(slots, quotas / quotas.sum())


def slots(df: DataFrame, sources: list[dict], seed: int = SEED) -> DataFrame:
    """(shard, slot, source_no, repeat, block, stop): which block fills each slot of each output
    shard, and the place in the source's stream where its words stop."""
    spark = df.sparkSession
    quotas, size, cut = (np.array([s[c] for s in sources], np.int64) for c in ("quota", "source_size", "cut"))
    blocks = [s["blocks"] for s in sources]
    n_slots = int(quotas.sum())
    n_shards = -(-n_slots // SHARD_SLOTS)
    columns = "shard bigint, shard_group bigint, source_no int, drawn bigint"
    if not n_slots:
        return spark.createDataFrame([], "shard bigint, slot bigint, source_no int, repeat bigint, block bigint, stop bigint")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                drawn = _draw(shard, min(SHARD_SLOTS, n_slots - shard * SHARD_SLOTS), quotas, seed)
                some = np.flatnonzero(drawn)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), shard)), pa.array(np.full(len(some), shard // SHARD_GROUP)), pa.array(some.astype(np.int32)), pa.array(drawn[some])],
                    ["shard", "shard_group", "source_no", "drawn"],
                )

    drawn = spark.range(n_shards).mapInArrow(draw, columns)
    totals = {r["source_no"]: r["n"] for r in drawn.groupBy("source_no").agg(F.sum("drawn").alias("n")).collect()}
    total = np.array([totals.get(k, 0) for k in range(len(sources))], np.int64)
    # Surplus slots, numbered through all sources, go to the sources that are short, in order.
    surplus_at = np.concatenate([[0], np.cumsum(np.maximum(total - quotas, 0))])
    short_at = np.concatenate([[0], np.cumsum(np.maximum(quotas - total, 0))])
    placed = running(drawn, ["source_no"], "shard_group", [F.col("shard")], "drawn", "first").withColumn("_at", F.lit(0))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, source, n, first = (np.asarray(batch.column(c)) for c in ("shard", "source_no", "drawn", "first"))
            of = np.repeat(np.arange(len(n)), n)
            within = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            source, index = source[of].astype(np.int64), first[of] + within
            over = index >= quotas[source]
            spare = surplus_at[source[over]] + index[over] - quotas[source[over]]
            to = np.searchsorted(short_at, spare, side="right") - 1
            source[over], index[over] = to, total[to] + spare - short_at[to]
            block, repeat = np.empty(len(index), np.int64), np.empty(len(index), np.int64)
            for k in np.unique(source):
                mine = source == k
                repeat[mine], place = np.divmod(index[mine], blocks[k])
                block[mine] = permute(place, blocks[k], int(seed + k))
            stop = np.minimum((block + 1) * BLOCK, size[source]) - np.where(index == quotas[source] - 1, cut[source], 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[of]), pa.array(index), pa.array(source.astype(np.int32)), pa.array(repeat), pa.array(block), pa.array(stop)],
                ["shard", "slot", "source_no", "repeat", "block", "stop"],
            )

    return placed.select("shard", "source_no", "drawn", "first").mapInArrow(fill, "shard bigint, slot bigint, source_no int, repeat bigint, block bigint, stop bigint")


def mix_sources(documents: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The mix as (shard, slot, source_no, repeat, block, stop, start, doc_id, text_hash, first, end)
    rows (words first..end of a text), and the sized documents with their source's figures.

    A null source is a source of its own; a null text has no words and is never taken. Rows that
    repeat id and text are separate texts of the stream. Other columns are not read.
    """
    sized = stash(sizes(documents))
    sources = source_table(sized, seed)
    numbered = _numbered(sized, sources)
    # Both sides grow with the documents, which the planner can't see from a range of shards.
    joined = slots(documents, sources, seed).hint("merge").join(pieces(numbered), ["source_no", "block"])
    joined = joined.withColumn("end", F.least("end", F.col("stop") - F.col("start"))).filter("first < end")
    return joined, numbered


def taken(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row per input row; ``taken`` counts
    the words that the mix takes of it, repeats included. Rows that repeat id, text and source
    share what is taken of them evenly, but for the last word of the division."""
    mixed, numbered = mix_sources(documents, seed)
    key = ["source_no", "doc_id", "text_hash"]
    n = mixed.groupBy(*key).agg(F.sum(F.col("end") - F.col("first")).alias("n"))
    n = n.select(*(F.col(k).alias(f"_{k}") for k in key), "n")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    rows = numbered.groupBy(*key, "source", "size", "source_size", "target").agg(F.count("*").alias("copies")).join(n, same, "left")
    rows = rows.select("*", F.coalesce("n", F.lit(0)).alias("all"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    share = F.floor(F.col("all") * F.col("copy") / F.col("copies")) - F.floor(F.col("all") * (F.col("copy") - 1) / F.col("copies"))
    return rows.select("doc_id", "source", "size", "source_size", "target", share.cast("long").alias("taken"))


def mixed_documents(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """The words that the mix takes, as documents: one row for each text and repeat, all columns of
    the input. A text that is taken whole keeps its text; of one taken in part, each unbroken run
    of words is cut out as it stands, and runs are joined by a line feed. ``n_chars`` is set anew
    where there is such a column. Rows that repeat id, source and text give as many texts.
    """
    columns = documents.columns
    own = [f"c{i}" for i in range(len(columns))]  # a column may have any name
    place = {c: own[columns.index(c)] for c in ("doc_id", "text", "source")}
    keyed = documents.toDF(*own).withColumn("key", F.coalesce(F.col(place["doc_id"]).cast("long"), F.lit(-(1 << 63)))).withColumn("hash", F.xxhash64(place["text"], place["source"]))
    mixed, _ = mix_sources(documents, seed)
    # A text's blocks in one repeat: bounded by its own length.
    ranges = (
        mixed.groupBy(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"), F.col("text_hash").alias("hash"), "start", "repeat")
        .agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("ranges"))
    )
    chosen = keyed.dropDuplicates(["key", "hash"]).join(ranges.select("key", "hash", "ranges"), ["key", "hash"])

    @task("mixing")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place["text"]):
                w = split(part.column(place["text"]))
                raw, texts = w.data.tobytes(), []
                for i, ranges in enumerate(part.column("ranges").to_pylist()):
                    lo, n = w.first[i], w.first[i + 1] - w.first[i]
                    runs: list[list[int]] = []
                    for r in ranges:
                        if runs and r["first"] == runs[-1][1]:
                            runs[-1][1] = r["end"]
                        else:
                            runs.append([r["first"], r["end"]])
                    if runs == [[0, n]]:
                        texts.append(raw[w.texts[i] : w.texts[i + 1]].decode())
                    else:
                        texts.append("\n".join(raw[w.start[lo + a] : w.end[lo + b - 1]].decode() for a, b in runs))
                new = {"text": pa.array(texts, pa.string())}
                if "n_chars" in columns:
                    new["n_chars"] = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([new[c] if c in new else part.column(k) for c, k in zip(columns, own)], columns)

    schema = T.StructType([T.StructField("n_chars", T.LongType()) if f.name == "n_chars" else f for f in documents.schema.fields])
    return chosen.select(*own, "ranges").mapInArrow(read, schema)
