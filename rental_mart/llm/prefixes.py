"""Trie of conversation prefixes: who shares which first turns, and what sharing them saves.

Each conversation is the sequence of its turns' names (two 64-bit hashes of role and text). The
sequences are range-partitioned and sorted, copies by conversation id, so a shard holds neighbours
and a prefix lies in shards next to each other. A shard numbers its turns in a dictionary and builds
a ternary search tree over the numbers, inserting the median of a range first and then those of its
halves, so that siblings are balanced. Nodes are made after their parents; one walk back over them
adds up members, leaves and savings.

Other shards can share only those nodes that lie on the path of a shard's first or last sequence.
These boundary nodes leave the shard as sums that can be added up, without what depends on a node
being counted once (its own bytes, and whether it is a leaf). After merging, each boundary node
belongs to one of the paths that hold it, and running sums up that path give its share to the nodes
above. Nothing is gathered but a conversation's own turns (24 bytes each) and a shard, which is of
bounded size unless one conversation alone is larger.

Turns are ordered by turn, null first; ties go by the turn's name, so that they don't depend on the
partitioning. A null role or text is empty. Rows without a conversation id belong to no conversation
and are in no node. A turn that is repeated, row for row, counts each time. An empty table gives no
nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart.llm.graph import stash

SHARD_TURNS = 200_000
CHUNK_IDS = 8192
NODE, BOUNDARY, ENDS = 0, 1, 2
NO_ENDS = hashlib.sha256(b"").hexdigest()
_PARTS = T.StructType([
    T.StructField(name, kind)
    for kind, names in (
        (T.IntegerType(), "kind shard path"),
        (T.LongType(), "k1 k2 parent1 parent2 conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens size"),
        (T.BooleanType(), "has_child"),
        (T.StringType(), "ends"),
    )
    for name in names.split()
])


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (a, b, n): the name and the text's
    UTF-8 bytes. Other columns are not read, whatever their names."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    named = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("known"), "turn",
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"), F.octet_length(text).cast("long").alias("n"),
    )
    every = named.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("known", "turn", "a", "b", "n"))).alias("turns"))
    return every.select("conv_id", F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["n"].alias("n"))).alias("turns"))


def rebuilt(each: DataFrame, group: int = 5, longest: int = 8) -> DataFrame:
    """Conversations that branch off another one: the first h turns of the conversation with the
    group's first id (none where it is absent), then the own turns after the first h.

    h is the CRC-32 of the decimal id modulo ``longest`` + 1. Groups of negative ids begin at the
    next lower multiple, too.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % (longest + 1)).cast("int")
    heads = each.select(F.col("conv_id").alias("base"), F.slice("turns", 1, longest).alias("head"))
    own = each.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(group))).withColumn("h", h)
    joined = own.join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    return joined.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


class Tree:
    """Ternary search tree of sequences of codes; node 0 is the empty prefix."""

    def __init__(self) -> None:
        self.code, self.low, self.next, self.high = [-1], [0], [0], [0]
        self.parent, self.depth, self.size, self.ends = [-1], [0], [0], [-1]

    def _make(self, code: int, parent: int, size: int) -> int:
        for column, value in zip((self.code, self.low, self.next, self.high, self.parent, self.depth, self.size, self.ends), (code, 0, 0, 0, parent, self.depth[parent] + 1, size, -1)):
            column.append(value)
        return len(self.code) - 1

    def insert(self, codes: list[int], sizes: list[int], number: int) -> None:
        code, low, high, after = self.code, self.low, self.high, self.next
        at = 0
        for c, size in zip(codes, sizes):
            now = after[at]
            if not now:
                after[at] = now = self._make(c, at, size)
            while code[now] != c:
                side = low if c < code[now] else high
                if not side[now]:
                    side[now] = self._make(c, at, size)
                now = side[now]
            at = now
        self.ends[at] = number

    def path(self, codes: list[int]) -> list[int]:
        out = [0]
        for c in codes:
            now = self.next[out[-1]]
            while self.code[now] != c:
                now = self.low[now] if c < self.code[now] else self.high[now]
            out.append(now)
        return out


def _medians(n: int) -> Iterator[int]:
    """0 to n-1, the median of a range before those of its halves."""
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += [(mid + 1, hi), (lo, mid)]


def _ids(names: bytes, depth: int) -> list[tuple[int, int]]:
    """Names of the prefixes of a sequence, from the empty one on."""
    running = hashlib.blake2b(digest_size=16)
    out = []
    for d in range(depth + 1):
        if d:
            running.update(names[16 * (d - 1) : 16 * d])
        digest = running.copy().digest()
        out.append(tuple(int.from_bytes(digest[i : i + 8], "little", signed=True) for i in (0, 8)))
    return out


def shard_rows(convs: np.ndarray, names: np.ndarray, sizes: np.ndarray, at: np.ndarray, shard: int) -> Iterator[dict]:
    """The nodes of one shard: ``names`` has two numbers for each turn, ``sizes`` one, and ``at``
    tells with which turn each conversation begins (one more than conversations). Conversations are
    sorted by names, then id."""
    a, b = names[0::2], names[1::2]
    order = np.lexsort((b, a))
    new = np.ones(len(a), np.int64)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    codes = np.empty(len(a), np.int64)
    codes[order] = np.cumsum(new) - 1
    codes, sizes, raw = codes.tolist(), sizes.tolist(), np.ascontiguousarray(names).tobytes()
    at = at.tolist()
    each = [codes[lo:hi] for lo, hi in zip(at, at[1:])]
    first = [i for i, s in enumerate(each) if not i or s != each[i - 1]]  # rows where another sequence begins
    until = [*first[1:], len(each)]

    tree = Tree()
    for k in _medians(len(first)):
        i = first[k]
        tree.insert(each[i], sizes[at[i] : at[i + 1]], k)
    paths = [tree.path(each[0]), tree.path(each[-1])]
    ids = [_ids(raw[16 * at[i] : 16 * at[i + 1]], len(each[i])) for i in (0, len(each) - 1)]
    edge = {node: key for path, keys in zip(paths, ids) for node, key in zip(path, keys)}

    count = len(tree.code)
    members, least = [0] * count, [None] * count
    kids, inner, leaves, saved = [0] * count, [0] * count, [0] * count, [0] * count
    for node, k in enumerate(tree.ends):
        if k >= 0:
            members[node], least[node] = until[k] - first[k], int(convs[first[k]])
    for node in range(count - 1, -1, -1):
        up, here = tree.parent[node], node in edge
        saved[node] += (members[node] - (not here)) * tree.size[node]
        if not here and not kids[node]:
            leaves[node] = 1
        if up >= 0:
            members[up] += members[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            kids[up] += 1
            inner[up] += not here
            leaves[up] += leaves[node]
            saved[up] += saved[node]

    def ending(k: int) -> list[str]:
        return list(map(str, convs[first[k] : until[k]].tolist()))

    for node in range(count):
        if node in edge:
            continue
        up, k = tree.parent[node], tree.ends[node]
        row = {
            "kind": NODE, "conv_id": least[node], "depth": tree.depth[node], "n_convs": members[node], "n_children": kids[node], "n_leaves": leaves[node],
            "saved_tokens": saved[node], "ends": hashlib.sha256(",".join(ending(k)).encode()).hexdigest() if k >= 0 else NO_ENDS,
        }
        if up in edge:
            row["parent1"], row["parent2"] = edge[up]
        else:
            row["parent_conv_id"] = least[up]
        yield row
    told = set()
    for number, path in enumerate(paths):
        for node in path:
            again = node in told  # what both paths hold is told once; the second path goes on below it
            told.add(node)
            row = {
                "kind": BOUNDARY, "shard": shard, "path": number, "depth": tree.depth[node], "conv_id": least[node], "size": tree.size[node], "has_child": kids[node] > 0,
                "n_convs": 0 if again else members[node], "n_children": 0 if again else inner[node], "n_leaves": 0 if again else leaves[node], "saved_tokens": 0 if again else saved[node],
            }
            row["k1"], row["k2"] = edge[node]
            if node:
                row["parent1"], row["parent2"] = edge[tree.parent[node]]
            yield row
            if tree.ends[node] >= 0 and not again:
                mine = ending(tree.ends[node])
                for lo in range(0, len(mine), CHUNK_IDS):
                    yield {"kind": ENDS, "k1": row["k1"], "k2": row["k2"], "conv_id": int(mine[lo]), "ends": ",".join(mine[lo : lo + CHUNK_IDS])}


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(_PARTS)
    held = list(batches)
    if not sum(map(len, held)):
        return
    rows = pa.Table.from_batches(held)
    names, sizes = (rows.column(c).combine_chunks() for c in ("names", "sizes"))
    n = np.concatenate([[0], np.cumsum(np.asarray(rows.column("n_turns"), np.int64))])
    out: list[dict] = []
    for row in shard_rows(np.asarray(rows.column("conv_id")), np.asarray(names.flatten()), np.asarray(sizes.flatten()), n, TaskContext.get().partitionId()):
        out.append(row)
        if len(out) == 5000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the ids that end at each boundary node; chunks come sorted by node and id."""
    key, running = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([running.hexdigest()])], ["k1", "k2", "ends"])

    for batch in batches:
        for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ends"))):
            if (k1, k2) != key:
                if key is not None:
                    yield done()
                key, running = (k1, k2), hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
    if key is not None:
        yield done()


def trie(each: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """(conv_id, turns) -> one row for each distinct prefix: conv_id (its smallest member), depth,
    parent_conv_id (the parent's), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node's ids are hashed in order, so a digest of very many ends takes one task that reads them
    in chunks and holds one."""
    flat = F.flatten(F.transform("turns", lambda t: F.array(t["a"], t["b"])))
    rows = stash(each.select("conv_id", flat.alias("names"), F.transform("turns", lambda t: t["n"]).alias("sizes"), F.size("turns").alias("n_turns")))
    turns = rows.agg(F.sum(F.col("n_turns") + 1)).first()[0] or 0
    shards = max(1, -(-turns // shard_turns))
    ranged = rows.repartitionByRange(shards, "names", "conv_id").sortWithinPartitions("names", "conv_id")
    parts = stash(ranged.mapInArrow(_build, _PARTS))

    inner, edges, chunks = (parts.filter(F.col("kind") == k) for k in (NODE, BOUNDARY, ENDS))
    merged = stash(edges.groupBy("k1", "k2").agg(
        *(F.max(c).alias(c) for c in ("depth", "parent1", "parent2", "size", "has_child")), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.min(F.struct("shard", "path")).alias("owner"),
    ))
    # Each path's share: of the nodes that belong to it, at and below each of its nodes.
    owned = edges.select("k1", "k2", "shard", "path", "depth").join(merged.select("k1", "k2", "size", "has_child", "owner"), ["k1", "k2"])
    mine = F.struct("shard", "path") == F.col("owner")
    below = Window.partitionBy("shard", "path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    shares = owned.select(
        "k1", "k2", F.sum(F.when(mine, F.col("size")).otherwise(0)).over(below).alias("once"),
        F.sum(F.when(mine & ~F.col("has_child"), 1).otherwise(0)).over(below).alias("leaf"),
    ).groupBy("k1", "k2").agg(F.sum("once").alias("once"), F.sum("leaf").alias("leaf"))
    kids = merged.filter("parent1 is not null").groupBy(F.col("parent1").alias("k1"), F.col("parent2").alias("k2")).agg(F.count("*").alias("more"))
    ends = chunks.select("k1", "k2", "conv_id", "ends").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id").mapInArrow(_ends, "k1 bigint, k2 bigint, ends string")
    known = merged.select(F.col("k1").alias("parent1"), F.col("k2").alias("parent2"), F.col("conv_id").alias("above"))

    whole = merged.join(shares, ["k1", "k2"]).join(kids, ["k1", "k2"], "left").join(ends, ["k1", "k2"], "left").join(known, ["parent1", "parent2"], "left")
    edge_rows = whole.select(
        "conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs", (F.col("n_children") + F.coalesce("more", F.lit(0))).alias("n_children"),
        (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"), (F.col("saved_tokens") - F.col("once")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    columns = [F.col(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [F.col("ends").alias("ends_sha256")]
    deep = inner.filter("parent1 is null").select(*columns)
    top = inner.filter("parent1 is not null").drop("parent_conv_id").join(known, ["parent1", "parent2"]).withColumnRenamed("above", "parent_conv_id").select(*columns)
    return edge_rows.unionByName(deep).unionByName(top)
