"""All pairs inside buckets of any size, compared in blocks of bounded size.

A bucket with more members than a block holds is cut into blocks by a hash of the member, and each
pair of blocks is a task of its own; a member goes to as many tasks as its bucket has blocks. Tasks
return counts and star edges for their members, never a row for each pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rental_mart.llm.worker import task

OUT = "node bigint, other bigint, links bigint"


def blocked(members: DataFrame, bucket: str, node: str, counted: DataFrame) -> DataFrame:
    """Adds the block pair (``lo``, ``hi``) of every task that a member takes part in and its own
    ``block``. ``counted`` has (bucket, blocks) for the buckets of more than one block."""
    return dealt(members.join(counted.select(bucket, "blocks"), bucket, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))), node)


def dealt(with_blocks: DataFrame, node: str) -> DataFrame:
    """The same for members that know their bucket's number of ``blocks``."""
    own = with_blocks.withColumn("block", F.pmod(F.xxhash64(F.lit(7), node), F.col("blocks")).cast("int"))
    tasks = own.withColumn("_with", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    return tasks.withColumn("lo", F.least("block", "_with")).withColumn("hi", F.greatest("block", "_with")).drop("_with", "blocks")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches -> tables that hold whole groups only, with the row where each begins."""
    held: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        table = now if held is None else pa.concat_tables([held, now]).combine_chunks()
        at = _edges(table, keys)
        if len(at) > 1:
            yield table.slice(0, at[-1]), at[:-1]
            held = table.slice(at[-1])
        else:
            held = table
    if held is not None and len(held):
        yield held, _edges(held, keys)


def _edges(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(table), bool)
    new[:1] = True
    for k in keys:
        column = np.asarray(table.column(k))
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of n members reaches over the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def out_batch(nodes: np.ndarray, links: np.ndarray, label: np.ndarray) -> pa.RecordBatch | None:
    """Counts and star edges of a task's members; None where nothing links."""
    star = np.flatnonzero(label != np.arange(len(label)))
    some = np.flatnonzero(links)
    if not len(star) and not len(some):
        return None
    node = np.concatenate([nodes[some], nodes[star]])
    other = np.concatenate([nodes[some], nodes[label[star]]])
    count = np.concatenate([links[some], np.zeros(len(star), np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array(other), pa.array(count)], ["node", "other", "links"])


def compare(tasks: DataFrame, bucket: str, one: Callable[[pa.Table, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray] | None]) -> DataFrame:
    """Runs ``one`` on each task: (rows of the task, row numbers of its two sides) -> (nodes, links,
    label). The sides are the same array where a block meets itself."""
    keys = [bucket, "lo", "hi"]

    @task("blocks")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, keys):
            for lo, hi in zip(at, [*at[1:], len(table)]):
                rows = table.slice(lo, hi - lo)
                sides = cross(np.asarray(rows.column("block")), rows.column("lo")[0].as_py(), rows.column("hi")[0].as_py())
                if sides is not None and (found := one(rows, *sides)) is not None:
                    if (batch := out_batch(*found)) is not None:
                        yield batch

    return tasks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(read, OUT)


def cross(block: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Row numbers of the two sides of the task (lo, hi); the same array twice where a block meets
    itself. None where there is no pair: hashing may leave a block without members, and the pairs
    inside the other one are those of its own task."""
    first = np.flatnonzero(block == lo)
    if lo == hi:
        return (first, first) if len(first) > 1 else None
    second = np.flatnonzero(block == hi)
    return (first, second) if len(first) and len(second) else None
