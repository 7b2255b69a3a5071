"""Near-duplicate vectors by E8 lattice hashing.

Each table projects unit vectors to eight dimensions at random and decodes them to the nearest point
of the E8 lattice, the cell. A vector also probes the lattice points next to its own that it is
closest to. Vectors that meet in a cell (one of them at home there) are verified by their cosine in
double precision. At a cosine of 0.9 a table of the default scale and probes finds 47 % of the
pairs, so that eight tables find over 99 %, and more of the closer ones.

Equal vectors are compared once. Cells of any size are compared in blocks (see blocks.py). A pair
that several cells hold is counted in the first of them.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rental_mart.llm import blocks
from rental_mart.llm.graph import components, stash
from rental_mart.llm.words import mix

TABLES, PROBES, SCALE = 8, 2, 0.2
BLOCK = 512
COSINE = 0.9


def _neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8: of the even integer points and the same moved by one half."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def _cell(points: np.ndarray, table: int, dims: int) -> np.ndarray:
    out = np.full(points.shape[:-1], table * 1_000_003 + dims, np.uint64)
    for k in range(8):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + (2 * points[..., k]).astype(np.int64).view(np.uint64))
    return out.view(np.int64)


def cells(unit: np.ndarray, tables: int, probes: int, scale: float) -> np.ndarray:
    """(vectors, tables, 1 + probes) cell numbers, the home cell first."""
    step, dims = _neighbours(), unit.shape[1]
    out = np.empty((len(unit), tables, 1 + probes), np.int64)
    for t in range(tables):
        project = np.random.default_rng([t, dims]).normal(size=(dims, 8)) / (8 * scale)
        x = unit @ project
        home = decode(x)
        near = np.argpartition(-((x - home) @ step.T), max(probes - 1, 0), axis=1)[:, :probes]
        out[:, t, 0] = _cell(home, t, dims)
        out[:, t, 1:] = _cell(home[:, None, :] + step[near], t, dims)
    return out


def _units(vectors: DataFrame, tables: int, probes: int, scale: float) -> DataFrame:
    """(node, copies, dims, unit, home, probed): one row for each vector that can link."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 4096):
                part = batch.slice(lo, 4096)
                lists = part.column("embedding")
                size = np.diff(np.asarray(lists.offsets))
                flat, first = np.asarray(lists.flatten(), np.float64), np.asarray(lists.offsets) - lists.offsets[0].as_py()
                for dims in np.unique(size):
                    rows = np.flatnonzero(size == dims)
                    x = flat[first[rows][:, None] + np.arange(dims)]
                    unit = x / np.abs(x).max(1, keepdims=True)
                    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                    found = cells(unit, tables, probes, scale)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("node").take(pa.array(rows)), part.column("copies").take(pa.array(rows)),
                         pa.array([u.tobytes() for u in unit], pa.binary()), pa.array([c.tobytes() for c in found], pa.binary()),
                         pa.array(found.reshape(len(rows), -1).tolist(), pa.list_(pa.int64()))],
                        ["node", "copies", "unit", "codes", "cells"],
                    )

    return vectors.mapInArrow(read, "node bigint, copies bigint, unit binary, codes binary, cells array<bigint>")


def _links(tables: int, probes: int, cosine: float):
    def one(table: pa.Table, a: np.ndarray, b: np.ndarray):
        node, weight = np.asarray(table.column("node")), np.asarray(table.column("copies"))
        raw = table.column("unit").to_pylist()
        if len({len(r) for r in raw}) > 1:
            raise ValueError("one cell holds vectors of different lengths")
        unit = np.frombuffer(b"".join(raw)).reshape(len(node), -1)
        cell = table.column("cell")[0].as_py()
        home = np.asarray(table.column("at_home"))
        near = (unit[a] @ unit[b].T >= cosine) & (home[a][:, None] | home[b][None, :])
        if a is b:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        if not len(i):
            return None
        i, j = a[i], b[j]
        codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.int64).reshape(len(node), tables, 1 + probes)
        first = _first_cell(codes, i, j, node) == cell
        links = np.zeros(len(node), np.int64)
        np.add.at(links, i[first], weight[j[first]])
        np.add.at(links, j[first], weight[i[first]])
        return node, links, blocks.stars(len(node), i, j)

    return one


def _first_cell(codes: np.ndarray, i: np.ndarray, j: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The first cell, by table, in which each pair meets: the home of the smaller node before the
    other one's."""
    swap = node[i] > node[j]
    a, b = codes[np.where(swap, j, i)], codes[np.where(swap, i, j)]
    out, open_ = np.zeros(len(i), np.int64), np.ones(len(i), bool)
    for t in range(codes.shape[1]):
        for own, other in ((a, b), (b, a)):
            meets = open_ & (own[:, t, :1] == other[:, t, :]).any(1)
            out[meets] = own[meets, t, 0]
            open_ &= ~meets
    return out


def near_vectors(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
    tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    A vector that is null, empty or zero, or has a null or non-finite component, links with
    nothing and is its own component. Vectors of different lengths are not compared. Equal vectors
    link with each other. Rows with a null id link with nothing, have no component and are kept.
    Rows that repeat an id are vectors of their own. Other columns are not read.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("embedding"))
    sound = F.col("vec_id").isNotNull() & F.coalesce(
        (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    # Adding 0.0 makes both zeros one; the hash names the vector.
    rows = rows.withColumn("node", F.when(sound, F.xxhash64(F.transform("embedding", lambda x: x + F.lit(0.0)))))
    classes = rows.filter("node is not null").groupBy("node").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    units = stash(_units(classes.select("node", "copies", "embedding"), tables, probes, scale))
    # A cell may be met as home and as probe of one vector only in different tables, never in one.
    places = units.select("node", F.posexplode("cells").alias("place", "cell")).select("cell", "node", (F.col("place") % (1 + probes) == 0).alias("at_home"))
    # Only cells where two vectors meet, one of them at home, have pairs; vectors travel to no others.
    met = stash(places.groupBy("cell").agg(F.count("*").alias("n"), F.max("at_home").alias("home")).filter("home and n > 1").select("cell", F.ceil(F.col("n") / block).alias("blocks")))
    members = blocks.dealt(places.join(met, "cell"), "node").join(units.select("node", "copies", "unit", "codes"), "node")
    found = stash(blocks.compare(members, "cell", _links(tables, probes, cosine)))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    group = components(found.filter("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    reach = classes.select("node", "least", "copies").join(links, "node", "left").join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = reach.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = reach.join(least, "component").select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    return rows.select("vec_id", "node").join(of_class, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
