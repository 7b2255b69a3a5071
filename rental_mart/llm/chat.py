"""Chat formatting: turns -> templated text with a loss mask, and back.

A turn reads ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``. Inside roles and texts every ``<``,
backslashes, ``|`` gets one more backslash, so no control string can occur there and unescaping
restores the text exactly; in a role, line feeds and backslashes are escaped too.

Turns are dealt by range of (conversation, turn), so a very long conversation is spread over tasks;
each Arrow batch gives one part for each conversation in it. Parts of a conversation are in order
by ``part``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rental_mart.llm.words import slices, text_bytes

START, MIDDLE, END = b"<|im_start|>", b"\n", b"<|im_end|>\n"
TRAINED = "assistant"
PARTS = "conv_id bigint, part bigint, n_turns bigint, formatted string, loss_start array<bigint>, loss_bytes array<bigint>"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, pattern=r"<(\\*)\|", replacement=r"<\1\\|")


def unescape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, pattern=r"<(\\*)\\\|", replacement=r"<\1|")


def _escape_role(roles: pa.Array) -> pa.Array:
    plain = pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n")
    return escape(plain)


def _unescape_role(role: str) -> str:
    role = unescape(pa.array([role]))[0].as_py()
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)


def _fill(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Scatters variable pieces of ``data`` to the positions ``at`` of the output buffer."""
    sizes = np.diff(offsets)
    out[np.arange(len(data)) + np.repeat(at - offsets[:-1], sizes)] = data


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all turns: the bytes, where each turn begins, and each text's place in it."""
    role_data, role_at = text_bytes(_escape_role(roles))
    data, text_at = text_bytes(escape(texts))
    role_size, text_size = np.diff(role_at), np.diff(text_at)
    turn = np.concatenate([[0], np.cumsum(len(START) + role_size + len(MIDDLE) + text_size + len(END))])
    role_to = turn[:-1] + len(START)
    text_to = role_to + role_size + len(MIDDLE)
    out = np.empty(turn[-1], np.uint8)
    for fixed, to in ((START, turn[:-1]), (MIDDLE, role_to + role_size), (END, text_to + text_size)):
        out[to[:, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
    _fill(out, role_to, role_data, role_at)
    _fill(out, text_to, data, text_at)
    return out, turn, text_to, text_size


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows -> formatted parts with the loss mask over assistant texts.

    A null role or text counts as empty; null conversation ids form one conversation and null
    turns come first. Turns with equal numbers follow by role, then text; repeated rows stay.
    Other columns are not read. ``loss_start`` and ``loss_bytes`` are byte positions in the part.
    """
    src = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    dealt = src.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in slices(batch, "text"):
                out, turn, at, size = assemble(piece.column("role"), piece.column("text"))
                trained = np.asarray(pc.equal(piece.column("role"), TRAINED).fill_null(False))
                ids = piece.column("conv_id").to_pylist()
                edges = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
                rows = []
                for lo, hi in zip(edges, edges[1:]):
                    mine = lo + np.flatnonzero(trained[lo:hi])
                    rows.append((ids[lo], part, hi - lo, out[turn[lo] : turn[hi]].tobytes().decode(), (at[mine] - turn[lo]).tolist(), size[mine].tolist()))
                    part += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                    ["conv_id", "part", "n_turns", "formatted", "loss_start", "loss_bytes"],
                )

    return dealt.mapInArrow(run, PARTS)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted part."""
    pieces = formatted.split(START.decode())[1:]
    pairs = [p[: -len(END)].split("\n", 1) for p in pieces]
    if not pairs:
        return []
    texts = unescape(pa.array([t for _, t in pairs], pa.string())).to_pylist()
    return [(_unescape_role(r), t) for (r, _), t in zip(pairs, texts)]


def digest(parts: DataFrame) -> DataFrame:
    """Reads formatted parts back: turns, and what lies under the loss mask, as digests.

    A digest of a whole conversation has to see its bytes in order, so the parts of one
    conversation meet in one task; they stream through it, sorted, and only the running hashes are
    held in memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, turns, loss, counts = None, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]

        def row() -> pa.RecordBatch:
            cols = [now[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]]
            return pa.RecordBatch.from_pylist([dict(zip(DIGEST.names, cols))], DIGEST)

        for batch in batches:
            for one in batch.to_pylist():
                if now is not None and now[0] != one["conv_id"]:
                    yield row()
                    turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                now = (one["conv_id"],)
                for role, text in parse(one["formatted"]):
                    turns.update(f"{role}\n{text}\n".encode())
                    counts[0] += 1
                raw = one["formatted"].encode()
                masked = [raw[a : a + n].decode() for a, n in zip(one["loss_start"], one["loss_bytes"])]
                for text in unescape(pa.array(masked, pa.string())).to_pylist():
                    loss.update(text.encode())
                    counts[1] += len(text)
                counts[2] += len(one["formatted"])
        if now is not None:
            yield row()

    sorted_parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return sorted_parts.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])
