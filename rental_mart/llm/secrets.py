"""Secret scans: known formats, and runs of high entropy inside candidate strings.

Known formats are regular expressions. A candidate string is a run of key characters; a window
slides over it with incremental character counts, and the Shannon entropy of each window is held
against the threshold of the window's character class. Windows that pass merge into one span. What
an allow-list names in a candidate ends it there: windows that overlap it don't count, and a key
next to it is found as it would be alone. Spans of known formats are never suppressed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart.llm.words import slices
from rental_mart.llm.worker import task

# The known formats, in listing order, and their least lengths.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "entropy")
# End of fixed values.

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Least bits for each character in a window, by the classes of characters in it. A window of
#: letters of one case is a word or a compound, never a key.
BITS = {"digits": 3.1, "hex": 3.2, "case+digit": 3.5, "letters": 4.0, "mixed": 3.7}
ALLOW = (
    r"(?i)example|sample|placeholder|changeme|dummy|your[_-]?",
    r"(.)\1{7}",
    r"0123456789|(?i:abcdefghij)",
    r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
    r"[-_=+/]{6}",
)
#: One more than a window holds: a character is added before the one that leaves is taken off.
_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _kind_of(c: str) -> int:
    """0: a to f, 1: another small letter, 2: a capital, 3: a digit, 4: a sign."""
    return 3 if c.isdigit() else 2 if c.isupper() else (0 if c <= "f" else 1) if c.isalpha() else 4


def _least_bits(n: list[int]) -> float:
    hexa, small, capital, digit, sign = n
    if digit and not (small or capital or sign):
        return BITS["hex" if hexa else "digits"]
    if not digit:
        return BITS["letters"] if capital > 2 and hexa + small > 2 else math.inf
    if sign:
        return BITS["mixed"]
    return BITS["case+digit"]


def entropy_spans(candidate: str, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged windows of a candidate string whose entropy reaches their class's threshold."""
    counts: dict[str, int] = {}
    classes, held, out = [0] * 5, 0.0, []
    for i, c in enumerate(candidate):
        k = counts.get(c, 0)
        held += _TERM[k + 1] - _TERM[k]
        counts[c] = k + 1
        classes[_kind_of(c)] += 1
        if i >= window:
            old = candidate[i - window]
            k = counts[old]
            held += _TERM[k - 1] - _TERM[k]
            counts[old] = k - 1
            classes[_kind_of(old)] -= 1
        if i >= window - 1 and math.log2(window) - held / window >= _least_bits(classes):
            lo = i - window + 1
            if out and lo <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((lo, i + 1))
    return out


def open_parts(candidate: str, allow: list[re.Pattern], least: int = WINDOW) -> list[tuple[int, int]]:
    """The parts of a candidate string that no pattern of the allow-list covers, if long enough."""
    at, out = 0, []
    for lo, hi in [*sorted(m.span() for a in allow for m in a.finditer(candidate)), (len(candidate), len(candidate))]:
        if lo - at >= least:
            out.append((at, lo))
        at = max(at, hi)
    return out


def find(text: str, allow: list[re.Pattern]) -> list[tuple[str, int, int]]:
    """All spans of a text, in order of start, then kind as listed."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        run = m[0]
        # Words and compounds make up nearly all candidates of a plain text.
        if run[1:].islower() and run.isalpha():
            continue
        if not entropy_spans(run):
            continue
        for at, end in open_parts(run, allow):
            found += [("entropy", m.start() + at + lo, m.start() + at + hi) for lo, hi in entropy_spans(run[at:end])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(df: DataFrame, text_col: str = "text", out_col: str = "secrets", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """All columns, with the spans of secrets in the whole text (code points, end exclusive).

    A null or empty text has none. Repeated rows each give their row. An input column that has the
    name of ``out_col`` is replaced.
    """
    rest = [c for c in df.columns if c != out_col]
    out = T.StructType([*df.select(*rest).schema.fields, T.StructField(out_col, SPANS)])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    @task("secrets")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = [re.compile(a) for a in allow]
        for batch in batches:
            for part in slices(batch, text_col):
                found = [
                    [dict(zip(("kind", "start", "end"), s)) for s in find(t, allowed)] if t else []
                    for t in part.column(text_col).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(found, arrow)], [*rest, out_col])

    return df.select(*rest).mapInArrow(run, out)


def redact(df: DataFrame, text_col: str = "text", spans_col: str = "secrets", mark: str = "[SECRET]") -> DataFrame:
    """Replaces every found span by a mark; spans that overlap become one. Drops the spans."""
    pieces = F.aggregate(
        F.col(spans_col),
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["text"]).otherwise(
                F.concat(acc["text"], F.substr(F.col(text_col), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))
            ).alias("text"),
        ),
        lambda acc: F.concat(acc["text"], F.substr(F.col(text_col), (acc["at"] + 1).cast("int"), F.length(text_col))),
    )
    clean = F.when(F.size(spans_col) > 0, pieces).otherwise(F.col(text_col))
    return df.withColumn(text_col, clean).drop(spans_col)
