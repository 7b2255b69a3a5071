"""Line dedup on DataFrame functions alone: keep bitmaps of documents' lines.

A line's key is the line without white space at its ends and with A-Z in lower case; two 64-bit
hashes stand for it. Keys of at least ``min_chars`` code points are range-partitioned by hash and
document and sorted by hash, then document (the largest first) and position, so that the first row
of a key is its first occurrence in that order; the sorted rows stream through aggregates that hold
one key at a time. A key that many documents hold is spread over ranges by document, and only its
partial counts meet.

Keys in at least ``min_docs`` documents lose all their lines but those of the document that comes
first, the one with the largest id. The result is a bitmap of lines to keep for each text that loses
some, never text: words of 64 lines, in which words that keep every line are left out.

Null and empty texts have one empty line. Rows that share an id are one document; rows without an id
are one document too, which comes after all others. Rows that repeat id and text share their bitmap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rental_mart.llm.graph import stash

#: Fixed values of the key's rule.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_LINES = 64  # 2^6


def line_key(line: Column) -> Column:
    bare = F.trim(line, F.lit(WHITE))
    # lower() is quick, and changes nothing but A-Z where all characters are single bytes.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _lines(text: Column | str) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, text name, position, h1, h2) of all lines whose key is long enough."""
    each = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("name"), F.posexplode(_lines(F.col(text_col))).alias("at", "line"),
    )
    # The key has as many code points as the line without white space.
    each = each.filter(F.char_length("line") >= min_chars).withColumn("line", line_key(F.col("line"))).filter(F.char_length("line") >= min_chars)
    return each.select("id", "name", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def counted_keys(lines: DataFrame) -> DataFrame:
    """(h1, h2, n_docs, first_id, first_at): how many documents hold a key, and its first place."""
    ranged = lines.select("h1", "h2", "id", "at").repartitionByRange("h1", "h2", F.desc("id")).sortWithinPartitions("h1", "h2", F.desc("id"), "at")
    # Both groupings go along the sorted rows; the first needs no shuffle, its rows being together.
    held = ranged.groupBy("h1", "h2", "id").agg(F.min(F.struct("at")).alias("first"))
    counted = held.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max(F.struct("id", "first")).alias("top"))
    return counted.select("h1", "h2", "n_docs", F.col("top.id").alias("first_id"), F.col("top.first.at").alias("first_at"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(id, name, n_dropped, bitmap) of the texts that lose lines; ``name`` is the text's hash."""
    lines = keyed_lines(docs, id_col, text_col, min_chars)
    repeated = stash(counted_keys(lines).filter(F.col("n_docs") >= min_docs).select("h1", "h2", "first_id"))
    lost = lines.join(repeated, ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("first_id")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % WORD_LINES).cast("int"))
    words = lost.groupBy("id", "name", F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("gone"))
    entry = F.struct("word", F.bitwise_not("gone").alias("keep"))
    return stash(
        words.groupBy("id", "name").agg(F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"), F.array_sort(F.collect_list(entry)).alias("bitmap"))
    )


def _dense(bitmap: str) -> Column:
    """Words of the bitmap up to the last one that loses a line, kept ones filled in."""
    def filled(entry: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(F.col(bitmap), i - 1)["word"]).otherwise(F.lit(-1))
        return F.concat(F.array_repeat(F.lit(-1).cast("long"), entry["word"] - before - 1), F.array(entry["keep"]))

    return F.flatten(F.transform(bitmap, filled))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row for each input row: its id, n_lines (before), n_dropped, the bitmap (null where all
    lines stay) and kept_text. Other columns are not read, whatever their names."""
    found = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs).withColumn("dense", _dense("bitmap"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    joined = rows.join(found, F.col("_id").eqNullSafe(F.col("id")) & (F.xxhash64("_text") == F.col("name")), "left")

    def kept(_: Column, at: Column) -> Column:
        word = F.coalesce(F.get(F.col("dense"), F.shiftright(at, 6)), F.lit(-1).cast("long"))
        return F.call_function("shiftrightunsigned", word, (at % WORD_LINES).cast("int")).bitwiseAND(F.lit(1)) == 1

    text = F.coalesce("_text", F.lit(""))
    short = F.array_join(F.filter(_lines(text), kept), "\n")
    return joined.select(
        F.col("_id").alias(id_col),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "bitmap",
        F.when(F.col("bitmap").isNull(), text).otherwise(short).alias("kept_text"),
    )
