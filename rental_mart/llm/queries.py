"""One registered query for each operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rental_mart.llm import align, bpe, chat, jaccard, lattice, lines, lm, mixing, prefixes, quality, secrets, substrings, toxicity
from rental_mart.llm.tables import table


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path()
    ids = bpe.encode(table(spark, sf_dir, "documents"), path, cached_words=150_000)
    named = ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), "ids",
    )
    return bpe.decode(named, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "<|im_end|><|im_start|>assistant ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_turns(turns.unionByName(more)))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    graded = toxicity.grade(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return graded.select("doc_id", "severity", "grade", "toxic")


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op7_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def _joined(spans: F.Column) -> F.Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans"), n("entropy"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut_out = substrings.dedup(table(spark, sf_dir, "documents"))
    return cut_out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return prefixes.trie(prefixes.rebuilt(prefixes.sequences(turns)))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align.alignment(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_chat": op2_chat,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_lm": op5_lm,
    "op6_jaccard": op6_jaccard,
    "op7_lattice": op7_lattice,
    "op8_secrets": op8_secrets,
    "op9_quality": op9_quality,
    "op10_substrings": op10_substrings,
    "op11_lines": op11_lines,
    "op12_prefixes": op12_prefixes,
    "op13_align": op13_align,
}

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = lines.UPPER, lines.LOWER

#: A list of bytes, folded with the table of CRC-32; the table is 8 steps for each byte value.
_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"

ORACLE: dict[str, str] = {
    "op11_lines": f"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS every FROM documents),
each AS (SELECT row, doc_id, unnest(every) AS line, unnest(range(len(every))) AS place FROM docs),
keyed AS (SELECT *, translate(trim(line, {_WHITE}), '{_UPPER}', '{_LOWER}') AS key FROM each),
repeated AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
told AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.last AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM told GROUP BY row, doc_id""",
    "op12_prefixes": f"""WITH crc AS (SELECT {_CRC_TABLE} AS steps),
own AS (SELECT conv_id, list(struct_pack(role := coalesce(role, ''), txt := coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
bytes AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS id, s FROM own),
hashed AS (SELECT conv_id, s, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(id) + 1), lambda i: CAST(ascii(substr(id, i, 1)) AS BIGINT))),
  lambda c, b: xor(c // 256, steps[xor(c, b) % 256 + 1])), 4294967295) % 9 AS h FROM bytes, crc),
built AS (SELECT c.conv_id, list_concat(CASE WHEN b.s IS NULL THEN c.s[1:0] ELSE b.s[1:c.h] END, c.s[c.h + 1:]) AS s
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
prefix AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS depth FROM built),
node AS (SELECT s[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(s) = depth), '') AS ends FROM prefix GROUP BY s[1:depth], depth),
kids AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
own_share AS (SELECT o.path, o.depth, CAST(k.n IS NULL AS BIGINT) AS leaf,
  CASE WHEN o.depth = 0 THEN 0 ELSE (o.n_convs - 1) * strlen(o.path[o.depth].txt) END AS saved
  FROM node o LEFT JOIN kids k ON o.path = k.path AND o.depth = k.depth),
above AS (SELECT path, leaf, saved, unnest(range(depth + 1)) AS depth FROM own_share),
below AS (SELECT path[1:depth] AS path, depth, sum(leaf) AS leaves, sum(saved) AS saved FROM above GROUP BY ALL)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, coalesce(k.n, 0) AS n_children,
  CAST(u.leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, sha256(o.ends) AS ends_sha256
FROM node o JOIN below u ON o.path = u.path AND o.depth = u.depth
LEFT JOIN kids k ON o.path = k.path AND o.depth = k.depth
LEFT JOIN node p ON o.depth > 0 AND p.depth = o.depth - 1 AND p.path = o.path[1:o.depth - 1]""",
}
