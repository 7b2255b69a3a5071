"""The pipeline's stages on their own input, and its whole run."""

import collections
import hashlib

import corpus_pipeline
from rental_mart.llm import bpe, jaccard, secrets, toxicity
from rental_mart.llm.queries import vocabulary_path
from rental_mart.llm.tables import table

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "secrets", "mixing", "bpe"]


def test_pipeline(spark):
    from tokenizers import Tokenizer

    docs = table(spark, SF, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    toxic = {r["doc_id"] for r in toxicity.grade(docs, toxicity.fit(docs, table(spark, SF, "labels"))).collect() if r["toxic"]}
    kept = corpus_pipeline.reject_toxic(spark, docs, SF)
    assert {r["doc_id"] for r in kept.collect()} == set(rows) - toxic and kept.columns == docs.columns

    groups = jaccard.join(docs).collect()
    one = corpus_pipeline.one_of_each(spark, docs, SF)
    assert {r["doc_id"] for r in one.collect()} == {r["component_id"] for r in groups}

    clean = corpus_pipeline.scan_secrets(spark, docs, SF).collect()
    allow = [secrets.re.compile(a) for a in secrets.ALLOW]
    for r in clean:
        assert (r["text"] == rows[r["doc_id"]]["text"]) == (not secrets.find(rows[r["doc_id"]]["text"], allow))
        assert r["n_chars"] == len(r["text"])

    mixed = corpus_pipeline.mix(spark, docs, SF)
    assert mixed.columns == docs.columns
    tok = Tokenizer.from_file(vocabulary_path())
    texts = sorted((r["doc_id"], tok.encode(r["text"], add_special_tokens=False).ids) for r in mixed.collect())
    encoded = corpus_pipeline.encode(spark, mixed, SF).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in encoded) == texts
    for r in encoded[:20]:
        assert r["decoded_sha256"] == hashlib.sha256(tok.decode(r["ids"], skip_special_tokens=False).encode()).hexdigest()


def test_one_of_each_with_repeated_ids(spark):
    def text(k):
        return " ".join(f"w{k}x{i}" for i in range(60))

    rows = [
        (1, text(1)), (2, text(1)), (2, text(2)),  # one id, one text a copy, the other its only one
        (3, text(3)), (3, text(3)), (3, text(3)),  # repeated rows
        (4, text(4)), (4, text(5)), (5, text(5) + " end"), (5, text(4) + " end"),  # two groups of the same ids
        (6, text(6)), (6, text(6) + " end"), (6, text(6).replace(" ", "\n")),  # one id's texts in one group
        (None, text(1)), (None, text(1)), (7, " \t"), (7, " \t"), (8, None),  # link with nothing
    ]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for parts in (1, 3):
        got = collections.Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each(spark, docs.repartition(parts), SF).collect())
        six = [k for k in got if k[0] == 6]
        assert len(six) == 1 and got.pop(six[0]) == 1
        assert got == collections.Counter([
            (1, text(1)), (2, text(2)), (3, text(3)), (4, text(4)), (4, text(5)),
            (None, text(1)), (None, text(1)), (7, " \t"), (7, " \t"), (8, None),
        ])


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert rows and all(r["n_tokens"] == len(r["ids"]) for r in rows)


def test_one_worker_a_task_in_bpe(spark):
    docs = table(spark, SF, "documents").limit(3)
    encoded = corpus_pipeline.encode(spark, docs, SF)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # two in one task are two worker processes for each core
    ids = "concat_ws(' ', ids)"
    both = {(r["doc_id"], r["i"]) for r in bpe.encode(docs, vocabulary_path()).selectExpr("doc_id", f"{ids} i").collect()}
    assert {(r["doc_id"], r["i"]) for r in encoded.selectExpr("doc_id", f"{ids} i").collect()} == both


def test_stages_take_empty_and_odd_rows(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (5, "", "en", None, 0), (5, "", "en", None, 0), (6, None, None, "x", None)], docs.schema)
    for some in (odd, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, some, SF).collect()
