import os
import sys

import pyarrow as pa
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as pipeline  # noqa: E402
from spanlog.llm import langid, pieces  # noqa: E402
from spanlog.llm.common import BATCHES, table  # noqa: E402
from test_secrets import brute as brute_secrets  # noqa: E402
from test_simhash import brute_classes, brute_fingerprint  # noqa: E402
from llm_fixtures import make_docs, make_table  # noqa: E402, F401

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    kept = pipeline.language_id(spark, docs, SF)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in given.items() if any(c.isalpha() for c in r["text"] or "")}

    one = pipeline.near_dedup(spark, docs, SF)
    ids = sorted(given)
    label = brute_classes([brute_fingerprint(given[i]["text"]) for i in ids], 3)
    assert rows(one) == sorted((tuple(given[ids[c]]) for c in set(label)), key=str)

    clean = {r["doc_id"]: r for r in pipeline.redact_secrets(spark, docs, SF).collect()}
    assert set(clean) == set(given)
    for i, r in clean.items():
        spans = brute_secrets(given[i]["text"])
        assert r["text"] == given[i]["text"] if not spans else r["n_chars"] == len(r["text"])

    mixed = pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == docs.columns and all(tuple(given[r["doc_id"]]) == tuple(r) for r in mixed.collect())

    lex = pieces.load()
    out = pipeline.encode_pieces(spark, docs, SF).collect()
    assert {r["doc_id"] for r in out} == set(given)
    assert all(pieces.decode_ids(r["pieces"][0]["ids"], lex) == given[r["doc_id"]]["text"] for r in out)


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert rows(pipeline.run(spark, SF)) == rows(docs)


def test_stages_on_odd_rows(spark, make_docs):
    text = "a text of some words that is repeated token=abcdef123456 and no more than that"
    odd = [(1, text, "en", "s"), (1, text, "en", "s"), (None, text, None, None), (2, None, "en", "s"), (3, "", "de", None), (4, "other words " * 9, None, "s")]
    for docs in (make_docs(odd), make_docs([])):
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, SF)
            n = out.count()
            assert n <= docs.count()
            if name != "encode_pieces":
                assert out.columns == docs.columns
            if name == "redact_secrets":
                assert n == docs.count() and out.where(F.col("text").contains("abcdef123456")).count() == 0
            if name == "near_dedup" and n:
                assert sorted(r["doc_id"] for r in out.collect()) == [1, 2, 4]


def test_language_stage_keeps_clean_documents_of_every_source(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert pipeline.language_id(spark, docs, SF).count() == docs.where(F.col("text").rlike(r"\p{L}")).count()
    assert langid.UNKNOWN == "und"


def test_workers_get_long_texts_in_batches_of_bounded_size(spark, make_table):
    long = spark.range(1500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 1000).alias("text")).coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"])

    def largest(df):
        got = df.mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r["rows"] for r in got) == 1500
        return max(r["bytes"] for r in got)

    def by_stage():
        return pipeline.own_names(lambda s, docs, sf_dir: docs)(spark, long, SF)  # as a caller's table reaches a stage

    path = make_table(documents=long)
    for read in (by_stage, lambda: table(spark, path, "documents")):
        for k in BATCHES:
            spark.conf.unset(k)
        assert largest(read()) < 4 << 20  # all rows, 16 MB, came as one batch
