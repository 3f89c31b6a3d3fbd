"""A training-data pipeline over ``documents``: language ID, near-dedup, secret redaction, source mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame; all but the last return
the columns of ``documents``. ``run`` writes every stage's result as Parquet to the shared folder and reads it back, so a lost
executor costs no more than one stage. Nulls, empty texts, repeated rows and empty tables follow the operators' docstrings.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlog.llm import langid, mixing, pieces, secrets, simhash
from spanlog.llm.common import held_out, short_batches, sieved, stored, table

#: The stages cannot be said in SQL: language models, XXH64 fingerprints and piece lattices are tested by brute force.
ORACLE_SQL = None


#: The columns of ``documents``; others pass through every stage but the last.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def own_names(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Runs a stage with other columns under names that cannot clash with its own, and names them back.

    Spark gives back shuffle files, broadcasts and the memory of finished plans when the driver's collectors find them unused;
    both are asked to look before a stage starts, since a stage can be shorter than their own intervals."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        gc.collect()
        spark._jvm.System.gc()
        short_batches(spark)  # a stage may be called with a table that this package did not read
        safe = [c if c in COLUMNS else f"_other{i}" for i, c in enumerate(docs.columns)]
        back = dict(zip(safe, docs.columns, strict=True))
        out = stage(spark, docs.toDF(*safe), sf_dir)
        return out.toDF(*[back.get(c, c) for c in out.columns])
    return run


@own_names
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised; learns as op1 does."""
    out = langid.identify(docs, ~held_out(), keep=tuple(docs.columns))
    return out.where(~F.col("rejected")).select(*docs.columns)


@own_names
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash class (3-word shingles, up to 3 bits), the one with the smallest id."""
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, distance=simhash.DISTANCE).select(*docs.columns)


@own_names
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret that is not a widely copied example; keeps every document. ``n_chars`` follows the new text."""
    key = F.xxhash64("doc_id", "text")  # a row's own spans, whatever ids repeat
    found = secrets.scan(docs.withColumn("_key", key), id_col="_key").where(F.size("spans") > 0).dropDuplicates(["doc_id"])
    found = stored(found.select(F.col("doc_id").alias("_key"), F.filter("spans", lambda s: s["verdict"] != "example").alias("_spans")), "secrets-found")
    rest, asked = sieved(docs.withColumn("_key", key), found, "_key")  # only texts that may hold a secret meet the spans
    text = F.when(F.size("_spans") > 0, secrets.redact(F.col("text"), F.col("_spans"))).otherwise(F.col("text"))
    out = asked.join(found, "_key", "left").withColumn("_text", text)
    size = F.when(F.size("_spans") > 0, F.length("_text").cast("long")).otherwise(F.col("n_chars"))
    return rest.select(*docs.columns).unionByName(out.withColumns({"text": F.col("_text"), "n_chars": size}).select(*docs.columns))


@own_names
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that token weights follow tempered source, language and length-class shares."""
    rows = docs.withColumn("_tokens", mixing.words(F.col("text")))
    margins = {"source": F.col("source"), "language": F.col("lang"), "topic": mixing.length_class(F.col("_tokens"))}
    return mixing.mix(rows, margins, F.col("_tokens")).where("mix_sampled").select(*docs.columns)


@own_names
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, n_pieces, pieces): the 3 best segmentations of each kept document."""
    out = pieces.encode(docs, keep=("doc_id", "source", "lang"), n=3)
    return out.select("doc_id", "source", "lang", F.size(F.get("pieces", F.lit(0))["ids"]).alias("n_pieces"), "pieces")


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("redact_secrets", redact_secrets),
          ("mix_sources", mix_sources), ("encode_pieces", encode_pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
