"""Registered queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, codes, decontaminate, extract, langid, mixing, negatives, pieces, quality, secrets, simhash, substrings, topk
from .common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by models learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    out = langid.identify(docs, ~F.col("held_out"), keep=("doc_id", "held_out"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, by a model fitted on labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out().alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "quality")
    model = quality.train(docs.where(~F.col("held_out")), labels)
    out = quality.score(docs, model, keep=("doc_id", "held_out"))
    return out.withColumn("predicted", quality.predicted(F.col("score")))


@query
def op3_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vec_id divisible by 20."""
    out = ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
    return out.select("query_id", "rank", "vec_id", "score")


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, judged by corpus-wide ownership."""
    base = ("assign", "access", "hex")
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[number(k) for k in base],
                        F.sha2(secrets.spans_text(F.col("spans"), base).cast("binary"), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: s["verdict"] == "live")).cast("long").alias("n_live"),
                        F.size(F.filter("spans", lambda s: s["verdict"] == "example")).cast("long").alias("n_example"))


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 3 best segmentations of every document, as digests, and whether the best decodes to the text."""
    out = pieces.encode(table(spark, sf_dir, "documents"), n=3, digests=True)
    best = F.get("pieces", F.lit(0))
    return out.select("doc_id", best["n_pieces"].alias("n_pieces"), best["score"].alias("score"), best["sha256"].alias("ids_sha256"), "exact",
                      F.size("pieces").alias("n_best"),
                      F.array_join(F.transform("pieces", lambda p: p["score"].cast("string")), ",").alias("scores"),
                      F.array_join(F.transform("pieces", lambda p: p["sha256"]), ",").alias("sha256s"))


@query
def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    out = extract.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_open")


@query
def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products for every vec_id divisible by 20."""
    out = topk.top(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
    return out.select("query_id", "rank", "vec_id", "score")


ORACLE["op7_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(list_zip(q.x, v.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id AND len(q.x) = len(v.x)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents raked to tempered source, language and topic shares, with the sampling decision."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    docs = docs.withColumn("tokens", mixing.words(F.col("text")))
    margins = {"source": F.col("source"), "language": F.col("lang"), "topic": mixing.length_class(F.col("tokens"))}
    out = mixing.mix(docs, margins, F.col("tokens"))
    return out.select("doc_id", F.col("mix_source").alias("source"), F.col("mix_language").alias("language"),
                      F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"),
                      F.round("mix_factor", 9).alias("factor"), F.round("mix_probability", 9).alias("probability"),
                      F.col("mix_sampled").alias("sampled"))


ORACLE["op8_mix_sources"] = mixing.oracle()


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate classes of all documents."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes covered by 100-byte strings that start earlier."""
    out = substrings.deduplicate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code of 8 parts by codebooks of 16 entries, with its error and its label's."""
    out = codes.compress(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


ORACLE["op11_vector_codes"] = codes.oracle()


@query
def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that lie in 10-word windows of the benchmark."""
    out = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE["op12_decontaminate"] = decontaminate.ORACLE


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every vec_id divisible by 100 its positives and their hard negatives; every seventh row carries the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLE["op13_hard_negatives"] = negatives.ORACLE
