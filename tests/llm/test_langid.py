import numpy as np
import pytest
from pyspark.sql import functions as F

from spanlog.llm import langid
from spanlog.llm.queries import QUERIES
from llm_fixtures import make_docs  # noqa: E402, F401

WORDS = {"aa": ["banana", "ananas", "nab", "abba", "na"], "zz": ["zozo", "ozzy", "zoo", "yoz", "oyo"]}


def sample(lang, n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang], n))


@pytest.fixture
def rows():
    out = [(i, sample(lang, 40, i), lang, "s") for i in range(60) for lang in [("aa", "zz")[i % 2]]]
    return out


def test_models_are_distributions(make_docs, rows):
    model = langid.train(make_docs(rows))
    assert model.langs == ["aa", "zz"]
    letters = sorted({c for _, t, *_ in rows for c in t})
    for context in ("   ", " ba", "ana", "ozz", "xqx", "zan"):
        keys = [sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context + x)) for x in letters]
        total = np.exp(model.log_probability(np.array(keys, np.uint64)).astype(float)).sum(axis=0)
        assert ((total > 0.9) & (total < 1.0001)).all()  # the rest is for letters never seen


def test_counts_equal_brute_force(make_docs):
    rows = [(1, "Ab, ab!", "aa", "s"), (2, "", "aa", "s"), (3, "B\x01b", "zz", "s"), (4, None, "aa", "s"), (5, "ab ab", None, "s")]
    want = {}
    for _, text, lang, _ in rows:
        if text is not None and lang is not None:
            clean = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
            line = "   " + (clean + " " if clean else " ")
            for i in range(3, len(line)):
                want[lang, line[i - 3:i + 1]] = want.get((lang, line[i - 3:i + 1]), 0) + 1
    src = make_docs(rows).select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    got = {}
    for r in langid.count_grams(src).collect():
        g = r["g"] % (1 << 64)
        gram = "".join(chr(g >> 16 * k & 0xFFFF) for k in (3, 2, 1, 0))
        got[r["lang"], gram] = got.get((r["lang"], gram), 0) + r["n"]
    assert got == want


def test_identify(make_docs, rows):
    odd = [(100, None, "aa", "s"), (101, "", None, "s"), (102, "12 !? \n", "aa", "s"), (103, sample("zz", 5, 1), None, "s"), (103, sample("zz", 5, 1), None, "s"),
           (None, "BANANA", "zz", "s"), (104, sample("aa", 30_000, 2), "aa", "s"), (105, "ж" * 400, None, "s")]
    out = langid.identify(make_docs(rows + odd), F.col("doc_id") < 60, keep=("doc_id", "lang", "score", "_h")).collect()
    assert len(out) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in out}
    assert all(by[i]["lang_pred"] == lang and 0 <= by[i]["score"] <= 1 and not by[i]["rejected"] for i, _, lang, _ in rows)
    for i in (100, 101, 102):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["rejected"]) == ("und", 0.0, True)
    assert by[103]["lang_pred"] == "zz" and by[None]["lang_pred"] == "aa" and by[104]["lang_pred"] == "aa"
    assert by[105]["lang_pred"] in ("aa", "zz") and by[105]["rejected"]
    none = langid.identify(make_docs(rows[:3]), F.lit(False)).collect()
    assert all(r["lang_pred"] == "und" and r["rejected"] for r in none)
    assert langid.identify(make_docs([]), F.lit(True)).count() == 0


def brute_logs(rows, gram):
    """Interpolated Kneser-Ney log-probabilities of a 4-gram per language, from dictionaries that hold every n-gram."""
    seen = {}
    for _, text, lang, _ in rows:
        line = "   " + text + " "
        for i in range(3, len(line)):
            own = seen.setdefault(lang, {}).setdefault(4, {})
            own[line[i - 3:i + 1]] = own.get(line[i - 3:i + 1], 0) + 1
    for orders in seen.values():
        for k in (3, 2, 1):
            orders[k] = {}
            for g in orders[k + 1]:
                orders[k][g[1:]] = orders[k].get(g[1:], 0) + 1
    alphabet = len({g for orders in seen.values() for g in orders[1]}) + 1
    out = []
    for lang in sorted(seen):
        p = 1 / alphabet
        for k in range(1, 5):
            counts, g = seen[lang][k], gram[4 - k:]
            ones, twos = (sum(n == v for n in counts.values()) for v in (1, 2))
            d = ones / (ones + 2 * twos) if ones else 0.5
            of = {x: n for x, n in counts.items() if x[:-1] == g[:-1]}
            if of:
                total = sum(of.values())
                kept = sum(max(n - d, 0) / total for n in of.values())
                p = max(of.get(g, 0) - d, 0) / total + min(max(1 - kept, 1e-9), 1) * p
        out.append(np.log(p))
    return out


def test_every_ngram_is_in_the_model(make_docs):
    rng = np.random.default_rng(3)
    many = "".join(chr(0x4E00 + c) for c in rng.integers(0, 20_000, 70_000))  # nearly 70,000 different 4-grams of one language
    rows = [(1, many, "aa", "s"), (2, "zozo ozzy zoo", "zz", "s"), (3, "zoo yoz", "zz", "s")]
    model = langid.train(make_docs(rows))
    stored = {r["k"]: r["n"] for r in model.grams.groupBy("k").count().withColumnRenamed("count", "n").collect()}
    lines = ["   " + t + " " for _, t, *_ in rows]
    assert stored == {k: len({line[i - k + 1:i + 1] for line in lines for i in range(3, len(line))}) for k in (1, 2, 3, 4)}
    wanted = [many[i:i + 4] for i in range(0, 69_000, 6_900)] + ["zoo ", "zozo", " ozx", "xqzo", many[5:7] + "zo"]
    keys = np.array([sum(ord(c) << 16 * (3 - i) for i, c in enumerate(g)) for g in wanted], np.uint64)
    assert np.allclose(model.log_probability(keys), [brute_logs(rows, g) for g in wanted], atol=1e-4)


def test_model_tables_are_few_files_however_many_shuffle_partitions(spark, make_docs, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, "".join(rng.choice(list("abcdefghijklmnopqrst"), 2000)), "aa", "s") for i in range(4)]
    want = langid.train(make_docs(rows))
    stored, files = langid.stored, {}

    def counted(df, name, **how):
        out = stored(df, name, **how)
        files[name] = len(out.inputFiles())
        return out

    most = 2 * spark.sparkContext.defaultParallelism
    many = {"spark.sql.shuffle.partitions": str(8 * most), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}
    monkeypatch.setattr(langid, "stored", counted)
    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        got = langid.train(make_docs(rows))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert set(files) == {"langid-grams", "langid-orders", "langid-shares", "langid-contexts"} and max(files.values()) <= most
    for name in ("grams", "contexts"):
        one, other = (sorted(map(tuple, getattr(m, name).collect())) for m in (want, got))
        assert len(one) == len(other) > 5000 // (1 + (name == "contexts")) and all(a[:2] == b[:2] and np.allclose(a[2], b[2]) for a, b in zip(one, other, strict=True))


def test_scores_do_not_depend_on_the_blocks(make_docs, rows):
    docs = make_docs(rows + [(200, None, "aa", "s"), (201, "", "aa", "s")])
    model = langid.train(docs)
    one, many = ({r["doc_id"]: r for r in langid.entropies(docs, model, ("doc_id", "text"), block=b).collect()} for b in (langid.BLOCK, 300))
    assert one.keys() == many.keys() and len(one) == len(rows) + 2
    assert all(one[i]["_n"] == many[i]["_n"] and (one[i]["_h"] is None) == (many[i]["_h"] is None) for i in one)
    assert all(np.allclose(one[i]["_h"], many[i]["_h"], atol=1e-6) for i in one if one[i]["_h"] is not None)
    assert one[200]["_h"] is None and one[201]["_h"] is None


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op1_language_id"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert out.where(~F.col("rejected")).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).head()[0] > 0.97
