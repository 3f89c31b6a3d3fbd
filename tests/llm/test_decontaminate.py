import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from spanlog.llm import decontaminate as D
from spanlog.llm.queries import QUERIES
from llm_fixtures import make_docs, make_table  # noqa: F401

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, words string, len int, hash string"


def tokens(text):
    return WORD.findall((text or "").translate(str.maketrans(D.UPPER, D.LOWER)))


def brute(docs, items, size=10):
    out = []
    for doc_id, text in docs:
        w, hit, names = tokens(text), set(), set()
        for item_id, item in items:
            v = tokens(item)
            n = min(size, len(v))
            windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    names |= {str(item_id)} - {"None"}
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(4)
    vocabulary = ["Ab", "c2", "É", "été", "x", "YY", "z9", "日本", "né"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--", "_"]) for _ in range(n))
    long = text(60)
    items = [(1, long), (2, text(14)), (10, text(10)), (3, "Solo"), (4, "two Words"), (5, None), (6, " ,"), (None, text(12)), (7, long), (2, text(11)),
             (8, "x x x x x x x x x x x x")]
    docs = [(i, text(30) + items[i % 5][1] + text(5)) for i in range(20)]
    docs += [(20, None), (21, ""), (22, " .,"), (23, "SOLO"), (24, "é two\twords"), (25, "x " * 40), (None, long), (26, long.upper()), (26, long.upper()),
             (27, long[:40]), (28, text(3000)), (29, items[7][1]), (30, "solo " + text(4) + " solo"), (31, "...Two, words...")]
    return docs, items


def result(df):
    rows = df.select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ",").cast("binary"), 256), F.col("n_hit") > 0).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("set_rows", [20_000, 3])
def test_equals_brute_force_with_either_lookup(spark, make_docs, set_rows):
    docs, items = cases()
    d = make_docs([(i, t, "en", "s") for i, t in docs])
    b = spark.createDataFrame([(i, t, "?", 1, "?") for i, t in items], ITEMS)
    got = D.scan(d, b, set_rows=set_rows)
    assert result(got) == brute(docs, items)
    for r in got.collect():
        ranges = [(s["start"], s["end"]) for s in r["spans"]]
        assert ranges == sorted(ranges) and all(a[1] < z[0] for a, z in zip(ranges, ranges[1:]))


def test_query_on_tables(spark, make_docs, make_table):
    docs, items = cases()
    sf = make_table(documents=make_docs([(i, t, "en", "s") for i, t in docs]), benchmark=spark.createDataFrame(items, "item_id long, text string"))
    got = QUERIES["op12_decontaminate"](spark, sf).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], ITEMS)
    d = make_docs([(1, "a b", "en", "s"), (2, None, "en", "s")])
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in D.scan(d, none).orderBy("doc_id").collect()] == [(2, 0, []), (0, 0, [])]
    assert D.scan(make_docs([]), spark.createDataFrame([(1, "a b", "", 1, "")], ITEMS)).count() == 0


def test_removal_of_spans_and_documents(spark, make_docs):
    items = spark.createDataFrame([(1, "one two three", "", 0, "")], ITEMS)
    rows = [(1, "Start. ONE, two  three! End one two"), (2, "clean text"), (3, "one two three"), (4, None), (5, "one two three one two three, x"),
            (6, "(one two three) a one two three")]
    d = make_docs([(i, t, "en", "s") for i, t in rows])
    out = D.decontaminate(d, items)
    assert out.columns == d.columns
    assert [r["text"] for r in out.orderBy("doc_id").collect()] == ["Start. End one two", "clean text", "", None, "x", "(a "]
    assert [r["doc_id"] for r in D.decontaminate(d, items, remove="documents").orderBy("doc_id").collect()] == [2, 4]
    with pytest.raises(ValueError):
        D.decontaminate(d, items, remove="all")
