import random
import re

import numpy as np
import xxhash

from spanlog.llm import simhash
from spanlog.llm.graph import connected_components
from llm_fixtures import make_docs  # noqa: E402, F401


def brute_fingerprint(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps, distance):
    """Smallest index reachable, per fingerprint."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= distance and label[j] > label[i]:
                    label[j], changed = label[i], True
    return label


def test_fingerprint_follows_its_definition():
    for text in ["", "  \t\n", "One", "one TWO", "a b c", "A b\x0bc\x0cd é É", "x " * 500, "ß Ä b c d"]:
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_every_close_pair_shares_an_index_entry_and_passes_its_chains():
    rng = random.Random(1)
    paths = [c for p in simhash.children((), 3) for c in simhash.children(p, 3)]
    masks = [a | b for a, b in paths]
    assert len(paths) == 16 and all((a & b) == 0 and (a | b).bit_count() == 28 for a, b in paths)
    for _ in range(3000):
        x = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(not x & m and simhash.linked(np.array([x], np.uint64), p, 3)[0] for m, p in zip(masks, paths, strict=True))
    far = np.array([0b1111 << 30], np.uint64)
    assert not any(simhash.linked(far, p, 3)[0] for p in paths)


def test_links_equal_brute_force_also_when_buckets_split(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(12)})
    label = brute_classes(fps, 3)
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    for bucket_rows in (2048, 8):
        got = connected_components(simhash.links(df, 3, bucket_rows)).collect()
        classes = {}
        for r in got:
            classes.setdefault(r["root"], set()).add(r["node"] % (1 << 64))
        want = {}
        for f, c in zip(fps, label, strict=True):
            want.setdefault(c, set()).add(f)
        assert sorted(map(sorted, classes.values())) == sorted(sorted(c) for c in want.values() if len(c) > 1)


def test_classes_with_nulls_copies_and_clashing_names(make_docs):
    text = "the quick brown fox jumps over the lazy dog again and again until night falls"
    rows = [(5, text, "en", "a"), (3, text.upper(), None, None), (9, None, "en", "a"), (8, "", "en", "a"), (None, text, "en", "a"), (5, text, "en", "a"),
            (7, "something else entirely, not close to any other text here", "en", "b"), (11, "w " * 50_000, "en", "b")]
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(make_docs(rows)).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 8), (8, 8), (None, 3), (5, 3), (7, 7), (11, 11)], key=str)
    kept = simhash.keep_one(make_docs(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 8, 11]
    assert simhash.near_duplicates(make_docs([])).count() == 0


def test_one_row_of_each_class_stays_whatever_its_id(make_docs):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(30)) for w in ("alpha", "beta", "gamma", "delta"))
    rows = [(7, a, "en", "s"), (7, b, "en", "s"), (3, a, "en", "s"),  # a repeated id on different texts
            (None, c, "en", "s"), (None, d, "en", "s"), (None, d, "en", "s"),  # classes of null ids only
            (None, a, "en", "s"), (9, "", "en", "s"), (9, None, "en", "s")]
    got = sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(make_docs(rows)).collect()), key=str)
    assert got == sorted([(3, a), (7, b), (None, c), (None, d), (9, None)], key=str)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 130)] + [(7, 7), (None, 3)] + [(1000, i) for i in range(1001, 1060)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 131)} | {i: 1000 for i in range(1000, 1060)}


def test_a_sieve_parts_rows_exactly_without_a_shuffle_of_them(spark):
    from pyspark.sql import functions as F
    from spanlog.llm.common import sieved
    df = spark.range(3000).select(F.when(F.col("id") % 7 > 0, F.col("id").cast("string").cast("binary")).alias("_key"), F.col("id").alias("text"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the keys were many
    try:
        for keys, bits in ((df.where("text % 100 = 3").select("_key"), 22), (df.where("text < 70").select("_key"), 8),
                           (df.limit(0).select("_key"), 22)):
            rest, asked = sieved(df, keys, "_key", bits)
            wanted = {None if r[0] is None else bytes(r[0]) for r in keys.collect()}
            a, b = ([(None if k is None else bytes(k), t) for k, t in x.collect()] for x in (rest, asked))
            assert sorted(t for _, t in a + b) == list(range(3000)) and not wanted & {k for k, _ in a}
            assert wanted <= {k for k, _ in b} and (bits < 22 or sum(k not in wanted for k, _ in b) <= 20)
            plan = rest._jdf.queryExecution().toString()
            assert (not wanted or "BroadcastHashJoin" in plan) and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_keep_one_shuffles_no_text_that_stays(spark):
    from pyspark.sql import functions as F
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.sha2((F.col("id") % 390 * 8 + i).cast("string"), 256) for i in range(8)]).alias("text"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = simhash.keep_one(df)
        assert sorted(r["doc_id"] for r in out.collect()) == list(range(390))
        staying = out._jdf.queryExecution().sparkPlan().children().head().toString()
        assert "BroadcastHashJoin" in staying and "SortMergeJoin" not in staying
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
