import numpy as np
from pyspark.sql import functions as F

from spanlog.llm import mixing
from llm_fixtures import make_docs  # noqa: E402, F401


def raked(cells, goals, rounds):
    """Plain iterative proportional fitting: cells as {(values): weight}, goals per margin as {value: share}."""
    total = sum(cells.values())
    factor = {c: 1.0 for c in cells}
    for _ in range(rounds):
        for i, goal in enumerate(goals):
            now = {}
            for c, w in cells.items():
                now[c[i]] = now.get(c[i], 0) + w * factor[c]
            whole = sum(goal.get(v, 0) for v in now)
            for c in cells:
                if now[c[i]] > 0:
                    factor[c] *= goal.get(c[i], 0) / whole * total / now[c[i]]
    return factor


def test_raking_meets_the_targets(spark):
    rng = np.random.default_rng(2)
    cells = {(a, b, c): int(rng.integers(1, 1000)) for a in ("x", "y", None) for b in ("p", "q") for c in ("1", "2", "3")}
    goals = [{"x": 0.2, "y": 0.5, None: 0.3}, {"p": 0.9, "q": 0.1, "absent": 3.0}, {"1": 1.0, "2": 1.0, "3": 2.0}]
    df = spark.createDataFrame([(*k, w) for k, w in cells.items()], "a string, b string, c string, w long")
    targets = {m: spark.createDataFrame(list(g.items()), "value string, share double") for m, g in zip("abc", goals, strict=True)}
    got = {(r["a"], r["b"], r["c"]): r["factor"] for r in mixing.rake(df, ["a", "b", "c"], targets, rounds=12).collect()}
    want = raked(cells, goals, 12)
    assert set(got) == set(want) and all(abs(got[c] - want[c]) < 1e-9 * max(1, want[c]) for c in want)
    share = sum(w * got[c] for c, w in cells.items() if c[1] == "p") / sum(w * got[c] for c, w in cells.items())
    assert abs(share - 0.9) < 0.01


def test_mix_of_odd_rows(make_docs):
    rows = [(i, "w " * (5 + i), ["en", "de", None][i % 3], ["a", None][i % 2]) for i in range(300)] + [(1000, None, None, None), (1001, "", "en", "a"),
            (None, "x y", "en", "a"), (7, "w " * 12, "de", None), (1002, "word " * 60_000, "fr", "a")]
    docs = make_docs(rows).withColumn("_t", mixing.words(F.col("text")))
    margins = {"source": F.col("source"), "language": F.col("lang"), "topic": mixing.length_class(F.col("_t"))}
    out = mixing.mix(docs, margins, F.col("_t"))
    got = out.collect()
    assert len(got) == len(rows) and set(docs.columns) <= set(out.columns)
    assert all(0 <= r["mix_probability"] <= 1 for r in got)
    total = sum(r["mix_tokens"] for r in got)
    assert abs(sum(r["mix_tokens"] * r["mix_probability"] for r in got) / total - mixing.BUDGET) < 0.02
    again = {(r["doc_id"], r["text"]): r["mix_sampled"] for r in mixing.mix(docs, margins, F.col("_t")).collect()}
    assert all(again[r["doc_id"], r["text"]] == r["mix_sampled"] for r in got)
    assert mixing.mix(make_docs([]), {"source": F.col("source")}, F.lit(1)).count() == 0


def test_the_plan_is_native(make_docs):
    docs = make_docs([(1, "a b", "en", "s")])
    plan = mixing.mix(docs, {"source": F.col("source")}, mixing.words(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_expected_tokens_meet_the_targets_though_probabilities_end_at_one(spark):
    """Value 'z' asks for more than it has: it gives everything, the others share the rest; every other margin is met within 0.1 %."""
    cells = [(a, b, (200 if b == "p" else 300) if a != "z" else 5) for a in ("x", "y", "z", None) for b in ("p", "q", "r")]
    df = spark.createDataFrame(cells, "a string, b string, w long")
    targets = {"a": spark.createDataFrame([("x", 0.4), ("y", 0.2), ("z", 0.3), (None, 0.1)], "value string, share double"),
               "b": spark.createDataFrame([("p", 0.3), ("q", 0.3), ("r", 0.4)], "value string, share double")}
    raked = mixing.rake(df, ["a", "b"], targets, rounds=20, budget=0.4)
    total = sum(w for *_, w in cells)
    got = {(r["margin"], r["value"]): r for r in mixing.achieved(raked, ["a", "b"]).collect()}
    assert len(got) == 7
    for r in got.values():
        assert r["goal"] <= r["tokens"] + 1e-9 and abs(r["expected"] / r["goal"] - 1) < 1e-3
    assert got["a", "z"]["expected"] == 15
    left = 0.4 * total - 15
    assert abs(got["a", "x"]["expected"] / left - 4 / 7) < 1e-3 and abs(got["a", None]["expected"] / left - 1 / 7) < 1e-3
    assert abs(got["b", "r"]["expected"] / (0.4 * total) - 0.4) < 1e-3


def test_sampled_margins_of_the_given_documents(spark):
    """Sampled token shares of the smallest table's documents lie where their goals are, up to the chance of sampling."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.withColumn("_t", mixing.words(F.col("text")))
    margins = {"source": F.col("source"), "language": F.col("lang"), "topic": mixing.length_class(F.col("_t"))}
    out = mixing.mix(rows, margins, F.col("_t")).cache()
    total = out.agg(F.sum("mix_tokens")).head()[0]
    assert abs(out.agg(F.sum(F.col("mix_tokens") * F.col("mix_probability"))).head()[0] / total - mixing.BUDGET) < 1e-3
    for name in margins:
        of = out.groupBy(f"mix_{name}").agg(F.sum("mix_tokens").alias("w"), F.sum(F.col("mix_tokens") * F.col("mix_probability")).alias("e")).collect()
        shares = {r[0]: r["w"] ** mixing.TEMPER for r in of}
        short = {r[0] for r in of if r["e"] > 0.9999 * r["w"]}  # these give all they have
        left = sum(r["e"] for r in of if r[0] not in short)
        scale = sum(s for v, s in shares.items() if v not in short)
        assert all(abs(r["e"] / left / (shares[r[0]] / scale) - 1) < 0.01 for r in of if r[0] not in short)
