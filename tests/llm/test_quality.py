import itertools

import numpy as np
from pyspark.sql import functions as F

from spanlog.llm import quality
from spanlog.llm.queries import QUERIES
from llm_fixtures import make_docs  # noqa: E402, F401


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    per_text = np.array([1, 4, 3], np.int64)
    node, pair = rng.standard_normal(8), rng.standard_normal((2, 2))
    alpha, beta, z = quality.forward_backward(node, pair, quality.Chain.of(per_text))
    good = np.exp(alpha[:, 1] + beta[:, 1] - z)
    at = 0
    for n in per_text:
        total, one = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(node[at + i] for i in range(n) if y[i]) + sum(pair[y[i], y[i + 1]] for i in range(n - 1)))
            total, one = total + w, one + w * np.array(y)
        assert np.allclose(good[at:at + n], one / total)
        at += n


def test_gradient_and_fit():
    texts = ["Good plain words here.\nAnother good line of words."] * 30 + ["### !!! $$$ ###\nplain words in a bad text.\n%%% *** ###"] * 30
    x, size, per_text = quality.measures(texts)
    assert per_text.tolist() == [2] * 30 + [3] * 30 and x.shape == (150, quality.N_MEASURES)
    assert size[:2].tolist() == [22, 27]
    model = quality.fit(x, size, per_text, np.array([1.0] * 30 + [0.0] * 30))
    score = model.score(x, size, per_text)
    assert score[:30].min() > 0.9 and score[30:].max() < 0.1
    line = model.good(x, per_text)[60:63]
    assert line[0] < 0.5 and line[2] < 0.5


def test_scores_of_odd_rows(make_docs, spark):
    rows = [(i, "Some plain words.\nMore of them here." if i % 2 else "### $$$\n%%% &&&", "en", "s") for i in range(40)]
    odd = [(90, None, None, None), (91, "", "en", "s"), (None, "\n\n", "en", "s"), (92, "word " * 40_000, "en", "s"), (92, "word", "en", "s")]
    labels = spark.createDataFrame([(i, i % 2, "?") for i in range(40)] + [(3, None, "?"), (None, 1, "?"), (4, 7, "?"), (999, 1, "?")], "doc_id long, quality int, text string")
    docs = make_docs(rows + odd)
    model = quality.train(docs, labels)
    got = quality.score(docs, model, keep=("doc_id", "score", "label")).collect()
    assert len(got) == 45 and all(0 <= r["score"] <= 1 for r in got)
    assert all((r["score"] > 0.7) == (r["doc_id"] % 2 == 1) for r in got if r["doc_id"] is not None and r["doc_id"] < 40)
    assert quality.train(docs, labels.where("quality = 1")) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(make_docs([]), model).count() == 0 and quality.train(make_docs([]), labels.limit(0)) is None


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    out = QUERIES["op2_line_quality"](spark, sf).where("held_out").join(labels, "doc_id")
    assert out.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).head()[0] > 0.97
