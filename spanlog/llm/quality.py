"""Document quality by a linear-chain conditional random field over lines (operator 2).

Every line is good or bad. Its features are measures of its characters and words (share of upper case, digits, symbols,
distinct words, ...), cut into bins at quantiles of the training lines, of the line itself and of the lines before and after;
a transition matrix couples neighbouring labels. Forward-backward gives each line's probability to be good; the mean over the
lines, weighted by length, mapped by a calibrated logistic curve, is the document's score.

Only documents are labelled. Lines of good documents count as good; of a bad document first all lines count as bad, then,
in ``rounds`` further fits, those that the last fit finds bad (the worst one always). The model is fitted on the driver from a
sample of at most ``max_documents`` labelled documents of at most ``max_lines`` lines each: only their line measures
(some 16 numbers a line) are collected. Scoring runs over all documents and whole texts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices

MAX_DOCUMENTS = 6000
MAX_LINES = 2000
ROUNDS = 2
BINS = 8
L2 = 1.0
THRESHOLD = 0.7  # fixed by the contract

_UPPER, _LOWER, _DIGIT, _SPACE, _MARK, _SYMBOL, _END = range(7)
MARKS = ".,;:!?'\"()-…«»„“”’–—¿¡"


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point: upper case, other letter, digit, white space, text punctuation, other symbol, line end."""
    out = np.full(sys.maxunicode + 1, _SYMBOL, np.uint8)
    for c in range(sys.maxunicode + 1):
        s = chr(c)
        if s.isalpha():
            out[c] = _UPPER if s.isupper() else _LOWER
        elif s.isdigit():
            out[c] = _DIGIT
        elif s.isspace():
            out[c] = _SPACE
    for s in MARKS:
        out[ord(s)] = _MARK
    out[ord("\n")] = _END
    return out


def measures(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(measures per line, code points per line, lines per text); lines end at line feeds, an empty text is one empty line."""
    joined = "\n".join(texts) + "\n"
    lines = joined.split("\n")[:-1]
    per_text = np.array([t.count("\n") + 1 for t in texts], np.int64)
    kind = classes()[np.frombuffer(joined.encode("utf-32-le"), np.uint32)].astype(np.int64)
    of = np.cumsum(kind == _END) - (kind == _END)
    count = np.bincount(of * 7 + kind, minlength=len(lines) * 7).reshape(-1, 7).astype(np.float64)
    size = count[:, :_END].sum(axis=1)
    words = [line.split() for line in lines]
    n_words = np.array([len(w) for w in words], np.float64)
    distinct = np.array([len(set(w)) for w in words], np.float64)
    twice = np.array([sum(map(str.__eq__, w, w[1:])) for w in words], np.float64)
    longest = np.array([max(map(len, w)) if w else 0 for w in words], np.float64)
    stop = np.array([line[-1:] in ".!?…" and line != "" for line in lines], np.float64)
    again = np.empty(len(lines))
    at = 0
    for n in per_text.tolist():
        seen: set[str] = set()
        for i in range(at, at + n):
            again[i] = lines[i] in seen
            seen.add(lines[i])
        at += n
    some, w = np.maximum(size, 1), np.maximum(n_words, 1)
    letters = count[:, _UPPER] + count[:, _LOWER]
    out = np.stack([np.log1p(size), np.log1p(n_words), letters / some, count[:, _UPPER] / np.maximum(letters, 1), count[:, _DIGIT] / some,
                    count[:, _SPACE] / some, count[:, _MARK] / some, count[:, _SYMBOL] / some, count[:, _MARK] / w, count[:, _SYMBOL] / w,
                    distinct / w, twice / w, size / w, np.log1p(longest), stop, again], axis=1)
    return out.astype(np.float32), size, per_text


N_MEASURES = 16


@dataclass
class Chain:
    """Lines of several documents, longest document first, as forward-backward walks them."""
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, per_text: np.ndarray) -> Chain:
        start = np.concatenate([[0], np.cumsum(per_text)[:-1]])
        order = np.argsort(-per_text, kind="stable")
        return cls(start[order], per_text[order])

    def steps(self) -> Iterator[np.ndarray]:
        live = len(self.size)
        for t in range(int(self.size[0]) if live else 0):
            while live and self.size[live - 1] <= t:
                live -= 1
            yield self.start[:live] + t


def forward_backward(node: np.ndarray, pair: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(alpha, beta, log partition per line's document) of two-state chains; state 1 (good) has the node score, state 0 none."""
    n = len(node)
    alpha, beta, z = np.zeros((n, 2)), np.zeros((n, 2)), np.zeros(n)
    steps = list(chain.steps())
    for t, rows in enumerate(steps):
        if t:
            before = alpha[rows - 1]
            alpha[rows, 0] = np.logaddexp(before[:, 0] + pair[0, 0], before[:, 1] + pair[1, 0])
            alpha[rows, 1] = np.logaddexp(before[:, 0] + pair[0, 1], before[:, 1] + pair[1, 1])
        alpha[rows, 1] += node[rows]
    for t in range(len(steps) - 2, -1, -1):
        rows = steps[t + 1]  # documents that go on
        after = beta[rows] + np.stack([np.zeros(len(rows)), node[rows]], axis=1)
        beta[rows - 1, 0] = np.logaddexp(pair[0, 0] + after[:, 0], pair[0, 1] + after[:, 1])
        beta[rows - 1, 1] = np.logaddexp(pair[1, 0] + after[:, 0], pair[1, 1] + after[:, 1])
    z = np.logaddexp(alpha[:, 0] + beta[:, 0], alpha[:, 1] + beta[:, 1])  # the same for all lines of a document
    return alpha, beta, z


@dataclass
class Model:
    cuts: list[np.ndarray]  # per measure
    weight: np.ndarray  # (own, before, after) x measure x bin; the last bin stands for "no such line"
    pair: np.ndarray
    slope: float
    shift: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(self.cuts)], axis=1)

    def good(self, x: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        alpha, beta, z = forward_backward(node_scores(self.weight, neighbours(self.bins(x), per_text)), self.pair, Chain.of(per_text))
        return np.exp(alpha[:, 1] + beta[:, 1] - z)

    def score(self, x: np.ndarray, size: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * logit(document_mean(self.good(x, per_text), size, per_text)) + self.shift)))


def neighbours(bins: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """(own, before, after) x line x measure."""
    first = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    last = np.cumsum(per_text) - 1
    before, after = np.roll(bins, 1, axis=0), np.roll(bins, -1, axis=0)
    before[first], after[last] = BINS, BINS
    return np.stack([bins, before, after])


def node_scores(weight: np.ndarray, three: np.ndarray) -> np.ndarray:
    out = np.zeros(three.shape[1])
    for place in range(3):
        for i in range(three.shape[2]):
            out += weight[place, i][three[place, :, i]]
    return out


def document_mean(good: np.ndarray, size: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Mean probability per text, lines weighted by length; texts of empty lines only weigh them equally."""
    of = np.repeat(np.arange(len(per_text)), per_text)
    total = np.bincount(of, weights=size, minlength=len(per_text))
    weight = np.where(total[of] > 0, size, 1.0)
    return np.bincount(of, weights=weight * good, minlength=len(per_text)) / np.bincount(of, weights=weight, minlength=len(per_text))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def minimise(f, x: np.ndarray, steps: int = 60, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with backtracking for a smooth convex function returning (value, gradient)."""
    value, g = f(x)
    s_list: list[np.ndarray] = []
    y_list: list[np.ndarray] = []
    for _ in range(steps):
        d, coefficients = g.copy(), []
        for s, y in zip(reversed(s_list), reversed(y_list), strict=True):
            a = s @ d / (s @ y)
            coefficients.append(a)
            d -= a * y
        d *= s_list[-1] @ y_list[-1] / (y_list[-1] @ y_list[-1]) if s_list else 1 / max(1.0, np.linalg.norm(g))
        for s, y, a in zip(s_list, y_list, reversed(coefficients), strict=True):
            d += (a - y @ d / (s @ y)) * s
        step, slope = 1.0, g @ d
        while True:
            new_value, new_g = f(x - step * d)
            if new_value <= value - 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        s, y = -step * d, new_g - g
        x, done = x + s, abs(value - new_value) <= 1e-6 * abs(value)
        value, g = new_value, new_g
        if s @ y > 1e-12:
            s_list, y_list = (s_list + [s])[-memory:], (y_list + [y])[-memory:]
        if done:
            break
    return x


def fit_chain(three: np.ndarray, per_text: np.ndarray, label: np.ndarray, start: np.ndarray | None) -> np.ndarray:
    """Weights and transitions by maximum likelihood of the line labels, with an L2 penalty."""
    chain, m = Chain.of(per_text), three.shape[2]
    shape = (3, m, BINS + 1)
    n_weights = int(np.prod(shape))
    first = np.zeros(len(label), bool)
    first[np.concatenate([[0], np.cumsum(per_text)[:-1]])] = True
    follows = np.nonzero(~first)[0]

    def loss(v: np.ndarray) -> tuple[float, np.ndarray]:
        weight, pair = v[:n_weights].reshape(shape), v[n_weights:].reshape(2, 2)
        node = node_scores(weight, three)
        alpha, beta, z = forward_backward(node, pair, chain)
        good = np.exp(alpha[:, 1] + beta[:, 1] - z)
        a, b = alpha[follows - 1], beta[follows] + np.stack([np.zeros(len(follows)), node[follows]], axis=1)
        joint = np.exp(a[:, :, None] + pair[None] + b[:, None, :] - z[follows][:, None, None])
        seen = np.zeros((2, 2))
        np.add.at(seen, (label[follows - 1], label[follows]), 1)
        value = -(node @ label) - (seen * pair).sum() + z[first].sum() + L2 / 2 * (v @ v)
        left = good - label
        grad = np.empty(shape)
        for place in range(3):
            for i in range(m):
                grad[place, i] = np.bincount(three[place, :, i], weights=left, minlength=BINS + 1)
        return value, np.concatenate([grad.ravel(), (joint.sum(axis=0) - seen).ravel()]) + L2 * v
    return minimise(loss, np.zeros(n_weights + 4) if start is None else start)


def fit(x: np.ndarray, size: np.ndarray, per_text: np.ndarray, good: np.ndarray, rounds: int = ROUNDS) -> Model:
    """``good``: one 0/1 label per text; both must occur."""
    cuts = [np.unique(np.quantile(x[:, i], np.arange(1, BINS) / BINS)) for i in range(x.shape[1])]
    model = Model(cuts, np.zeros((3, x.shape[1], BINS + 1)), np.zeros((2, 2)), 1.0, 0.0)
    three = neighbours(model.bins(x), per_text)
    of = np.repeat(np.arange(len(per_text)), per_text)
    label, v = good[of].astype(np.int64), None
    for i in range(rounds + 1):
        v = fit_chain(three, per_text, label, v)
        model.weight, model.pair = v[:-4].reshape(model.weight.shape), v[-4:].reshape(2, 2)
        line = model.good(x, per_text)
        if i < rounds:
            worst = np.full(len(per_text), 2.0)
            np.minimum.at(worst, of, line)
            label = np.where(good[of] == 1, 1, (line > 0.5) & (line > worst[of])).astype(np.int64)
    z = logit(document_mean(line, size, per_text))

    def curve(v: np.ndarray) -> tuple[float, np.ndarray]:
        t = v[0] * z + v[1]
        p = 1 / (1 + np.exp(-t))
        return (np.logaddexp(0, t) - good * t).sum() + 0.01 * (v @ v), np.array([(p - good) @ z, (p - good).sum()]) + 0.02 * v
    model.slope, model.shift = minimise(curve, np.array([1.0, 0.0])).tolist()
    return model


def line_measures(df: DataFrame, text_col: str = "text", label_col: str = "label") -> DataFrame:
    """(label, per line: measures as one flat array, sizes) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                x, size, per_text = measures([t or "" for t in part.column("text").to_pylist()])
                ends = np.concatenate([[0], np.cumsum(per_text)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.ListArray.from_arrays(pa.array(ends * N_MEASURES, pa.int32()), pa.array(x.ravel())),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(size))], ["label", "x", "size"])
    src = df.select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("label"))
    return src.mapInArrow(run, "label int, x array<float>, size array<double>")


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_documents: int = MAX_DOCUMENTS, max_lines: int = MAX_LINES, rounds: int = ROUNDS) -> Model | None:
    """Fit on labelled rows of ``df``; None unless both labels occur. The sample is that with the smallest hashed ids."""
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    sample = marked.orderBy(F.xxhash64("_id"), "_id", "_label").limit(max_documents)
    docs = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    docs = docs.where(F.length(F.coalesce("_text", F.lit(""))) - F.length(F.replace(F.coalesce("_text", F.lit("")), F.lit("\n"), F.lit(""))) < max_lines)
    rows = line_measures(docs.join(F.broadcast(sample), "_id"), "_text", "_label").toPandas()  # bounded by the two parameters
    if rows.label.nunique() < 2:
        return None
    per_text = np.array([len(s) for s in rows["size"]], np.int64)
    return fit(np.concatenate(list(rows.x)).reshape(-1, N_MEASURES), np.concatenate(list(rows["size"])), per_text,
               rows.label.to_numpy(np.float64), rounds)


def score(df: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row and its ``score``, 0 to 1, higher for better texts.

    Null and empty texts are scored as one empty line; without a model every score is 0.5. Repeated rows give repeated results;
    an empty table an empty result; columns outside ``keep`` are ignored, and a kept column named ``score`` is replaced.
    """
    keep = tuple(c for c in keep if c != "score")
    src = df.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("_text"))
    if model is None:
        return src.drop("_text").withColumn("score", F.lit(0.5))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                found = shared.value.score(*measures([t or "" for t in part.column("_text").to_pylist()]))
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(part.num_columns - 1)], pa.array(found)],
                                                 [*part.schema.names[:-1], "score"])
    return src.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in src.dtypes[:-1]), "score double"]))


def predicted(score_col: Column, threshold: float = THRESHOLD) -> Column:
    return F.when(score_col >= threshold, 1).otherwise(0)
