"""Language identification by interpolated Kneser-Ney character models (operator 1).

Text is lower-cased, every run of non-letters becomes one space, and each character is predicted from the three before it.
Training counts 4-grams per language over all training texts (numpy inside tasks, summed by Spark); continuation counts
of the lower orders, context totals and discounts are Spark aggregates. Every n-gram is kept: the model is two tables
keyed by (order, n-gram hash of 16 bits a character), the n-grams' discounted shares and the contexts' back-off weights,
one entry per language, and no process holds it.

Scoring cuts the texts into blocks of about ``BLOCK`` bytes. A block's distinct 4-grams are joined to the model once and
meet the block's texts again under its number, so a task holds one block and the log-probabilities of its own n-grams.

A text gets its length-normalised cross-entropy under every language; the lowest wins. Calibration uses all training
rows: a temperature (best log-loss on a grid) turns cross-entropies into the score, and a text is rejected if it has no
letter, or if it has ``reject_chars`` characters or more and its cross-entropy lies over ``reject_sds`` deviations above the
mean of its language and length class and also nearer to that of random letters than to that mean.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, stored_by, text_slices

ORDER = 4
REJECT_SDS = 8.0
REJECT_CHARS = 20
TEMPERATURES = (0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
UNKNOWN = "und"
SLICE = 1 << 19  # bytes of text at a time: arrays of 8 bytes a character are made of it
BLOCK = 16 << 20  # bytes of text that look up their n-grams together
MAX_BUCKETS = 50_000  # tasks that score; more blocks than these share tasks, one block at a time
_SPACE, _END = 32, 1


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point: itself if a letter of the basic plane, U+FFFD for other letters, a space otherwise."""
    out = np.full(sys.maxunicode + 1, _SPACE, np.uint16)
    for c in range(sys.maxunicode + 1):
        if chr(c).isalpha():
            out[c] = c if c < 0xFFFF else 0xFFFD
    out[_END] = _END
    return out


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(4-gram of every predicted character as 4 x 16 bits, its text's number, letters per text)."""
    joined = "".join((t or "").lower().replace("\x01", " ") + "\x01" for t in texts)
    x = letters()[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
    blank = x == _SPACE
    start = np.empty(len(x), bool)
    start[:1], start[1:] = True, x[:-1] == _END
    drop = blank.copy()
    drop[1:] &= blank[:-1] | start[1:]
    x = x[~drop]
    x = x[~((x == _SPACE) & (np.append(x[1:], 0) == _END))]  # the end stands for a last space
    end = x == _END
    doc = np.cumsum(end) - end
    n_letters = np.bincount(doc[~end & (x != _SPACE)], minlength=len(texts))
    x = np.where(end, _SPACE, x).astype(np.uint64)
    first = np.concatenate([[0], np.nonzero(end)[0][:-1] + 1])
    at = np.arange(len(x)) - first[doc]
    key = x.copy()
    for back in range(1, ORDER):
        before = np.full(len(x), _SPACE, np.uint64)
        before[back:] = x[:-back]
        before[at < back] = _SPACE
        key |= before << np.uint64(16 * back)
    return key, doc, n_letters


def count_grams(df: DataFrame) -> DataFrame:
    """(lang, g, n) partial counts of all 4-grams of (text, lang) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in held[lang]])
            ns = np.concatenate([n for _, n in held[lang]])
            order = np.argsort(keys)
            keys, ns = keys[order], ns[order]
            at = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if len(keys) else np.empty(0, int)
            return keys[at], np.add.reduceat(ns, at) if len(at) else ns

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in sorted(held):
                keys, ns = merged(lang)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(ns)], ["lang", "g", "n"])
            held.clear()

        size = 0
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                langs = part.column("lang").to_pylist()
                key, doc, _ = grams(part.column("text").to_pylist())
                names = sorted(set(langs))
                of = np.array([names.index(v) for v in langs])[doc]
                for i, lang in enumerate(names):
                    own = np.sort(key[of == i])
                    at = np.nonzero(np.concatenate([[True], own[1:] != own[:-1]]))[0] if len(own) else np.empty(0, int)
                    held.setdefault(lang, []).append((own[at], np.diff(np.append(at, len(own)))))
                    size += len(at)
                if size > 1_500_000:  # bounds a task's memory; merging first usually makes room
                    for lang in list(held):
                        held[lang] = [merged(lang)]
                    size = sum(len(k) for parts in held.values() for k, _ in parts)
                    if size > 1_000_000:
                        yield from flush()
                        size = 0
        yield from flush()
    return df.mapInArrow(run, "lang string, g long, n long")


def _hash(order: int) -> Column:
    """The last ``order`` characters of a 4-gram."""
    return F.col("g").bitwiseAND(F.lit((1 << 16 * order) - 1)) if order < ORDER else F.col("g")


@dataclass
class Model:
    """``grams`` (k, g, share) and ``contexts`` (k, ctx, weight): per order (from 1) the discounted share of every n-gram in its
    context and the back-off weight of every context, as arrays with one entry per language."""
    langs: list[str]
    alphabet: int
    grams: DataFrame
    contexts: DataFrame
    chars: int = 0

    def logs(self, wanted: DataFrame) -> DataFrame:
        """(g, logs) of the distinct 4-grams ``wanted`` (column g): log-probabilities, one per language.

        An n-gram or context without a row has share 0 or weight 1, so an order that knows neither is passed over."""
        width = len(self.langs)
        p = None
        for order in range(1, ORDER + 1):
            own = wanted.select(_hash(order).alias("g")).distinct() if order < ORDER else wanted.select("g")
            shares = self.grams.where(F.col("k") == order).select("g", "share")
            weights = self.contexts.where(F.col("k") == order).select("ctx", "weight")
            own = own.withColumn("ctx", F.shiftrightunsigned("g", 16)).join(shares, "g", "left").join(weights, "ctx", "left")
            if p is None:
                own = own.withColumn("lower", F.array_repeat(F.lit(1.0 / self.alphabet), width))
            else:
                own = own.withColumn("low_g", _hash(order - 1)).join(p.select(F.col("g").alias("low_g"), F.col("p").alias("lower")), "low_g")
            nothing, whole = (F.array_repeat(F.lit(v).cast("float"), width) for v in (0.0, 1.0))
            p = own.select("g", F.zip_with(F.coalesce("share", nothing), F.zip_with(F.coalesce("weight", whole), "lower", lambda w, q: w * q),
                                           lambda d, q: d + q).alias("p"))
        return p.select("g", F.transform("p", lambda v: F.log(v).cast("float")).alias("logs"))

    def log_probability(self, g: np.ndarray) -> np.ndarray:
        """Rows: 4-grams; columns: languages. For a few n-grams: they and their rows pass through the driver."""
        keys = [int(v) for v in np.unique(g).view(np.int64)]
        rows = self.logs(self.grams.sparkSession.createDataFrame([(v,) for v in keys], "g long")).collect()
        found = {r["g"]: r["logs"] for r in rows}
        return np.array([found[int(v)] for v in g.view(np.int64)], np.float32).reshape(-1, len(self.langs))


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learn from every row with a text and a language; None if there is none."""
    src = df.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = count_grams(src.where("text IS NOT NULL AND lang IS NOT NULL")).groupBy("lang", "g").agg(F.sum("n").alias("n"))
    top = stored(counts, "langid-grams", few=True)
    tables, cur = [], top
    for k in range(ORDER - 1, 0, -1):  # continuation counts: different characters before an n-gram
        cur = cur.groupBy("lang", _hash(k).alias("g")).agg(F.count("*").alias("n"))
        tables.append(cur.withColumn("k", F.lit(k)))
    every = top.withColumn("k", F.lit(ORDER)).unionByName(stored(reduce(DataFrame.unionByName, tables), "langid-orders", few=True))
    spread = every.groupBy("lang", "k").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"),
                                            F.sum(F.when(F.col("k") == ORDER, F.col("n")).otherwise(0)).alias("chars")).collect()
    if not spread:  # one row per language and order
        return None
    langs = sorted({r["lang"] for r in spread})
    width = len(langs)
    discounts = [0.5] * (width * ORDER)
    for r in spread:
        if r["n1"]:
            discounts[langs.index(r["lang"]) * ORDER + r["k"] - 1] = r["n1"] / (r["n1"] + 2 * r["n2"])
    number = (F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1).cast("int")
    rows = (every.withColumn("ctx", F.shiftrightunsigned("g", 16)).withColumn("i", number)
            .withColumn("d", F.get(F.array(*map(F.lit, discounts)), F.col("i") * ORDER + F.col("k") - 1)))
    mass = F.greatest(F.col("n") - F.col("d"), F.lit(0.0))
    totals = rows.groupBy("k", "ctx", "i").agg(F.sum("n").alias("total"), F.sum(mass).alias("kept"))

    def dense(entries: str, default: float) -> Column:
        found = F.map_from_entries(entries)
        return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.try_element_at(found, i), F.lit(default).cast("float")))

    left = F.least(F.greatest(1 - F.col("kept") / F.col("total"), F.lit(1e-9)), F.lit(1.0))
    contexts = (totals.groupBy("k", "ctx").agg(F.collect_list(F.struct("i", left.cast("float").alias("w"))).alias("e"))
                .select("k", "ctx", dense("e", 1.0).alias("weight")))
    grams = (rows.join(totals.select("k", "ctx", "i", "total"), ["k", "ctx", "i"])
             .groupBy("k", "g").agg(F.collect_list(F.struct("i", (mass / F.col("total")).cast("float").alias("s"))).alias("e"))
             .select("k", "g", dense("e", 0.0).alias("share")))
    grams, contexts = stored(grams, "langid-shares", few=True), stored(contexts, "langid-contexts", few=True)
    return Model(langs, grams.where("k = 1").count() + 1, grams, contexts, sum(r["chars"] for r in spread))


def _blocks(df: DataFrame, block: int) -> DataFrame:
    """(block, rows, grams): runs of rows with about ``block`` bytes of text in column _text, as one Arrow stream, and their
    distinct 4-grams. A block's number holds for this evaluation only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, parts, own = TaskContext.get().partitionId() << 32, 0, [], []

        def out() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                for part in parts:
                    stream.write_batch(part)
            found = np.unique(np.concatenate(own)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                                               pa.array([found], pa.list_(pa.int64()))], ["block", "rows", "grams"])

        for batch in batches:
            for part in text_slices(batch, "_text", min(SLICE, block)):
                parts.append(part)
                own.append(np.unique(grams(part.column("_text").to_pylist())[0]))
                size += pc.sum(pc.binary_length(part.column("_text"))).as_py() or 0
                if size >= block:
                    yield out()
                    number, size = number + 1, 0
                    parts.clear()
                    own.clear()
        if parts:
            yield out()
    return df.mapInArrow(run, "block long, rows binary, grams array<long>")


def entropies(df: DataFrame, model: Model | None, keep: tuple[str, ...], text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The columns ``keep`` and ``_h`` (cross-entropy in nats per character under each language; null without a letter) and
    ``_n`` (characters predicted)."""
    own = text_col in keep  # a kept text is sent to the workers once
    src = df.select(*[F.col(c) for c in keep if not (own and c == text_col)], F.col(text_col).cast("string").alias("_text"))
    names = [*src.columns[:-1], *[text_col] * own]
    if model is None:
        return df.select(*names).withColumn("_h", F.lit(None).cast("array<double>")).withColumn("_n", F.lit(0).cast("long"))
    schema = ", ".join(f"`{n}` {src.schema['_text' if own and n == text_col else n].dataType.simpleString()}" for n in names) + ", _h array<double>, _n long"
    # stored: both uses below see the same blocks; in buckets: the texts meet their n-grams where they lie
    buckets = min(MAX_BUCKETS, max(2 * df.sparkSession.sparkContext.defaultParallelism, model.chars // block))
    texts = stored_by(_blocks(src, block), "langid-blocks", "block", buckets)
    wanted = texts.select("block", F.explode("grams").alias("g"))
    logs = wanted.join(model.logs(wanted.select("g").distinct()), "g").select(F.col("block").alias("of"), "g", "logs")
    width = len(model.langs)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = right.column("g").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64)
        order = np.argsort(keys)
        values = right.column("logs").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)[order]
        keys = keys[order]
        out = []
        for part in pa.ipc.open_stream(left.column("rows")[0].as_buffer()):
            key, doc, n_letters = grams(part.column("_text").to_pylist())
            at = np.searchsorted(keys, key)
            n = np.bincount(doc, minlength=part.num_rows)
            h = -np.stack([np.bincount(doc, weights=values[at, i], minlength=part.num_rows) for i in range(width)], axis=1) / n[:, None]
            h_column = pa.array([v if ok else None for v, ok in zip(h.tolist(), n_letters > 0, strict=True)], pa.list_(pa.float64()))
            arrays = [part.column("_text" if own and c == text_col else c) for c in names] + [h_column, pa.array(n.astype(np.int64))]
            out.append(pa.RecordBatch.from_arrays(arrays, [*names, "_h", "_n"]))
        return pa.Table.from_batches(out)
    return texts.select("block", "rows").groupBy("block").cogroup(logs.groupBy("of")).applyInArrow(run, schema)


def _best(model: Model | None) -> Column:
    names = F.array(*[F.lit(v) for v in model.langs]) if model else F.array(F.lit(UNKNOWN))
    return F.when(F.col("_h").isNull(), F.lit(UNKNOWN)).otherwise(F.element_at(names, F.array_position("_h", F.array_min("_h")).cast("int")))


def _posterior(h: Column, temperature: float) -> Column:
    low = F.array_min("_h")
    return F.exp((low - h) * temperature) / F.aggregate("_h", F.lit(0.0), lambda s, v: s + F.exp((low - v) * temperature))


def calibrate(scored: DataFrame, model: Model | None, true_col: str) -> tuple[float, list]:
    """(temperature, [(language, length class, mean, deviation)]) over the scored training rows ``scored``.

    A length class is the power of two of the character count: a bounded list."""
    if model is None:
        return 1.0, []
    names = F.array(*[F.lit(v) for v in model.langs])
    true = F.get("_h", (F.array_position(names, F.col(true_col)) - 1).cast("int"))
    rows = scored.where(F.col("_h").isNotNull() & F.array_contains(names, F.col(true_col)))
    losses = rows.agg(*[F.avg(-F.log(F.greatest(_posterior(true, t), F.lit(1e-12)))).alias(str(i)) for i, t in enumerate(TEMPERATURES)]).head()
    temperature = min(zip((v if v is not None else 0.0 for v in losses), TEMPERATURES, strict=True))[1]
    return temperature, (rows.groupBy(F.col(true_col).alias("lang"), F.floor(F.log2("_n")).alias("size"))
                         .agg(F.avg(true).alias("mean"), F.stddev(true).alias("sd"), F.count("*").alias("n")).collect())


def judge(scored: DataFrame, model: Model | None, temperature: float, classes: list, reject_sds: float = REJECT_SDS,
          reject_chars: int = REJECT_CHARS) -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``rejected`` to scored rows and drops the working columns."""
    out = scored.withColumn("lang_pred", _best(model)).withColumn(
        "score", F.when(F.col("_h").isNull(), F.lit(0.0)).otherwise(_posterior(F.array_min("_h"), temperature)))
    limits: dict[str, list[tuple[int, float]]] = {}
    for c in sorted(classes, key=lambda c: (c["lang"], c["size"])):
        if c["n"] >= 30 and c["sd"] is not None:  # too few rows give no deviation; nothing is rejected by them
            limits.setdefault(c["lang"], []).append(
                (int(c["size"]), max(c["mean"] + reject_sds * c["sd"], (c["mean"] + float(np.log(model.alphabet))) / 2)))
    limit = F.lit(None).cast("double")
    for lang, steps in limits.items():
        own = F.lit(steps[-1][1])
        for size, high in reversed(steps[:-1]):
            own = F.when(F.floor(F.log2("_n")) <= size, F.lit(high)).otherwise(own)
        limit = F.when(F.col("lang_pred") == lang, own).otherwise(limit)
    far = F.coalesce((F.array_min("_h") > limit) & (F.col("_n") >= reject_chars), F.lit(False))
    return out.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | far).drop("_h", "_n")


def identify(df: DataFrame, learn: Column, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", lang_col: str = "lang",
             reject_sds: float = REJECT_SDS, reject_chars: int = REJECT_CHARS) -> DataFrame:
    """The columns ``keep`` of every row with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    ``learn`` is the condition of the rows to learn from; languages are the non-null values of ``lang_col`` among them and are
    used in training and calibration only. A text without a letter (null, empty) is ``und`` with score 0 and rejected; with no
    training row every text is. Equal cross-entropies go to the first language by name. Repeated rows give repeated results;
    an empty table an empty result; columns outside ``keep`` are ignored; a kept column named like a result
    is replaced, one named like a working column (_h, _n, _learn, _true, _text) left out.
    """
    keep = tuple(c for c in keep if c not in ("lang_pred", "score", "rejected", "_h", "_n", "_learn", "_true", "_text"))
    model = train(df.where(learn), text_col, lang_col)
    marked = df.select(*dict.fromkeys((*keep, text_col)), F.coalesce(learn, F.lit(False)).alias("_learn"), F.col(lang_col).cast("string").alias("_true"))
    scored = stored(entropies(marked, model, (*keep, "_learn", "_true"), text_col), "langid-scores")
    temperature, classes = calibrate(scored.where("_learn"), model, "_true")
    return judge(scored, model, temperature, classes, reject_sds, reject_chars).drop("_learn", "_true")
