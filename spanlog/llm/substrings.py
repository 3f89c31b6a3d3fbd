"""Removal of repeated long substrings with a run-length index (operator 10).

A byte goes if a ``WINDOW``-byte string covering it also starts earlier: in a document with a smaller id, or earlier in the same one.

1. Anchors. Every window is represented by the smallest hash among its ``gram``-byte substrings. Equal windows have equal
   anchors; neighbouring windows mostly share one, so a document falls into slices: runs of windows with one anchor.
2. Slices meet by anchor (one shuffle of fixed-size rows, no text). Of equal slices all but the first are repeats as a whole;
   they never reach a later step, so copies cost one row. An anchor with a single slice is unique, unless its gram
   occurs twice in the slice, which may then repeat itself. What remains are anchors whose slices differ: the edges of copied passages.
3. The bytes of these slices are fetched, and the slices of an anchor go, in the order of their documents, into a run-length
   index (``rindex``). Streaming them through it marks every window that starts earlier, too.
4. An anchor whose slices exceed ``HOT_TIMES`` times ``index_bytes`` is not indexed as one group: its slices are cut anew by the anchors of longer
   grams, at last whole windows, where equal anchors mean equal windows. Exact for any skew, in bounded memory.
5. The marked windows of a document are united and their bytes removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_slices
from .rindex import RunLengthIndex

WINDOW = 100  # fixed by the contract
GRAMS = (48, 80, WINDOW)
INDEX_BYTES = 1 << 19  # bytes after which an index is built from the anchors held
HOT_TIMES = 2  # an anchor with so many times these bytes is cut again
ROWS_AT_ONCE = 200_000
MARK, SLICE, HOT = 0, 1, 2

_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OTHER = np.random.default_rng(8).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 18)
        for i, base in enumerate((_BASE, _INVERSE)):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _powers[i] = np.multiply.accumulate(step)
    return _powers[0][:n], _powers[1][:n]


def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from every position, by doubling."""
    h, size, step = _BYTES[b], 1, _BASE
    while size * 2 <= gram:
        h = h[:-size] * np.uint64(step) + h[size:]
        step, size = step * step % (1 << 64), size * 2
    if size < gram:
        h = h[:len(h) - (gram - size)] * _MIX + h[gram - size:]
    h ^= h >> np.uint64(29)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def slices(b: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, hash of the slice's bytes, first window, windows) of the slices of one text, in order.

    The hash's lowest bit tells whether the anchor's gram occurs twice in the slice, so that it may repeat a window itself."""
    if len(b) < WINDOW:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    width = WINDOW - gram + 1
    h = gram_hashes(b, gram)
    low, size, n = h, 1, len(b) - WINDOW + 1
    while size * 2 <= width:
        low, size = np.minimum(low[:-size], low[size:]), size * 2
    low = np.minimum(low[:n], low[width - size:width - size + n])
    start = np.nonzero(np.concatenate([[True], low[1:] != low[:-1]]))[0]
    count = np.diff(np.append(start, n))
    forward, backward = powers(len(b) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_OTHER[b] * forward[:len(b)], dtype=np.uint64)])
    content = (total[start + count + WINDOW - 1] - total[start]) * backward[start] + count.astype(np.uint64)
    # a gram is an anchor somewhere if it is the smallest of a window over it: as large as the largest minimum around it
    high, size = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)]), 1
    while size * 2 <= width:
        high, size = np.maximum(high[:-size], high[size:]), size * 2
    high = np.maximum(high[:len(h)], high[width - size:width - size + len(h)])
    place = np.nonzero(h == high)[0]
    value, number = np.unique(h[place], return_inverse=True)
    at = np.sort(number * (len(h) + 1) + place)
    own = np.searchsorted(value, low[start]) * (len(h) + 1) + start
    twice = np.searchsorted(at, own + count + width - 1) - np.searchsorted(at, own) > 1
    return low[start], (content << np.uint64(1)) | twice.astype(np.uint64), start, count


NAMES = ["a", "s", "doc", "seq", "start", "count"]
Rows = list[np.ndarray]  # the columns NAMES


def differs(c: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before."""
    return np.concatenate([np.ones(min(1, len(c)), bool), c[1:] != c[:-1]])


def first_of_equal(rows: Rows, key: np.ndarray) -> np.ndarray:
    """Whether each row is the first, by document and place, of its equal slices; equal slices have an equal ``key``."""
    order = np.argsort(key)
    new = differs(key[order])
    shared = order[~(new & np.append(new[1:], True))]  # most slices are alone
    first = np.ones(len(key), bool)
    if len(shared):
        part = [c[shared] for c in rows]
        order = np.lexsort((part[4], part[3], part[2], part[5], part[1], part[0]))
        first[shared[order]] = differs(part[0][order]) | differs(part[1][order]) | differs(part[5][order])
    return first


def united(rows: Rows) -> Rows:
    """Marks, neighbouring ones of a document as one."""
    order = np.lexsort((rows[4], rows[3], rows[2]))
    rows = [c[order] for c in rows]
    doc, seq, start, count = rows[2:]
    heads = np.nonzero(differs(doc) | differs(seq) | np.concatenate([np.ones(min(1, len(start)), bool), start[1:] != start[:-1] + count[:-1]]))[0]
    return [*(c[heads] for c in rows[:5]), np.add.reduceat(count, heads) if len(heads) else count]


def settled_here(rows: Rows) -> Iterator[pa.RecordBatch]:
    """The first of equal slices, and marks for the others."""
    first = first_of_equal(rows, rows[0] * _MIX ^ rows[1])
    if first.any():
        yield batch_of(np.full(int(first.sum()), SLICE), [c[first] for c in rows])
    if not first.all():
        marks = united([c[~first] for c in rows])
        yield batch_of(np.full(len(marks[0]), MARK), marks)


def batch_of(kind: np.ndarray, rows: Rows, extra: pa.Array | None = None) -> pa.RecordBatch:
    types = [np.int64] * 4 + [np.int32] * 2
    columns = [pa.array(kind.astype(np.int32))] + [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(t)) for c, t in zip(rows, types, strict=True)]
    return pa.RecordBatch.from_arrays(columns + ([extra] if extra is not None else []), ["kind", *NAMES] + (["bytes"] if extra is not None else []))


ROW = "kind int, a long, s long, doc long, seq long, start int, count int"


def _columns(batch: pa.RecordBatch) -> Rows:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in NAMES]


def anchored(docs: DataFrame) -> DataFrame:
    """Slices of whole texts. Equal slices within some megabytes of text are settled at once: the first goes on, others are marks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                found: list[Rows] = []
                for text, doc, seq in zip(part.column("text"), part.column("doc").to_pylist(), part.column("seq").to_pylist(), strict=True):
                    if not text.is_valid:
                        continue
                    a, s, start, count = slices(np.frombuffer(text.as_buffer(), np.uint8) if len(text.as_buffer()) else np.empty(0, np.uint8), GRAMS[0])
                    found.append([a, s, np.full(len(a), doc, np.int64), np.full(len(a), seq, np.int64), start, count])
                if found:
                    yield from settled_here([np.concatenate(c) for c in zip(*found, strict=True)])
    return docs.mapInArrow(run, ROW)


def settle(rows: DataFrame, gram: int, index_bytes: int) -> DataFrame:
    """Slices that meet by anchor: marks for all but the first of equal ones, slices to index, slices of anchors too hot for that.

    Rows stream through sorted by anchor; memory holds some hundred thousand rows and, of an anchor with more, only the
    first of equal slices, until they are so many that its slices pass on as they come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Rows] = []
        size, hot = 0, None

        def out(rows: Rows, final: bool) -> Iterator[pa.RecordBatch]:
            """Sends what is decided; keeps the last anchor's rows unless ``final``."""
            nonlocal held, size, hot
            first = first_of_equal(rows, rows[0])
            heads = np.nonzero(differs(rows[0]))[0]
            ends = np.append(heads[1:], len(first))
            if not final:
                keep = heads[-1]
                rest = [c[keep:] for c in rows]
                same = ~first[keep:]  # repeats among the kept ones are decided already
                if same.any():
                    yield batch_of(np.full(int(same.sum()), MARK), [c[keep:][same] for c in rows])
                rest = [c[~same] for c in rest]
                if len(rest[0]) > ROWS_AT_ONCE:
                    hot = rest[0][0]
                    yield batch_of(np.full(len(rest[0]), HOT), rest)
                    rest = [c[:0] for c in rest]
                held, size = [rest], len(rest[0])
                rows, first, heads, ends = [c[:keep] for c in rows], first[:keep], heads[:-1], ends[:-1]
            if not len(first):
                return
            s, count = rows[1].view(np.uint64), rows[5]
            slices_of = np.add.reduceat(first.astype(np.int64), heads)
            bytes_of = np.add.reduceat(np.where(first, count + WINDOW - 1, 0), heads)
            reach = np.repeat(slices_of > 1, ends - heads) | (s & np.uint64(1) > 0)
            heavy = np.repeat(bytes_of > HOT_TIMES * index_bytes, ends - heads) if gram < WINDOW else np.zeros(len(first), bool)
            kind = np.where(~first, MARK, np.where(heavy, HOT, SLICE))
            send = ~first | reach
            if send.any():
                yield batch_of(kind[send], [c[send] for c in rows])

        for batch in batches:
            kind, rows = batch.column("kind").to_numpy(), _columns(batch)
            if hot is not None:
                at = (rows[0] == hot) & (kind != MARK)
                if at.any():
                    yield batch_of(np.full(int(at.sum()), HOT), [c[at] for c in rows])
                    kind, rows = kind[~at], [c[~at] for c in rows]
            done = kind == MARK
            if done.any():
                yield batch_of(kind[done], [c[done] for c in rows])
            held.append([c[~done] for c in rows])
            size += int((~done).sum())
            if size > ROWS_AT_ONCE:
                yield from out([np.concatenate(c) for c in zip(*held, strict=True)], final=False)
        if size:
            yield from out([np.concatenate(c) for c in zip(*held, strict=True)], final=True)

    # marks only pass through; they are dealt by document, so that copies do not pile up at their anchor
    key = F.when(F.col("kind") == MARK, F.xxhash64("doc", "start")).otherwise(F.col("a"))
    return rows.repartition(key).sortWithinPartitions("a").mapInArrow(run, ROW)


def with_bytes(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows with the bytes of their slices."""
    per_document = rows.groupBy("doc", "seq").agg(F.collect_list(F.struct("kind", "a", "s", "start", "count")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                kinds, columns, contents = [], [[] for _ in NAMES], []
                for text, doc, seq, own in zip(part.column("text"), part.column("doc").to_pylist(), part.column("seq").to_pylist(),
                                               part.column("rows").to_pylist(), strict=True):
                    b = text.as_buffer().to_pybytes()
                    for r in own:
                        kinds.append(r["kind"])
                        contents.append(b[r["start"]:r["start"] + r["count"] + WINDOW - 1])
                        for c, v in zip(columns, (r["a"], r["s"], doc, seq, r["start"], r["count"]), strict=True):
                            c.append(v)
                yield batch_of(np.array(kinds), [np.array(c, np.int64) for c in columns], pa.array(contents, pa.binary()))
    return docs.join(per_document, ["doc", "seq"]).select("doc", "seq", "text", "rows").mapInArrow(run, ROW + ", bytes binary")


def indexed(rows: DataFrame, index_bytes: int) -> DataFrame:
    """Marks of the windows of these slices that also start earlier, from run-length indexes of whole anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = _columns(table.combine_chunks().to_batches()[0])
            order = np.lexsort((rows[4], rows[3], rows[2]))
            strings = table.column("bytes").to_pylist()
            marks: list[tuple[int, int, int]] = []
            for i, at in zip(order.tolist(), RunLengthIndex([strings[i] for i in order.tolist()], WINDOW).repeats(), strict=True):
                if len(at):
                    cut = np.nonzero(np.concatenate([[True], np.diff(at) > 1]))[0]
                    marks += [(i, a, n) for a, n in zip(at[cut].tolist(), np.diff(np.append(cut, len(at))).tolist(), strict=True)]
            if marks:
                which, at, n = (np.array(c, np.int64) for c in zip(*marks, strict=True))
                yield batch_of(np.full(len(which), MARK), [rows[0][which], rows[1][which], rows[2][which], rows[3][which], rows[4][which] + at, n])

        for batch in batches:
            a = batch.column("a").to_numpy()
            bounds = np.nonzero(np.concatenate([[True], a[1:] != a[:-1]]))[0].tolist()
            for b, e in zip(bounds, [*bounds[1:], len(a)], strict=True):
                part = batch.slice(b, e - b)
                if held and size > index_bytes and held[-1].column("a")[0].as_py() != int(a[b]):
                    yield from out(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(part)
                size += sum(len(x.as_buffer()) for x in part.column("bytes"))
        if held:
            yield from out(pa.Table.from_batches(held))
    return rows.repartition("a").sortWithinPartitions("a").mapInArrow(run, ROW)


def cut_again(rows: DataFrame, gram: int) -> DataFrame:
    """The slices of hot anchors, cut by the anchors of longer grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[Rows] = []
            for b, doc, seq, at in zip(batch.column("bytes").to_pylist(), *(batch.column(n).to_pylist() for n in ("doc", "seq", "start")), strict=True):
                a, s, start, count = slices(np.frombuffer(b, np.uint8), gram)
                found.append([a, s, np.full(len(a), doc, np.int64), np.full(len(a), seq, np.int64), start + at, count])
            if found:
                yield from settled_here([np.concatenate(c) for c in zip(*found, strict=True)])
    return rows.mapInArrow(run, ROW)


def numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, seq, text): rows in the order of (doc, seq); seq is 0 unless ids repeat or are null (null ids come first)."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    doc = F.coalesce("id", F.lit(-(1 << 63))).alias("doc")
    clash = docs.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL").limit(1).count()
    if not clash:
        return docs.select("id", doc, F.lit(0).cast("long").alias("seq"), "text")
    return stored(docs.select("id", doc, F.monotonically_increasing_id().alias("seq"), "text"), "substrings-rows")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, spans) of every row; ``kept`` is what is left, ``spans`` the (start, end) bytes removed.

    A null text counts as empty. Rows that repeat an id are documents of their own, in the order they are stored in; null ids
    come before all others. An empty table gives an empty result; other columns are ignored.
    """
    docs = numbered(df, id_col, text_col)
    keyed = docs.where(F.octet_length("text") >= WINDOW).select("doc", "seq", "text")
    marks, level = [], 0
    rows = stored(settle(anchored(keyed), GRAMS[0], index_bytes), "substrings-settled")
    while True:
        marks.append(rows.where(F.col("kind") == MARK).select("doc", "seq", "start", "count"))
        fetched = stored(with_bytes(rows.where(F.col("kind") != MARK), keyed), "substrings-slices")
        marks.append(stored(indexed(fetched.where(F.col("kind") == SLICE), index_bytes).select("doc", "seq", "start", "count"), "substrings-marks"))
        hot = fetched.where(F.col("kind") == HOT)
        if hot.isEmpty():
            break
        level += 1
        rows = stored(settle(cut_again(hot, GRAMS[level]), GRAMS[level], index_bytes), "substrings-settled")
    every = reduce(DataFrame.unionByName, marks).groupBy("doc", "seq").agg(F.collect_list(F.struct("start", "count")).alias("marks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part in text_slices(batch, "text"):
                sizes, removed, kept, spans = [], [], [], []
                for text, own in zip(part.column("text"), part.column("marks"), strict=True):
                    b = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid and len(text.as_buffer()) else np.empty(0, np.uint8)
                    gone = np.zeros(len(b) + 1, np.int64)
                    if own.is_valid and len(own.values):
                        start = own.values.field("start").to_numpy()
                        np.add.at(gone, start, 1)
                        np.add.at(gone, start + own.values.field("count").to_numpy() + WINDOW - 1, -1)
                    covered = np.cumsum(gone)[:-1] > 0
                    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
                    sizes.append(len(b))
                    removed.append(int(covered.sum()))
                    kept.append(b[~covered].tobytes())
                    spans.append([{"start": s, "end": e} for s, e in zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(s) for s in spans], pa.int64()),
                     pa.array(kept, pa.binary()), pa.array(spans, pairs)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])
    return docs.join(every, ["doc", "seq"], "left").select("id", "text", "marks").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:int,end:int>>")
