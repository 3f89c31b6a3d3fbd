"""SimHash near-duplicate classes with pigeonring filtering (operator 9).

Fingerprints: ASCII letters A-Z are lower-cased, words are runs of bytes other than space and \\x09-\\x0D,
shingles are ``shingle`` words joined by one space (a shorter text is one shingle), hashed by XXH64 with seed 42.
Bit b is 1 if set in over half the hashes. A text without words (null, empty, white space) has fingerprint 0
and is linked like any other.

Linking: distinct fingerprints only, so copies cost one row. The 64 bits form a ring of d+1 segments. If two
fingerprints differ in at most d bits, some segment starts a chain whose first l segments differ in at most
l*d/(d+1) bits in total, for every l (pigeonring principle); its first segment is therefore equal. The same holds
for a second ring over the bits outside that segment. An index entry is (first segment, second segment, their bits);
pairs that share one pass both chain tests before the full Hamming test. Entries are compared inside one bucket, a
bucket emits at most one edge per member, and a bucket above ``bucket_rows`` is split by a further ring over its
remaining bits until it fits: exact, without caps.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sieved, stored, text_slices
from .graph import connected_components

SHINGLE = 3
DISTANCE = 3
BUCKET_ROWS = 2048
HASH_SEED = 42  # fixed by the contract


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)), strict=False)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, HASH_SEED) for g in grams), np.uint64, len(grams))
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 15):
        part = h[at:at + (1 << 15)].view(np.uint8)
        votes += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, keep: str | None = None) -> DataFrame:
    """(doc_id, fp) and the binary column ``keep``: one row per input row; other columns, whatever their names, are left out."""
    names = ["doc_id", *[keep] * bool(keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                fps = [fingerprint(t.as_buffer().to_pybytes(), shingle) if t.is_valid else 0 for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], pa.array(np.array(fps, np.uint64).view(np.int64))], [*names, "fp"])
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), *names[1:], F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, ", ".join(f"{c} {'binary' if c == keep else 'long'}" for c in [*names, "fp"]))


def ring(positions: list[int], distance: int) -> list[int]:
    """Masks of distance+1 consecutive segments of nearly equal width over the given bit positions."""
    m = distance + 1
    cut = [len(positions) * i // m for i in range(m + 1)]
    return [sum(1 << p for p in positions[cut[i]:cut[i + 1]]) for i in range(m)]


def rest(mask: int, last: int) -> list[int]:
    """Bit positions outside ``mask``, in ring order from the segment ``last`` on."""
    high = max(p for p in range(64) if last >> p & 1)
    return [p % 64 for p in range(high + 1, high + 65) if not mask >> p % 64 & 1]


@lru_cache(maxsize=None)
def children(path: tuple[int, ...], distance: int) -> list[tuple[int, ...]]:
    """A path is the segments chosen so far, one mask per ring; its children add one of the next ring."""
    used = reduce(int.__or__, path, 0)
    left = rest(used, path[-1]) if path else list(range(64))
    return [(*path, s) for s in ring(left, distance) if s] if left else []


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def chain_ok(x: np.ndarray, segments: list[int], first: int, distance: int) -> np.ndarray:
    """The pigeonring test: from segment ``first`` on, l segments differ in at most l*distance/m bits, for all l."""
    m, ok, total = len(segments), np.ones(x.shape, bool), np.zeros(x.shape, np.int64)
    for step in range(m):
        total = total + np.bitwise_count(x & np.uint64(segments[(first + step) % m]))
        ok &= total * m <= (step + 1) * distance
    return ok


def linked(x: np.ndarray, path: tuple[int, ...], distance: int) -> np.ndarray:
    """Chain test of every ring on the path, then the full Hamming test, on differences ``x``."""
    ok = np.ones(x.shape, bool)
    for depth in range(len(path)):
        segments = [p[-1] for p in children(path[:depth], distance)]
        ok &= chain_ok(x, segments, segments.index(path[depth]), distance)
    return ok & (np.bitwise_count(x) <= distance)


def bucket_edges(members: np.ndarray, path: tuple[int, ...], distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one bucket: at most one edge per member."""
    left, edges = np.unique(members), []
    while len(left):
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            near = linked(left ^ front.pop(), path, distance)
            found = left[near]
            edges += [(root, v) for v in found]
            front += list(found)
            left = left[~near]
    return edges


def _keyed(rows: DataFrame, paths: list[tuple[int, int, tuple[int, ...]]]) -> DataFrame:
    """One row per fingerprint and path: the path's number and the fingerprint's bits on it.

    ``paths`` are (number of the path split, own number, path); rows without a number ``t`` take all of them. The list of
    paths is a table of a few rows for any input, so it is broadcast."""
    if "t" not in rows.columns:
        entry = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(reduce(int.__or__, p)))).alias("bits")) for _, i, p in paths]
        return rows.select("fp", F.explode(F.array(*entry)).alias("e")).select("fp", "e.t", "e.bits")
    table = rows.sparkSession.createDataFrame([(t, i, signed(reduce(int.__or__, p))) for t, i, p in paths], "t int, path int, mask long")
    return rows.join(F.broadcast(table), "t").select("fp", F.col("path").alias("t"), F.col("fp").bitwiseAND(F.col("mask")).alias("bits"))


def links(fps: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b) fingerprints, whose components are those of all pairs within ``distance`` bits.

    ``fps`` holds distinct, non-null fingerprints in column ``fp``.
    """
    paths = [c for p in children((), distance) for c in children(p, distance)]
    names: list[tuple[int, ...]] = list(paths)
    rows, out = _keyed(fps.select("fp"), [(0, i, p) for i, p in enumerate(paths)]), []
    while True:
        sizes = rows.groupBy("t", "bits").agg(F.count("*").alias("n")).where("n > 1")
        rows = stored(rows.join(sizes, ["t", "bits"]), "simhash-buckets")
        table = list(names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a: list[int] = []
                b: list[int] = []
                for t, members in zip(batch.column("t").to_pylist(), batch.column("fps"), strict=True):
                    of = members.values.to_numpy(zero_copy_only=False).view(np.uint64)
                    for u, v in bucket_edges(of, table[t], distance):
                        a.append(u)
                        b.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"])

        small = rows.where(F.col("n") <= bucket_rows).groupBy("t", "bits").agg(F.collect_list("fp").alias("fps"))
        out.append(small.select("t", "fps").mapInArrow(run, "a long, b long"))
        big = rows.where(F.col("n") > bucket_rows)
        hot = [r["t"] for r in big.select("t").distinct().collect()]  # path numbers: bounded by the number of paths
        grown = [(t, child) for t in sorted(hot) for child in children(names[t], distance)]
        if not grown:
            break
        rows = _keyed(big.select("fp", "t"), [(t, len(names) + i, child) for i, (t, child) in enumerate(grown)])
        names += [child for _, child in grown]
    return reduce(DataFrame.unionByName, out).distinct()


def _classes(docs: DataFrame, distance: int, bucket_rows: int) -> DataFrame:
    """(fp, root, least) of every distinct fingerprint of ``docs``: its component's smallest fingerprint, which is never null
    and names one component only, and its own smallest doc_id."""
    fps = stored(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    comp = connected_components(links(fps.select("fp"), distance, bucket_rows))
    return fps.join(comp, fps.fp == comp.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, fp, component_id): the class of every document under links of at most ``distance`` bits.

    ``component_id`` is the smallest non-null doc_id reachable, the row's own included. Nulls: a null text counts
    as empty; a null id is a row like any other but never names a class (a class without ids has a null one).
    Repeated rows are copies of each other. An empty table gives an empty result.
    """
    docs = stored(fingerprints(df, id_col, text_col, shingle), "simhash-fp")
    of = _classes(docs, distance, bucket_rows)
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(of.join(least, "root").select("fp", "component_id"), "simhash-classes")
    return docs.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The rows of ``df``, one per near-duplicate class: that with the smallest id (null after all others), then the smallest
    text (null first); of rows that are equal in both any one, and of any number of them only one.

    Rows are told apart by an MD5 of id and text (``_key``; ids may be null or shared by different texts), so texts are neither
    copied: the table is read once for fingerprints and twice to leave out the keys that were not chosen. Texts are shuffled where a
    sieve of these keys lets a row through, which is about those that go, and are compared only where rows of one class share the smallest id.
    """
    marked = _keyed_rows(df, id_col, text_col)
    src = marked.select("_key", F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = stored(fingerprints(src, "doc_id", "text", shingle, keep="_key"), "simhash-fp")
    classes = stored(_classes(docs, distance, bucket_rows).select("fp", "root"), "simhash-classes")
    # one row per class and key: copies of a row add up before any shuffle
    of = stored(docs.join(classes, "fp").groupBy("root", "doc_id", "_key").agg(F.count("*").alias("n")), "simhash-rows")
    least = of.groupBy("root").agg(F.min("doc_id").alias("least"))
    first = stored(of.join(least, "root").where(F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("root")
                   .agg(F.min("_key").alias("one"), F.count("*").alias("keys")), "simhash-first")
    shared = first.where("keys > 1").select("root", F.col("one").alias("_one"))
    ties = (of.join(shared, "root").join(least.withColumnRenamed("root", "_root"), F.col("root") == F.col("_root"))
            .where(F.col("doc_id").eqNullSafe(F.col("least"))).select("root", "_key"))
    ties = stored(ties, "simhash-ties")  # rows of one class and one id with different texts: rare, and written so that its size is known
    texts = src.select("_key", "text").join(ties, "_key").groupBy("root").agg(F.min(F.struct("text", "_key")).alias("m"))
    best = stored(first.where("keys = 1").select("root", F.col("one").alias("_best"))
                  .unionByName(texts.select("root", F.col("m._key").alias("_best"))), "simhash-best")
    chosen = of.join(best, "root")
    # what goes, not what stays, is looked up: copies and near copies are the smaller part
    gone = stored(chosen.where(F.col("_key") != F.col("_best")).select("_key"), "simhash-gone")
    again = stored(chosen.where((F.col("_key") == F.col("_best")) & (F.col("n") > 1)).select("_key"), "simhash-again")
    left, asked = sieved(marked, gone.unionByName(again), "_key")
    asked = asked.join(gone, "_key", "left_anti").select(*marked.columns)
    if not again.isEmpty():
        asked = asked.join(again, "_key", "left_anti").unionByName(asked.join(again, "_key", "left_semi").dropDuplicates(["_key"]))
    return left.unionByName(asked).drop("_key")


def _keyed_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with ``_key``, an MD5 of id and text, never null. Nulls have a key of their own."""
    name = F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))
    text = F.col(text_col).cast("string")
    return df.withColumn("_key", F.unhex(F.md5(F.concat(name, F.when(text.isNull(), F.lit(":")).otherwise(F.lit("=")), F.coalesce(text, F.lit(""))).cast("binary"))))
