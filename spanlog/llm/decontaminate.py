"""Benchmark decontamination by a hash set of normalised n-grams (operator 12), native DataFrame operations only.

A-Z are lower-cased; words are runs of ASCII letters, digits and anything beyond ASCII. A window is ``size`` consecutive words of
a benchmark item (all words of an item that has fewer). Their 64-bit hashes form a set; every window of every document is hashed
from its words' hashes and looked up in it. Windows found are verified: their words are joined to the benchmark's windows as
text, so a collision of hashes never counts. A document's spans are the verified windows, merged; hit words are those inside.

The set travels with the tasks only while it has at most ``SET_ROWS`` distinct windows, which are counted first. Beyond that the
documents' hashes are joined to the windows' as a table (Spark broadcasts it or shuffles both by size): the same rows result.
Only documents with a window in the set leave their scan with more than an id and a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SIZE = 10
SET_ROWS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"  # fixed by the contract, on lower-cased text
ANY_CASE = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # the same words before lower-casing


def starts(n: str, length: int) -> Column:
    """Positions at which a window of ``length`` words starts in ``n`` words."""
    return F.when(F.col(n) >= length, F.sequence(F.lit(0), F.col(n).cast("int") - length)).otherwise(F.array().cast("array<int>"))


def window_hash(i: Column, length: int) -> Column:
    """Hash of the window at ``i`` from the hashes of its words (column _hashes)."""
    return F.xxhash64(*[F.get("_hashes", i + j) for j in range(length)])


def with_words(df: DataFrame, text: Column) -> DataFrame:
    """Adds _words, _n (their number) and _hashes. Each is used more than once below, so that Spark computes it once a row."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    out = df.withColumn("_split", F.split(lowered, BETWEEN))  # only the first and the last piece can be empty
    first = F.when(F.get("_split", F.lit(0)) == "", 1).otherwise(0)
    last = F.when((F.size("_split") > 1) & (F.element_at("_split", -1) == ""), 1).otherwise(0)
    out = out.withColumn("_words", F.slice("_split", first + 1, F.greatest(F.size("_split") - first - last, F.lit(0)))).drop("_split")
    return out.withColumn("_n", F.size("_words").cast("long")).withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))


def pair(i: Column) -> Column:
    """A cheap number of the two words at ``i``, by which most positions are passed over without hashing a window."""
    return F.get("_hashes", i).bitwiseXOR(F.shiftleft(F.coalesce(F.get("_hashes", i + 1), F.lit(0).cast("long")), 1))


def window_text(i: Column, length: Column | int) -> Column:
    return F.array_join(F.slice("_words", i + 1, length), " ")


def hashed(length: int) -> Column:
    """(pos, len, hash) of every window of ``length`` words."""
    def one(i: Column) -> Column:
        return F.struct(i.alias("pos"), F.lit(length).alias("len"), window_hash(i, length).alias("hash"))
    return F.transform(starts("_n", length), one)


def benchmark_windows(benchmark: DataFrame, size: int = SIZE, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(len, hash, pair, words, item): the different windows of every item, item as text (null: unnamed)."""
    b = with_words(benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("_t")), F.col("_t")).where("_n > 0")
    b = b.withColumn("_len", F.least(F.col("_n"), F.lit(size)).cast("int"))
    # the hash of an array of longs is that of its elements as columns
    entry = F.transform(F.sequence(F.lit(0), F.col("_n").cast("int") - F.col("_len")), lambda i: F.struct(
        F.xxhash64(F.slice("_hashes", i + 1, F.col("_len"))).alias("hash"), pair(i).alias("pair"), window_text(i, F.col("_len")).alias("words")))
    out = b.select("item", F.col("_len").alias("len"), F.explode(entry).alias("w")).select("len", "w.hash", "w.pair", "w.words", "item")
    return stored(out.distinct(), "decontaminate-windows")


def _in_set(rows: DataFrame, sets: dict[int, list[tuple[int, int]]]) -> DataFrame:
    """Adds _found, the (pos, len) of windows whose (hash, pair) are in the set of their length, looked up inside the scan."""
    def listed(values: set[int]) -> str:
        return ",".join(f"{v}L" for v in sorted(values))

    def found(length: int, known: list[tuple[int, int]]) -> Column:
        whole = f"xxhash64({','.join(f'get(_hashes, i + {j})' for j in range(length))}) IN ({listed({h for h, _ in known})})"
        two = f"(get(_hashes, i) ^ shiftleft(get(_hashes, i + 1), 1)) IN ({listed({p for _, p in known})}) AND " if length > 1 else ""
        return F.expr(f"transform(filter(CASE WHEN _n >= {length} THEN sequence(0, cast(_n AS int) - {length}) ELSE cast(array() AS array<int>) END, "
                      f"i -> {two}{whole}), i -> named_struct('pos', i, 'len', {length}))")
    return rows.withColumn("_found", F.concat(*[found(k, v) for k, v in sets.items()]))


def _joined(rows: DataFrame, hashes: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds _found as ``_in_set`` does, by a join of all window hashes with the benchmark's."""
    known = stored(hashes.select("len", "hash").distinct(), "decontaminate-hashes")
    hits = (rows.select("_row", F.explode(F.concat(*[hashed(k) for k in lengths])).alias("w")).select("_row", "w.pos", "w.len", "w.hash").join(known, ["len", "hash"])
            .groupBy("_row").agg(F.collect_list(F.struct("pos", "len")).alias("_found")))
    empty = F.array().cast("array<struct<pos:int,len:int>>")
    return rows.join(stored(hits, "decontaminate-found"), "_row", "left").withColumn("_found", F.coalesce("_found", empty))


def merged(spans: Column) -> Column:
    """Sorted, disjoint (start, end) word ranges of a window list (pos, len)."""
    ranges = F.array_sort(F.transform(spans, lambda s: F.struct(s["pos"].alias("start"), (s["pos"] + s["len"]).alias("end"))))
    # of the windows in order, a range starts at each that begins beyond all before it; its end is the largest up to the next one
    open_at = F.aggregate(
        ranges, F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("done")),
        lambda acc, s: F.when(s["start"] > acc["end"], F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.when(acc["end"] < 0, acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))).alias("done")))
        .otherwise(F.struct(acc["start"].alias("start"), F.greatest(acc["end"], s["end"]).alias("end"), acc["done"].alias("done"))),
        lambda acc: F.when(acc["end"] < 0, acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))))
    return open_at


def scan(df: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", size: int = SIZE,
         set_rows: int = SET_ROWS, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``df``: the columns ``keep``, ``n_words``, ``n_hit``, ``spans`` (array of word ranges start, end) and
    ``items`` (sorted texts of the ids whose windows occur).

    A null or empty text has no words; an item without words has no window; an item with a null id marks words and is not
    named; items that share an id are one. Repeated rows are decided alike and all returned. An empty benchmark hits nothing; an
    empty table gives an empty result. Columns outside ``keep`` are ignored; names beginning with _ are reserved.
    """
    windows = benchmark_windows(benchmark, size, item_col, item_text)
    rows = df.select(F.monotonically_increasing_id().alias("_row"), *keep, F.col(text_col).alias("_text"))
    hashes = windows.select("len", "hash", "pair").distinct()
    some = hashes.limit(set_rows + 1).collect()  # at most so many
    sets: dict[int, list[tuple[int, int]]] = {}
    for r in some:
        sets.setdefault(r["len"], []).append((r["hash"], r["pair"]))
    if not some:
        found = with_words(rows, F.col("_text")).withColumn("_found", F.array().cast("array<struct<pos:int,len:int>>"))
    elif len(some) <= set_rows:
        found = _in_set(with_words(rows, F.col("_text")), dict(sorted(sets.items())))
    else:
        lengths = sorted(r["len"] for r in hashes.select("len").distinct().collect())  # at most ``size`` values
        found = _joined(with_words(stored(rows, "decontaminate-rows"), F.col("_text")), hashes, lengths)
    texts = F.transform("_found", lambda f: F.struct(f["pos"].alias("pos"), f["len"].alias("len"), window_text(f["pos"], f["len"]).alias("words")))
    marked = stored(found.select("_row", *keep, F.col("_n").alias("n_words"), texts.alias("_found")), "decontaminate-marked")
    # verified as text; a window that many items share is one row here
    known = stored(windows.groupBy("len", "words").agg(F.array_compact(F.array_sort(F.collect_set("item"))).alias("names")), "decontaminate-known")
    hits = marked.where(F.size("_found") > 0).select("_row", F.explode("_found").alias("f")).select("_row", "f.pos", "f.len", "f.words")
    per_row = (hits.join(known, ["len", "words"]).groupBy("_row")
               .agg(F.collect_list(F.struct("pos", "len")).alias("_spans"), F.flatten(F.collect_set("names")).alias("_names")))
    per_row = stored(per_row.select("_row", merged(F.col("_spans")).alias("_spans"), F.array_sort(F.array_distinct("_names")).alias("_names")),
                     "decontaminate-hits")
    out = marked.join(per_row, "_row", "left")
    spans = F.coalesce("_spans", F.array().cast("array<struct<start:int,end:int>>"))
    return out.select("_row", *keep, "n_words", F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"])).alias("n_hit"),
                      spans.alias("spans"), F.coalesce("_names", F.array().cast("array<string>")).alias("items")).drop("_row")


def cut(text: Column, spans: Column) -> Column:
    """``text`` without the words of the ranges ``spans`` (as ``scan`` returns them) and what follows each up to the next word."""
    own = F.regexp_extract_all(text, F.lit(ANY_CASE), F.lit(0))
    gaps = F.split(text, ANY_CASE, -1)
    n = F.size(own)
    # kept ranges lie between the end of a span and the start of the next
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    begins = F.concat(F.transform(spans, lambda s: s["start"]), F.array(n))
    pieces = F.zip_with(own, F.slice(gaps, F.lit(2), n), lambda w, g: F.concat(w, g))
    kept = F.zip_with(ends, begins, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.concat(F.get(gaps, F.lit(0)), F.array_join(F.transform(kept, lambda r: F.array_join(F.slice(pieces, r["a"] + 1, r["b"] - r["a"]), "")), ""))


def decontaminate(df: DataFrame, benchmark: DataFrame, remove: str = "spans", id_col: str = "doc_id", text_col: str = "text",
                  size: int = SIZE, set_rows: int = SET_ROWS, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``df`` without what the benchmark contains: hit words cut out of the texts (``remove="spans"``) or hit rows left out
    (``remove="documents"``). All columns pass through, whatever their names; null and empty texts and repeated rows stay as they are."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be 'spans' or 'documents', not {remove!r}")
    names = df.columns
    inner = [f"c{i}" for i in range(len(names))]
    base = stored(df.toDF(*inner).withColumn("_key", F.monotonically_increasing_id()), "decontaminate-base")
    text = inner[names.index(text_col)]
    hit = scan(base, benchmark, ("_key",), text, size, set_rows, item_col, item_text).where("n_hit > 0").select("_key", "spans")
    if remove == "documents":
        return base.join(hit, "_key", "left_anti").select(*inner).toDF(*names)
    out = base.join(hit, "_key", "left").withColumn(text, F.when(F.col("spans").isNotNull(), cut(F.col(text), F.col("spans"))).otherwise(F.col(text)))
    return out.select(*inner).toDF(*names)


ORACLE = f"""
WITH lowered AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), {SIZE}) AS n, array_to_string(w[i:i + least(len(w), {SIZE}) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {SIZE} + 2, 2))) AS i FROM lowered WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
doc_windows AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM item_windows) AS lengths WHERE len(w) >= n)),
hits AS (SELECT d.r, d.i, d.n, b.item_id FROM doc_windows AS d JOIN item_windows AS b ON d.n = b.n AND d.words = b.words),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN named USING (r)"""
