"""Secret scans judged by corpus-wide ownership frequency (operator 4).

Base candidates, leftmost and non-overlapping per kind, failing matches dropped: ``assign`` (a password-like name, then : or =,
then a value of 6 or more characters), ``access`` (AKIA and capitals or digits, 20 or more), ``hex`` (24 or more of 0-9a-f).
Further candidates, ``opaque``: maximal runs of 20 or more of [A-Za-z0-9+/_-] that hold an upper-case letter, a lower-case
letter and a digit and overlap no base span.

The method: the hash of every candidate's value is counted over the whole corpus by distinct repositories (documents; equal
texts are one) and distinct owners (sources). As many owners hold a value independently as it has owners, but no more than it
has repositories. A value is a widely copied example if at least ``example_owners`` owners and at least the square root of
the corpus's number of owners hold it independently, or if over half of all owners (and ``example_owners``) hold it, be it
in copies of one text. Of the others, a value of one owner, in whatever number of repositories, or of one repository, whoever
copied it, is live-looking; the rest are shared. Base spans are always reported, each with its verdict; an opaque candidate
becomes a span only if it is live-looking.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_slices

# The first three are fixed values of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 or more characters in all
HEX = re.compile(r"[0-9a-f]{24,}")
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
NAMES = ("passw", "secret", "token", "api")  # one of them is in every text with an assignment
KINDS = ("assign", "access", "hex", "opaque")
EXAMPLE_OWNERS = 3

SPAN = "struct<kind:string,start:int,end:int,value_hash:long>"
COLUMNS = f"doc_id long, owner string, content long, spans array<{SPAN}>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start, then by kind as listed."""
    out = []
    low = text.lower()  # keeps every ASCII letter's occurrences, so the test below misses nothing
    if any(name in low for name in NAMES):
        out += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def opaque_spans(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    out = []
    for m in OPAQUE.finditer(text):
        s = m[0]
        if (any("A" <= c <= "Z" for c in s) and any("a" <= c <= "z" for c in s) and any("0" <= c <= "9" for c in s)
                and not any(b < m.end() and m.start() < e for _, b, e, _ in taken)):
            out.append(("opaque", m.start(), m.end(), s))
    return out


def value_hash(value: str) -> int:
    h = xxhash.xxh64_intdigest(value)
    return h - (1 << 64) if h >> 63 else h


def candidates(df: DataFrame, id_col: str, text_col: str, owner_col: str) -> DataFrame:
    """(doc_id, owner, content, spans): all candidates of each row, in order of start, then kind; ``content`` is its text's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value_hash", pa.int64())]))
        for batch in batches:
            for part in text_slices(batch, "text"):
                spans = []
                for t in part.column("text"):
                    text = t.as_py() or ""
                    base = base_spans(text)
                    both = sorted(base + opaque_spans(text, base), key=lambda s: (s[1], KINDS.index(s[0])))
                    spans.append([{"kind": k, "start": b, "end": e, "value_hash": value_hash(v)} for k, b, e, v in both])
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("doc_id", "owner", "content")] + [pa.array(spans, kind)],
                                                 ["doc_id", "owner", "content", "spans"])
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
                    F.xxhash64(F.col(text_col).cast("string")).alias("content"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, COLUMNS)


def ownership(spans: DataFrame, all_owners: int, example_owners: int) -> DataFrame:
    """(value_hash, owners, repos, verdict) over the whole corpus, which has ``all_owners`` owners.

    Distinct (value, owner) and (value, text) rows come first, so a value that a third of all rows hold is spread by
    the second key; the counts over them are combined map-side. A null owner counts as one owner.
    """
    per_owner = (spans.select("value_hash", "owner").distinct().groupBy("value_hash").agg(F.count("*").alias("owners")))
    per_repo = (spans.select("value_hash", "content").distinct().groupBy("value_hash").agg(F.count("*").alias("repos")))
    apart = F.least("owners", "repos")
    example = (((apart >= example_owners) & (apart * apart >= all_owners))
               | ((F.col("owners") >= example_owners) & (F.col("owners") * 2 > all_owners)))
    verdict = F.when(example, "example").when(apart == 1, "live").otherwise("shared")
    return per_owner.join(per_repo, "value_hash").withColumn("verdict", verdict)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """(doc_id, spans): one row per input row; spans are (kind, start, end, owners, repos, verdict) by start, then kind.

    Offsets are code points, ends exclusive. A null or empty text has no spans; a null id or owner is a value like any
    other; repeated rows give repeated results, and equal texts count as one repository; an empty table gives an empty result; other
    columns are ignored.
    """
    rows = stored(candidates(df, id_col, text_col, owner_col).withColumn("row", F.monotonically_increasing_id()), "secrets")
    spans = rows.select("row", "doc_id", "owner", "content", F.explode("spans").alias("s")).select("row", "doc_id", "owner", "content", "s.*")
    verdicts = ownership(spans, rows.select("owner").distinct().count(), example_owners)
    # A join whose hot values AQE splits; the rows of a document meet again under its own key.
    judged = (spans.join(verdicts, "value_hash").where("kind <> 'opaque' OR verdict = 'live'")
              .withColumn("place", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")))
              .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "place", "kind", "end", "owners", "repos", "verdict"))).alias("s")))
    ordered = judged.select("row", F.transform("s", lambda s: F.struct(
        *[s[c].alias(c) for c in ("kind", "start", "end", "owners", "repos", "verdict")])).alias("spans"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,owners:bigint,repos:bigint,verdict:string>>")
    return (rows.select("row", "doc_id").join(ordered, "row", "left")
            .select("doc_id", F.coalesce("spans", none).alias("spans")))


def redact(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with every span (sorted by start; overlapping ones count as one) replaced by ``mask``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        add = F.when(fresh, F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).otherwise("")
        return F.struct(F.concat(acc["out"], add).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    return F.when(F.size(spans) > 0, F.aggregate(
        spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))).otherwise(text)


def spans_text(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of the given kinds, comma-joined."""
    def one(s: Column) -> Column:
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.filter(spans, lambda s: s["kind"].isin(*kinds)), one), ",")
