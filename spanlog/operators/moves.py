"""Detection of moved directories in a change log (new dirs that look like deleted ones).

Input: a change log (seq, op, path) with op in new_dir, new_file, del_file,
del_dir; directory paths end in '/'.  New directories appear before their new
files; deleted directories appear after their deleted files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import prefix_dirs
from ..plans.ordered import keyed_scan
from ..session import reliable_checkpoint

# File names ignored (compared with the whole relative path) and the acceptance rule.
EXCLUDE_FILES = ("Thumbs.db",)
MIN_MATCHES = 1
MIN_MATCH_PCT = 10


def dir_members(changes: DataFrame, side: str, exclude=EXCLUDE_FILES) -> tuple[DataFrame, DataFrame]:
    """(dirs, members) of one side.

    ``dirs``: (dir, dir_seq, n_files); ``members``: (dir, dir_seq, rel) — the
    files below each directory with the directory prefix cut off.  A new file
    counts for new directories listed before it; a deleted file for deleted
    directories listed after it.  Files are exploded to their ancestor
    directories after de-duplication, then semi-joined to the directories of
    that side.
    """
    dop, fop = ("new_dir", "new_file") if side == "new" else ("del_dir", "del_file")
    dirs = changes.filter(F.col("op") == dop).select(F.col("path").alias("dir"), F.col("seq").alias("dir_seq"))
    files = changes.filter((F.col("op") == fop) & ~F.col("path").isin(*exclude)).select(
        F.col("path").alias("file"), F.col("seq").alias("file_seq"))
    x = files.select("file", "file_seq", F.explode(prefix_dirs("file")).alias("dir"))
    m = x.join(dirs, "dir")
    order = (F.col("dir_seq") < F.col("file_seq")) if side == "new" else (F.col("file_seq") < F.col("dir_seq"))
    m = m.filter(order).select("dir", "dir_seq", F.expr("substring(file, length(dir) + 1)").alias("rel")).distinct()
    n = m.groupBy("dir").agg(F.count(F.lit(1)).alias("n_files"))
    dirs = dirs.join(n, "dir", "left").fillna(0, ["n_files"])
    return dirs, m


def _count_within(rows: DataFrame, key: str, order: list[str], out: str) -> DataFrame:
    """Numbers the rows of a key from 1 in ``order``; a directory may hold most rows, so by ranges."""
    numbered = keyed_scan(rows.withColumn("_one", F.lit(1).cast("long")), [key], order, cumsum=["_one"])
    return numbered.withColumnRenamed("cumsum__one", out).drop("_one")


def _sets(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dir, set) of each directory with members, and the members of each distinct set once: (set, rel, first).

    A set is known by its size and two sums over the digests of its members (60 bits each): directories with equal digests hold equal
    names, and one of them, the first listed, stands for all."""
    def part(at: int):
        return F.sum(F.conv(F.substring(F.sha2("rel", 256), at, 15), 16, 10).cast("decimal(20,0)"))
    known = members.groupBy("dir").agg(F.count("*").alias("n"), part(1).alias("a"), part(16).alias("b"), F.min("dir_seq").alias("dir_seq"))
    known = known.select("dir", "dir_seq", F.concat_ws(":", "n", "a", "b").alias("set"))
    first = known.groupBy("set").agg(F.min(F.struct("dir_seq", "dir")).alias("first"))
    of = members.join(first.select("set", F.col("first.dir").alias("dir"), F.col("first.dir_seq").alias("seq")), "dir")
    return known, of.select("set", "rel", "seq", "dir").distinct()


def _overlaps(pairs: DataFrame, new: DataFrame, old: DataFrame) -> DataFrame:
    """(set, seq, old_set, matches) of the given pairs (set, old_set), counted member by member."""
    x = pairs.join(new.select("set", "rel"), "set").join(old.select(F.col("set").alias("old_set"), "rel", "seq"), ["old_set", "rel"])
    return x.groupBy("set", "seq", "old_set").agg(F.count("*").alias("matches"))


def _better(rows: DataFrame) -> DataFrame:
    """The best pair of each new set: most matches, then the first listed."""
    best = rows.groupBy("set").agg(F.max(F.struct("matches", (-F.col("seq")).alias("neg"), "old_set")).alias("b"))
    return best.select("set", F.col("b.matches").alias("matches"), (-F.col("b.neg")).alias("seq"), F.col("b.old_set").alias("old_set"))


def best_pairs(new: DataFrame, old: DataFrame) -> DataFrame:
    """For each set of names in ``new`` (set, rel) the set in ``old`` (set, rel, seq) that shares most, ties to the smallest ``seq``.

    Names that many sets hold would pair every set with every other, so pairs are only formed where they can win:

    * a lower bound first. Each name votes for the first listed set that holds it; votes are names shared. The set with most votes and the
      first holder of the rarest name are counted in full; a moved set is usually found, with all its names, here.
    * then names in order of rarity. A pair that shares ``m`` names shares its rarest common one, at a place with at least ``m`` names from
      there on, on both sides. To beat a bound of ``m``, ``m + 1`` are needed, or ``m`` and an earlier listing: a name is looked up
      only if enough names follow, and at exactly ``m`` only if some set listed earlier holds it. Pairs met so are counted in full.

    A name at the common end of every set is never joined, whatever the number of sets that hold it."""
    held = old.groupBy("rel").agg(F.count("*").alias("holders"), F.min(F.struct("seq", F.col("set").alias("old_set"))).alias("first"))
    mine = reliable_checkpoint(new.select("set", "rel").join(held, "rel"))  # names that nothing old holds match nothing
    votes = mine.groupBy("set", F.col("first.old_set").alias("old_set")).agg(F.count("*").alias("matches"), F.min("first.seq").alias("seq"))
    rarest = mine.groupBy("set").agg(F.min(F.struct("holders", "rel", F.col("first.old_set").alias("old_set"))).alias("r")).select("set", "r.old_set")
    tried = _better(votes).select("set", "old_set").unionByName(rarest).distinct()
    # the vote for a single shared name is exact for one match, so the bound is one at least and first of its kind
    bound = reliable_checkpoint(_better(_overlaps(tried, new, old).unionByName(votes.select("set", "seq", "old_set", "matches"))))

    place = ["holders", "rel"]
    sized = mine.groupBy("set").agg(F.count("*").alias("n"))
    left = _count_within(mine.select("set", "rel", "holders", F.col("first.seq").alias("earliest")), "set", place, "place").join(sized, "set")
    left = left.withColumn("rest", F.col("n") - F.col("place") + 1).join(bound.select("set", F.col("matches").alias("m"), F.col("seq").alias("s")), "set")
    left = left.where((F.col("rest") > F.col("m")) | ((F.col("rest") == F.col("m")) & (F.col("earliest") < F.col("s"))))
    total = old.groupBy("set").agg(F.count("*").alias("size"))
    right = _count_within(old.select("set", "rel", "seq").join(held.select("rel", "holders"), "rel"), "set", place, "place").join(total, "set")
    right = right.select(F.col("set").alias("old_set"), "rel", "seq", (F.col("size") - F.col("place") + 1).alias("follow"))
    # a bound of one is only beaten by two names, and at one no earlier set is left
    met = left.where("rest > 1").select("set", "rel", "rest", "m", "s").join(right.where("follow > 1"), "rel")
    can = F.least("rest", "follow")
    met = met.where((can > F.col("m")) | ((can == F.col("m")) & (F.col("seq") < F.col("s")))).select("set", "old_set").distinct()
    return _better(bound.select("set", "seq", "old_set", "matches").unionByName(_overlaps(met, new, old).select("set", "seq", "old_set", "matches")))


def best_move(changes: DataFrame, min_matches: int = MIN_MATCHES, min_pct: int = MIN_MATCH_PCT) -> DataFrame:
    """For each new directory the deleted one sharing most relative paths (first listed wins ties).

    Kept when matches >= min_matches and matches*100/n_new >= min_pct. Directories with the same names are settled once
    (``_sets``); the best partner is found without pairing all that share a name (``best_pairs``).
    """
    nd, nm = dir_members(changes, "new")
    _, om = dir_members(changes, "del")
    known, new = _sets(reliable_checkpoint(nm))
    _, old = _sets(reliable_checkpoint(om))
    new, old = reliable_checkpoint(new), reliable_checkpoint(old)
    best = best_pairs(new, old).join(old.select(F.col("set").alias("old_set"), F.col("dir").alias("old_dir")).distinct(), "old_set")
    best = known.select(F.col("dir").alias("new_dir"), "set").join(best, "set").select("new_dir", "old_dir", "matches")
    best = best.join(nd.select(F.col("dir").alias("new_dir"), F.col("dir_seq").alias("new_seq"), "n_files"),
                     "new_dir")
    ok = (F.col("matches") >= min_matches) & (F.col("matches") * 100 >= F.col("n_files") * min_pct)
    return best.filter(ok)


def prune_nested(moves: DataFrame) -> DataFrame:
    """Drop accepted directories lying below another accepted directory.

    A directory is covered when one of its proper ancestors is accepted: a semi join of
    the exploded ancestors with the accepted set, so no ancestor collects its subtree.
    """
    moves = reliable_checkpoint(moves)  # read three times
    anc = F.filter(prefix_dirs("new_dir"), lambda a: a != F.col("new_dir"))
    below = moves.select("new_dir", F.explode(anc).alias("_p"))
    covered = below.join(moves.select(F.col("new_dir").alias("_p")).distinct(), "_p", "left_semi").select("new_dir").distinct()
    return moves.join(covered, "new_dir", "left_anti").select(*moves.columns)


def copy_plan(moves: DataFrame) -> DataFrame:
    """The printed plan line per accepted move, with the integer percentage."""
    pct = F.floor(F.col("matches") * 100 / F.col("n_files")).cast("long")
    return moves.select(
        "old_dir", "new_dir", F.col("matches").cast("long").alias("matches"), pct.alias("pct"),
        F.format_string("cp -al %s %s # %d matched (%d%%)", "old_dir", "new_dir", "matches", pct).alias("line"))


def detect_moves(changes: DataFrame) -> DataFrame:
    """J1-J4 in one plan."""
    return copy_plan(prune_nested(best_move(changes)))
