"""Chains of pointers followed in parallel.

Sequential rules often say "whatever happens from here on depends on here only": a batch that starts at an event is followed by a
batch that starts at a certain later one. All these successors can be computed at once; which of them really come about are those
that a chain from a first one reaches. Following a chain link by link is one long task. Doubling the pointers (the successor of the
successor, and so on) reaches a chain of n links in log2(n) rounds of one join each, on as many tasks as there are rows for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint


def reached(heads: DataFrame, links: DataFrame, keys: list[str], at: str, to: str) -> DataFrame:
    """The places (``keys``, ``at``) that are heads or lie on a chain of ``links`` (``keys``, ``at``, ``to``) from one.

    A place has one link at most, and links lead forward (``to`` > ``at``). Each round, what is reached grows by the jumps from it, and
    jumps become twice as long; a jump that would lead past the end of its chain is dropped, so the work shrinks by itself. Rounds are
    stored in the shared folder. Places without a link end a chain."""
    found = heads.select(*keys, at).distinct()
    jumps = reliable_checkpoint(links.where(F.col(to) > F.col(at)).select(*keys, at, to))
    while not jumps.isEmpty():
        ahead = found.join(jumps, [*keys, at]).select(*keys, F.col(to).alias(at))
        found = reliable_checkpoint(found.unionByName(ahead).distinct())
        then = jumps.select(*keys, F.col(at).alias(to), F.col(to).alias("_then"))
        jumps = reliable_checkpoint(jumps.join(then, [*keys, to]).select(*keys, at, F.col("_then").alias(to)))
    return found
