"""Mixing sources to target weights by iterative proportional fitting (operator 8), native DataFrame operations only.

Token weights are summed per cell (one combination of the margins' values), map-side first, so a hot source costs one row per
task. The cells are then raked: each round scales them to every margin's target in turn; a round is a grouped sum over the cells
and a join back per margin, written to the shared folder. Probabilities are raked, not weights: a document is sampled with min(1, factor),
cells at 1 give all they have and the others are scaled to what is left of a target, so the expected tokens meet the targets although
probabilities end at 1. A value that would have to give more than it has gives everything, and its margin's other values
share the rest; ``achieved`` reports what every value was to give and gives. The decision compares the probability with a number in
[0, 1) derived from the document's id, the same on every run and cluster.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ROUNDS = 10
SMALL_CELLS = 50_000  # up to so many cells a round runs in one task; beyond, its sums and joins are shuffled
FILLS = 12  # steps to the share level at which values without enough tokens give all
SURE = 1 - 1e-9  # from here on a probability is 1, whatever the last bits of a sum
BUDGET = 0.5
TEMPER = 0.5
SEED = "mix"


def words(text: Column) -> Column:
    """Token weight of a text: its words (runs without space, tab, CR or LF); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\r\\n]+")), F.lit(0)).cast("long")


def length_class(tokens: Column) -> Column:
    """A stand-in for a topic where the table has none: brief, article or long."""
    return F.when(tokens < 100, "brief").when(tokens < 600, "article").otherwise("long")


def tempered_shares(cells: DataFrame, margin: str, temper: float) -> DataFrame:
    """(value, share): observed token weights raised to ``temper``; raking normalises them."""
    return cells.groupBy(F.col(margin).alias("value")).agg(F.pow(F.sum("w").cast("double"), F.lit(temper)).alias("share"))


def filled(values: DataFrame, tokens: float) -> float:
    """The c for which the sum of min(w, c * s) over ``values`` is ``tokens``, by fixed-point steps; scalars only."""
    c = None
    for _ in range(FILLS + 1):
        whole = F.col("_s") * F.lit(c) >= F.col("_w") if c is not None else F.lit(False)
        r = values.agg(F.sum(F.when(whole, F.col("_w")).otherwise(0)).cast("double").alias("given"), F.sum(F.when(whole, 0.0).otherwise(F.col("_s"))).alias("rest")).head()
        if not r["rest"]:
            break
        now = (tokens - (r["given"] or 0.0)) / r["rest"]
        if c is not None and now <= c:
            break
        c = now
    return c or 0.0


def rake(cells: DataFrame, margins: list[str], targets: dict[str, DataFrame], rounds: int = ROUNDS, budget: float | None = None) -> DataFrame:
    """Adds ``factor`` to cells (margins, w): after the rounds, sums of w * factor follow the targets' shares.

    With a ``budget``, sums of w * min(1, factor) follow them, and their total is ``budget`` of all; a value gives at most its w.
    Targets are (value, share); a value without a target gets share 0, a target without rows is left out and the rest are
    scaled up, null is a value. Margins whose total is 0 stay as they are.
    """
    total = cells.agg(F.sum("w").cast("double")).head()[0] or 0.0
    for m in margins:
        t = targets[m].select(F.col("value").alias("_t"), F.col("share").alias("_s"))
        seen = cells.groupBy(F.col(m).alias("_v")).agg(F.sum("w").cast("double").alias("_w"))
        seen = stored(seen.join(t, F.col("_v").eqNullSafe(F.col("_t")), "left").select("_v", "_w", F.coalesce("_s", F.lit(0.0)).alias("_s")), "mix-values")
        if budget is None:
            whole = seen.agg(F.sum("_s")).head()[0] or 0.0
            goal = F.col("_s") / F.lit(whole) * F.lit(total) if whole else F.lit(0.0)
        else:
            goal = F.least(F.col("_w"), F.col("_s") * F.lit(filled(seen, budget * total)))
        cells = cells.join(seen.select("_v", goal.alias(f"_goal_{m}")).hint("shuffle_hash"), F.col(m).eqNullSafe(F.col("_v"))).drop("_v")
    cells = stored(cells.withColumn("factor", F.lit(1.0 if budget is None else float(budget))), "mix-start")
    small = cells.count() <= SMALL_CELLS  # the same steps either way; a single partition needs no exchanges
    sure = F.lit(False) if budget is None else F.col("factor") >= SURE
    for _ in range(rounds):
        cells = cells.coalesce(1) if small else cells
        for m in margins:
            now = cells.groupBy(F.col(m).alias("_v")).agg(F.sum(F.when(sure, F.col("w").cast("double")).otherwise(0.0)).alias("_kept"),
                                                          F.sum(F.when(sure, 0.0).otherwise(F.col("w") * F.col("factor"))).alias("_rest"))
            goal, given = F.col(f"_goal_{m}"), F.col("_kept") + F.col("_rest")
            scaled = (F.when((F.col("_rest") > 0) & (goal > F.col("_kept")), F.col("factor") * (goal - F.col("_kept")) / F.col("_rest"))
                      .when(given > 0, F.col("factor") * goal / given).otherwise(F.col("factor")))
            # a shuffle of a few cells: two dozen broadcasts would be built in the driver instead
            cells = cells.join(now.hint("shuffle_hash"), F.col(m).eqNullSafe(F.col("_v"))).withColumn("factor", scaled).drop("_v", "_kept", "_rest")
        cells = stored(cells, "mix-round")  # a checkpoint would keep every round's constraints in the plan
    return cells.select(*margins, "w", "factor", *([f"_goal_{m}" for m in margins] if budget is not None else []))


def probability(factor: Column) -> Column:
    return F.when(factor >= SURE, F.lit(1.0)).otherwise(factor)


def achieved(raked: DataFrame, margins: list[str]) -> DataFrame:
    """(margin, value, tokens, goal, expected) per value of every margin of cells raked with a budget: what it has, was to give and is
    expected to give. A goal of all tokens marks a value that cannot give its share. Where the cells at 1 leave little room, rounds close in
    slowly or the margins exclude each other: then goal and expected differ here."""
    kept = F.sum(F.col("w") * probability(F.col("factor"))).alias("expected")
    each = [raked.groupBy(F.lit(m).alias("margin"), F.col(m).cast("string").alias("value")).agg(
        F.sum("w").alias("tokens"), F.first(f"_goal_{m}").alias("goal"), kept) for m in margins]
    return reduce(DataFrame.unionByName, each)


def chance(id_col: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id and the seed: 48 bits of an MD5."""
    text = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(seed))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def mix(df: DataFrame, margins: dict[str, Column], tokens: Column, targets: dict[str, DataFrame] | None = None,
        id_col: str = "doc_id", rounds: int = ROUNDS, temper: float = TEMPER, budget: float = BUDGET,
        seed: str = SEED) -> DataFrame:
    """``df`` with ``mix_tokens``, ``mix_<margin>`` for each margin, ``mix_factor``, ``mix_probability`` and ``mix_sampled``.

    ``margins`` maps names (source, language, topic) to expressions over ``df``; a margin without an entry in ``targets`` is
    raked to its observed shares raised to ``temper``. Nulls are values of their own; null or empty texts weigh whatever
    ``tokens`` says (0 tokens: sampled by their cell); repeated rows are decided alike; an empty table gives an empty result;
    columns named like a result are replaced, all others pass through.
    """
    out = df.drop(*[c for c in df.columns if c in {"mix_tokens", "mix_factor", "mix_probability", "mix_sampled", *(f"mix_{m}" for m in margins)}])
    out = out.withColumn("mix_tokens", tokens.cast("long"))
    out = out.withColumns({f"mix_{m}": e.cast("string") for m, e in margins.items()})
    names = [f"mix_{m}" for m in margins]
    cells = stored(out.groupBy(*names).agg(F.coalesce(F.sum("mix_tokens"), F.lit(0)).alias("w")), "mix-cells")
    goals = {f"mix_{m}": (targets or {}).get(m, None) for m in margins}
    goals = {m: t if t is not None else tempered_shares(cells, m, temper) for m, t in goals.items()}
    raked = rake(cells, names, goals, rounds, budget)
    # written, so that its size is known and Spark broadcasts it only below its threshold
    cells = stored(raked.select(*[F.col(n).alias(f"_{n}") for n in names], F.col("factor").alias("mix_factor"),
                                probability(F.col("factor")).alias("mix_probability")), "mix-factors")
    same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names])
    return (out.join(cells, same).drop(*[f"_{n}" for n in names])
            .withColumn("mix_sampled", chance(F.col(id_col), seed) < F.col("mix_probability")))


def oracle(rounds: int = ROUNDS, temper: float = TEMPER, budget: float = BUDGET, seed: str = SEED, docs: str = "documents") -> str:
    """DuckDB twin of ``mix`` over source, lang and length class, unrolled over the rounds."""
    margins = ("source", "language", "topic")
    ctes = [f"""d AS (
  SELECT *, CASE WHEN tokens < 100 THEN 'brief' WHEN tokens < 600 THEN 'article' ELSE 'long' END AS topic
  FROM (SELECT doc_id, source, lang AS language, coalesce(len(regexp_extract_all(text, '[^ \\t\\r\\n]+')), 0) AS tokens FROM {docs}))""",
            "c0 AS (SELECT source, language, topic, CAST(sum(tokens) AS DOUBLE) AS w FROM d GROUP BY ALL)"]
    for m in margins:
        ctes.append(f"""has_{m} AS MATERIALIZED (SELECT {m} AS v, sum(w) AS w, pow(sum(w), {temper}) AS s FROM c0 GROUP BY 1)""")
        ctes.append(f"level_{m}_0 AS (SELECT {budget} * sum(w) / sum(s) AS c FROM has_{m})")
        for i in range(FILLS):
            ctes.append(f"""level_{m}_{i + 1} AS MATERIALIZED (
  SELECT greatest(any_value(c), coalesce(({budget} * sum(w) - sum(CASE WHEN s * c >= w THEN w ELSE 0 END)) / nullif(sum(CASE WHEN s * c >= w THEN 0 ELSE s END), 0), any_value(c))) AS c
  FROM has_{m}, level_{m}_{i})""")
        ctes.append(f"goal_{m} AS (SELECT v, least(w, s * c) AS goal FROM has_{m}, level_{m}_{FILLS})")
    goals = "\n  ".join(f"JOIN goal_{m} ON c0.{m} IS NOT DISTINCT FROM goal_{m}.v" for m in margins)
    ctes.append(f"""r0 AS MATERIALIZED (
  SELECT c0.*, {', '.join(f'goal_{m}.goal AS g_{m}' for m in margins)}, CAST({budget} AS DOUBLE) AS f FROM c0
  {goals})""")
    step = 0
    for _ in range(rounds):
        for m in margins:
            ctes.append(f"""r{step + 1} AS MATERIALIZED (
  SELECT source, language, topic, w, g_source, g_language, g_topic,
         CASE WHEN rest > 0 AND g_{m} > kept THEN f * (g_{m} - kept) / rest WHEN kept + rest > 0 THEN f * g_{m} / (kept + rest) ELSE f END AS f
  FROM (SELECT *, sum(CASE WHEN f >= {SURE!r} THEN w ELSE 0 END) OVER (PARTITION BY {m}) AS kept,
               sum(CASE WHEN f >= {SURE!r} THEN 0 ELSE w * f END) OVER (PARTITION BY {m}) AS rest FROM r{step}))""")
            step += 1
    ctes.append(f"p AS (SELECT source, language, topic, f, CASE WHEN f >= {SURE!r} THEN 1.0 ELSE f END AS p FROM r{step})")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, d.source, d.language, d.topic, tokens, round(f, 9) AS factor, round(p, 9) AS probability,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '{seed}'), 1, 12) AS BIGINT) / 281474976710656.0 < p AS sampled
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.language IS NOT DISTINCT FROM p.language AND d.topic = p.topic"""
