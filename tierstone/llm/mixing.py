"""Mixing documents to target weights by iterative proportional fitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import stored

DIMENSIONS = ("source", "lang", "topic")
#: Targets are present shares to this power, scaled to sum to one: below 1 it lifts the small.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
ROUNDS = 12
#: Raking with bounds goes on until no cell's share moves by more in a round, or so many rounds.
SETTLED, MOST_ROUNDS = 5e-4, 100
#: So many cells at most are raked with bounds on the driver, more of them as Spark jobs.
FEW_CELLS = 10_000
#: Tokens to sample, as a share of all tokens.
TOKEN_SHARE = 0.6


def tokens(text: Column) -> Column:
    """Words between single spaces; none in NULL and empty texts."""
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(F.coalesce(F.length(text), F.lit(0)) > 0, spaces + 1).otherwise(0).cast("long")


def topic_of(text: Column) -> Column:
    """A stand-in for a topic model's label: what kind of text its marks show."""
    has = lambda mark: F.contains(text, F.lit(mark))
    return (
        F.when(text.isNull(), "none")
        .when(has(" | "), "table")
        .when(has("icense"), "legal")
        .when(has("@"), "contact")
        .when(has("***") | has("###") | has("%%%"), "noise")
        .otherwise("prose")
    )


def cells_of(docs: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Tokens of every combination of the dimensions (columns of `docs`, with `tokens`).

    Each task adds its rows up before the shuffle, so a source with a third of all rows
    is one partial sum per task. NULL is a value of its own.
    """
    return docs.groupBy(*dimensions).agg(F.sum("tokens").cast("double").alias("tokens"))


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares of a dimension's values: present shares to a power, scaled."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).where("t > 0")
    lifted = sums.select(dimension, F.pow("t", F.lit(power)).alias("target"))
    total = lifted.agg(F.sum("target").alias("total")).scalar()
    return lifted.withColumn("target", F.col("target") / total)


def reachable(cells: DataFrame, dimension: str, power: float, wanted: float) -> DataFrame:
    """Target tokens of a dimension's values that sum to `wanted`, none above what the value has.

    A value whose tempered target is more than all its tokens gets its tokens, and what it
    cannot take goes to the others in proportion to theirs, until none is above. Only two
    sums a pass reach the driver.
    """
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).where("t > 0")
    lifted = stored(sums.withColumn("lifted", F.pow("t", F.lit(power))), "targets")
    level, fixed = 0.0, -1
    while True:
        over = (F.col("lifted") * level >= F.col("t")) if level else F.lit(False)
        n, full, free = lifted.agg(
            F.count_if(over), F.sum(F.when(over, F.col("t"))), F.sum(F.when(~over, F.col("lifted")))
        ).first()
        if n == fixed or not free:
            break
        level, fixed = (wanted - (full or 0.0)) / free, n
    return lifted.select(dimension, F.least("t", F.col("lifted") * level).alias("target"))


def rake(
    cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, bounded: bool = False
) -> DataFrame:
    """The cells with their calibrated share `w` of all tokens.

    Starts from present shares and scales them to one dimension's targets after the
    other, `rounds` times over; the dimension named last is met exactly, the others the
    closer the more rounds. Marginals are summed by partial aggregates and joined back,
    so a value with a third of all cells is no hot group. Each round is written to the
    shared folder. Cells whose value has no target get 0.

    With `bounded`, targets are tokens and no cell gets more than it has: where a value is
    to be raised, its full cells stay and the others take the rest. A cell that gets full
    on the way leaves a gap, which the next rounds close: they go on until shares have
    SETTLED, one number a round reaching the driver. Targets that exclude each other
    (each reachable alone) are met as nearly as the last round does.
    """
    named = cells
    for dimension, target in targets.items():
        wanted = target.select(F.col(dimension).alias("__value"), F.col("target").alias(f"__{dimension}"))
        named = named.join(wanted, named[dimension].eqNullSafe(wanted["__value"]), "left").drop("__value")
    now = stored(named.withColumn("w", F.col("tokens")), "cells")
    is_full = F.col("w") >= F.col("tokens")
    for _ in range(MOST_ROUNDS if bounded else rounds):
        now = now.withColumn("__was", F.col("w"))
        for dimension in targets:
            sums = now.groupBy(F.col(dimension).alias("__value")).agg(
                F.sum("w").alias("__sum"), F.coalesce(F.sum(F.when(is_full, F.col("w"))), F.lit(0.0)).alias("__full")
            )
            met = now.join(sums, now[dimension].eqNullSafe(sums["__value"]), "left")
            target = F.col(f"__{dimension}")
            scaled = F.col("w") * target / F.nullif(F.col("__sum"), F.lit(0.0))
            if bounded:
                rest = (target - F.col("__full")) / F.nullif(F.col("__sum") - F.col("__full"), F.lit(0.0))
                raised = F.when(is_full, F.col("tokens")).otherwise(F.least("tokens", F.col("w") * rest))
                scaled = F.when(target > F.col("__sum"), raised).otherwise(scaled)
            now = met.withColumn("w", F.coalesce(scaled, F.lit(0.0))).drop("__value", "__sum", "__full")
        now = stored(now, "cells")
        if bounded:
            moved = now.where("tokens > 0").agg(F.max(F.abs(F.col("w") - F.col("__was")) / F.col("tokens"))).first()[0]
            if (moved or 0.0) <= SETTLED:
                break
    return now.select(*cells.columns, "w")


def rake_few(tokens: np.ndarray, codes: Sequence[np.ndarray], powers: Sequence[float], wanted: float) -> np.ndarray:
    """`reachable` and the bounded `rake` over arrays: tokens of each cell, and for each
    dimension the number of the cell's value."""
    goals = []
    for code, power in zip(codes, powers, strict=True):
        has = np.bincount(code, tokens)
        lifted, level, full = np.where(has > 0, has**power, 0.0), 0.0, np.zeros(len(has), bool)
        while lifted[~full].any():
            level = (wanted - has[full].sum()) / lifted[~full].sum()
            over = (lifted * level >= has) & (has > 0)
            if (over == full).all():
                break
            full = over
        goals.append(np.minimum(has, lifted * level))
    w, share_of = tokens.copy(), lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b != 0)
    for _ in range(MOST_ROUNDS):
        was = w
        for code, goal in zip(codes, goals, strict=True):
            held = w >= tokens
            total, filled = np.bincount(code, w), np.bincount(code, w * held)
            raised = np.where(held, tokens, np.minimum(tokens, w * share_of(goal - filled, total - filled)[code]))
            w = np.where((goal > total)[code], raised, w * share_of(goal, total)[code])
        if (np.abs(w - was) <= SETTLED * tokens).all():
            break
    return w


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) that is a hash of the id; NULL draws like the empty text."""
    text = F.concat(F.lit("mix/"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(
    docs: DataFrame, topic: Column | None = None, powers: Mapping[str, float] = POWERS,
    token_share: float = TOKEN_SHARE, rounds: int = ROUNDS, doc_id: str = "doc_id", text: str = "text",
    once: bool = False,
) -> DataFrame:
    """The documents with __topic, __tokens, __weight (how often a document is expected in
    the mix) and __copies (how often it is taken): the weight rounded up or down by the
    id's draw, so that the mean over draws is the weight.

    Weights are one number per cell of source, language and topic: its calibrated share
    of the tokens wanted over the tokens it has. A cell without tokens (NULL and empty
    texts only) has weight 0. Rows repeating an id draw alike. NULL sources and languages are
    values like any other. An empty table gives an empty one.

    With `once` no weight is above 1, so no document is taken twice: targets are cut to what
    a value has (see `reachable`) and raking keeps to what a cell has. `marginals` tells what
    was wanted, what can be had and what is delivered.
    """
    marked = docs.withColumns({"__topic": topic_of(F.col(text)) if topic is None else topic, "__tokens": tokens(F.col(text))})
    rows = marked.select("source", "lang", F.col("__topic").alias("topic"), F.col("__tokens").alias("tokens"))
    cells = stored(cells_of(rows), "sums")
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    few = sorted(cells.limit(FEW_CELLS + 1).collect(), key=repr) if once else []
    if once and 0 < len(few) <= FEW_CELLS:
        numbers = ({v: i for i, v in enumerate({r[d] for r in few})} for d in DIMENSIONS)
        codes = [np.array([of[r[d]] for r in few]) for d, of in zip(DIMENSIONS, numbers, strict=True)]
        sums = np.array([r["tokens"] for r in few], float)
        w = rake_few(sums, codes, [powers[d] for d in DIMENSIONS], token_share * total)
        schema = cells.schema.add("w", "double")
        raked = docs.sparkSession.createDataFrame([(*r, x) for r, x in zip(few, w.tolist(), strict=True)], schema)
    elif once:
        targets = {d: reachable(cells, d, powers[d], token_share * total) for d in DIMENSIONS}
        raked = rake(cells, targets, rounds, bounded=True)
    else:
        raked = rake(cells, {d: tempered(cells, d, powers[d]) for d in DIMENSIONS}, rounds)
    wanted = F.col("w") if once else F.col("w") * (token_share * total)
    weight = F.coalesce(wanted / F.nullif(F.col("tokens"), F.lit(0.0)), F.lit(0.0))
    weights = raked.select(
        F.struct("source", "lang", "topic").alias("__cell"), weight.alias("__weight")
    )
    cell = F.struct(F.col("source"), F.col("lang"), F.col("__topic").alias("topic"))
    met = marked.join(weights, cell.eqNullSafe(F.col("__cell")), "left").drop("__cell")
    return met.withColumn("__copies", F.floor(F.col("__weight") + draw(F.col(doc_id))).cast("int"))


def sampled(docs: DataFrame, **options) -> DataFrame:
    """The documents taken, each at most once, with their own columns. Equal ids are taken
    together or not at all, if they are of one cell."""
    found = mix(docs, once=True, **options).where("__copies > 0")
    return found.select(*(F.col(f"`{c}`") for c in docs.columns))


def marginals(
    mixed: DataFrame, powers: Mapping[str, float] = POWERS, token_share: float = TOKEN_SHARE
) -> DataFrame:
    """What `mix` delivers: dimension, value, and the tokens wanted, reachable (no document
    twice), expected (by weights) and taken (by copies)."""
    tokens_of = F.col("__tokens")
    rows = stored(
        mixed.groupBy("source", "lang", F.col("__topic").alias("topic")).agg(
            F.sum("__tokens").cast("double").alias("tokens"), F.sum(tokens_of * F.col("__weight")).alias("expected"),
            F.sum(tokens_of * F.col("__copies")).cast("double").alias("taken"),
        ),
        "marginals",
    )
    goal, parts = token_share * (rows.agg(F.sum("tokens")).first()[0] or 0.0), []
    for d in DIMENSIONS:
        sums = rows.groupBy(d).agg(F.sum("expected").alias("expected"), F.sum("taken").alias("taken"))
        wanted = tempered(rows, d, powers[d]).select(F.col(d).alias("value"), (F.col("target") * goal).alias("wanted"))
        most = reachable(rows, d, powers[d], goal).select(F.col(d).alias("__value"), F.col("target").alias("reachable"))
        met = wanted.join(most, wanted["value"].eqNullSafe(most["__value"])).join(sums, F.col("value").eqNullSafe(sums[d]))
        parts.append(met.select(F.lit(d).alias("dimension"), "value", "wanted", "reachable", "expected", "taken"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def oracle(documents: str = "documents", rounds: int = ROUNDS) -> str:
    """The registered query in DuckDB's SQL; one statement per scaling."""
    text = f"""
WITH rows AS (
  SELECT doc_id, source, lang,
    CASE WHEN text IS NULL THEN 'none' WHEN contains(text, ' | ') THEN 'table'
         WHEN contains(text, 'icense') THEN 'legal' WHEN contains(text, '@') THEN 'contact'
         WHEN contains(text, '***') OR contains(text, '###') OR contains(text, '%%%') THEN 'noise'
         ELSE 'prose' END AS topic,
    CASE WHEN coalesce(length(text), 0) > 0
         THEN length(text) - length(replace(text, ' ', '')) + 1 ELSE 0 END AS tokens
  FROM {documents}),
cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM rows GROUP BY ALL)"""
    for d in DIMENSIONS:
        text += f""",
t_{d} AS (SELECT {d}, p / sum(p) OVER () AS target FROM (
  SELECT {d}, pow(sum(tokens), {POWERS[d]}) AS p FROM cells GROUP BY ALL HAVING sum(tokens) > 0))"""
    text += ",\nw0 AS (SELECT *, tokens AS w FROM cells)"
    steps = [d for _ in range(rounds) for d in DIMENSIONS]
    for i, d in enumerate(steps):
        text += f""",
w{i + 1} AS MATERIALIZED (
  SELECT w{i}.* REPLACE (coalesce(w * target / nullif(sum(w) OVER (PARTITION BY w{i}.{d}), 0), 0) AS w)
  FROM w{i} LEFT JOIN t_{d} ON w{i}.{d} IS NOT DISTINCT FROM t_{d}.{d})"""
    return text + f"""
SELECT doc_id, r.source, r.lang, r.topic, r.tokens::BIGINT AS tokens, round(weight, 6) AS weight,
  floor(weight + ('0x' || substr(md5('mix/' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0)::INTEGER AS copies
FROM (SELECT r.*, coalesce(w * ({TOKEN_SHARE} * (SELECT sum(tokens) FROM cells)) / nullif(c.tokens, 0), 0) AS weight
      FROM rows r JOIN w{len(steps)} c
        ON r.source IS NOT DISTINCT FROM c.source AND r.lang IS NOT DISTINCT FROM c.lang AND r.topic = c.topic) r"""
