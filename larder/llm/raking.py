"""Mixing documents to target weights by iterative proportional fitting.

Documents fall into cells of (source, language, topic). The cells' token weights
are raked: scaled in turn so that each margin meets its target, round after
round. A cell's calibrated weight over its own share is what its documents should
count; the sampling probability follows from it. Columns and SQL functions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Stages, fresh, unit_hash, without

NONE = "(none)"


def word_count(text: Column) -> Column:
    """Runs of other than blank, tab and line ends; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\r\\n]+")), F.lit(0)).cast("long")


def kind_of_text(text: Column, words: Column) -> Column:
    """A plain topic: licence notes, texts with an address, long and short prose."""
    return (F.when(text.contains("icense"), "licence").when(text.contains("@"), "contact")
            .when(words >= 800, "long prose").otherwise("short prose"))


def raked_weights(cells: DataFrame, margins: Sequence[str], power: float, rounds: int, stages: Stages,
                  targets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``cells`` (margins, tokens) with ``share`` and the raked share ``w``.

    A margin's target is its token share to ``power``, scaled to sum to one, or
    the table (value, target) given in ``targets``; values without a target keep
    weight 0. Margins are totalled before they meet the cells again, so that a
    value with very many cells is split like any other join.
    """
    total = cells.agg(F.sum("tokens").alias("total"))
    now = stages.keep(cells.where("tokens > 0").crossJoin(F.broadcast(total)).select(
        *margins, "tokens", (F.col("tokens") / F.col("total")).alias("share"), (F.col("tokens") / F.col("total")).alias("w")),
        "cells")  # the total is one row
    goals = {}
    for m in margins:
        if targets and m in targets:
            own = targets[m].select(F.col("value").alias(m), F.col("target").cast("double").alias("part"))
        else:
            own = now.groupBy(m).agg(F.pow(F.sum("share"), F.lit(power)).alias("part"))
        scale = own.agg(F.sum("part").alias("all"))
        goals[m] = stages.keep(own.crossJoin(F.broadcast(scale)).select(m, (F.col("part") / F.col("all")).alias("goal")), "goal")
    for _ in range(rounds):
        step = now
        for m in margins:
            have = step.groupBy(m).agg(F.sum("w").alias("have")).join(goals[m], m, "left").select(
                F.col(m).alias("value"), F.when(F.col("have") > 0, F.coalesce("goal", F.lit(0.0)) / F.col("have")).alias("factor"))
            step = step.join(have, step[m] == have["value"]).select(
                *margins, "tokens", "share", (F.col("w") * F.coalesce("factor", F.lit(0.0))).alias("w"))
        after = stages.keep(step, "cells")
        stages.drop(now)
        now = after
    return now


def mix(docs: DataFrame, key: str = "doc_id", source: Column | str = "source", lang: Column | str = "lang",
        topic: Column | None = None, text: str = "text", keep: float = 0.7, power: float = 0.5, rounds: int = 8,
        salt: str = "mix", targets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``docs`` with ``topic``, ``n_tokens``, ``weight``, ``probability`` and ``sampled``.

    ``weight`` is the raked share of the document's cell over its actual share;
    the probability is min(1, ``keep`` * weight), so ``keep`` of all tokens stay
    where no cell is short of its target. A document is sampled if the hash of
    its key is below its probability: the same at every run and in any order.
    Null sources and languages are cells of their own. Documents without tokens
    carry no weight to rake: they count 1. ``targets`` gives tables (value,
    target) for "source", "lang" or "topic"; other margins keep their shares to
    ``power``. Columns of these names in ``docs`` are replaced.
    """
    stages = Stages(docs.sparkSession, "raking")
    c = lambda x: F.col(x) if isinstance(x, str) else x
    whole = F.coalesce(F.col(text), F.lit(""))
    new = ["topic", "n_tokens", "weight", "probability", "sampled"]
    topic = kind_of_text(whole, word_count(whole)) if topic is None else topic
    names = {m: fresh(docs, f"_{m}") for m in ("source", "lang", "topic", "n", "weight")}
    margins, n, own = [names[m] for m in ("source", "lang", "topic")], names["n"], names["weight"]
    told = docs.select("*", *[F.coalesce(x, F.lit(NONE)).alias(m) for m, x in zip(margins, (c(source), c(lang), topic), strict=True)],
                       word_count(whole).alias(n))
    cells = told.groupBy(*margins).agg(F.sum(n).alias("tokens"))
    goals = {names[m]: t for m, t in (targets or {}).items()}
    rates = raked_weights(cells, margins, power, rounds, stages, goals).select(
        *margins, F.round(F.col("w") / F.col("share"), 6).alias(own))
    out = without(told, new).join(rates, margins, "left").withColumn(own, F.coalesce(own, F.lit(1.0)))
    chance = F.round(F.least(F.lit(1.0), F.lit(keep) * F.col(own)), 6)
    kept = [x for x in out.columns if x not in (*margins, n, own)]
    return out.select(*[F.col(f"`{x}`") for x in kept], F.col(margins[2]).alias("topic"), F.col(n).alias("n_tokens"),
                      F.col(own).alias("weight"), chance.alias("probability"),
                      (unit_hash(F.coalesce(F.col(key).cast("string"), F.lit("")), salt) < chance).alias("sampled"))


def mix_sql(table: str, keep: float = 0.7, power: float = 0.5, rounds: int = 8, salt: str = "mix") -> str:
    """CTEs ``told`` (documents with topic and n_tokens) and ``mixed`` (with weight, probability, sampled) over ``table``."""
    words = "len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\r\\n]+'))"
    out = [f"""told AS MATERIALIZED (SELECT *, coalesce(source, '{NONE}') AS s, coalesce(lang, '{NONE}') AS l, {words} AS n_tokens,
  CASE WHEN contains(coalesce(text, ''), 'icense') THEN 'licence' WHEN contains(coalesce(text, ''), '@') THEN 'contact'
    WHEN {words} >= 800 THEN 'long prose' ELSE 'short prose' END AS topic FROM {table})""",
           """sums AS (SELECT s, l, topic, sum(n_tokens)::DOUBLE AS tokens FROM told GROUP BY ALL),
r0 AS MATERIALIZED (SELECT s, l, topic, tokens / sum(tokens) OVER () AS share, tokens / sum(tokens) OVER () AS w
  FROM sums WHERE tokens > 0)"""]
    for m in ("s", "l", "topic"):
        out.append(f"""goal_{m} AS MATERIALIZED (SELECT {m}, part / sum(part) OVER () AS goal
  FROM (SELECT {m}, pow(sum(share), {power}) AS part FROM r0 GROUP BY {m}))""")
    k = 0
    for _ in range(rounds):
        for m in ("s", "l", "topic"):
            out.append(f"""r{k + 1} AS MATERIALIZED (SELECT s, l, topic, share, w * (goal / sum(w) OVER (PARTITION BY {m})) AS w
  FROM r{k} JOIN goal_{m} USING ({m}))""")
            k += 1
    out.append(f"""mixed AS (SELECT *, round(least(1.0, {keep} * weight), 6) AS probability,
    ('0x' || substr(md5('{salt}' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT / 4294967296.0
      < round(least(1.0, {keep} * weight), 6) AS sampled
  FROM (SELECT told.*, coalesce(round(w / share, 6), 1.0) AS weight FROM told LEFT JOIN r{k} USING (s, l, topic)))""")
    return ",\n".join(out)
