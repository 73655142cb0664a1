"""Questions over parsed ingredient lines.

``lines`` stands for (recipe, cleaned, weight, ...): one row per ingredient
line. A recipe or an ingredient may hold any share of the rows: totals are
combined on the map side, and joins back to the lines are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.normalize import join_hot_apart
from larder.operators.ranking import with_running
from larder.operators.similar import clusters
from larder.session import materialize


def ingredient_weights(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grams per (recipe, ingredient): the small form the questions below share."""
    return lines.groupBy(*keys, "cleaned").agg(F.sum("weight").alias("grams"))


def weight_shares(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each ingredient's grams and its share of the recipe's weight."""
    grams = ingredient_weights(lines, keys)
    totals = grams.groupBy(*keys).agg(F.sum("grams").alias("total"))
    # one row per ingredient by now: no recipe is a hot key
    return grams.join(totals, list(keys)).select(
        *keys, "cleaned", "grams", F.try_divide("grams", "total").alias("share")
    )


def search(
    lines: DataFrame, keys: Sequence[str], all_of: Sequence[str], none_of: Sequence[str] = ()
) -> DataFrame:
    """Recipes with every ingredient of ``all_of`` and none of ``none_of``.

    One filtered pass and one aggregation of flags: nothing but a row of
    booleans per recipe is shuffled.
    """
    wanted = [*all_of, *none_of]
    flags = [F.max(F.col("cleaned") == w).alias(f"_has{i}") for i, w in enumerate(wanted)]
    found = lines.where(F.col("cleaned").isin(wanted)).groupBy(*keys).agg(*flags)
    test = F.lit(True)
    for i in range(len(all_of)):
        test = test & F.col(f"_has{i}")
    for i in range(len(all_of), len(wanted)):
        test = test & ~F.col(f"_has{i}")
    if not all_of:
        hit = found.where(~test).select(*keys)
        return lines.select(*keys).distinct().join(hit, list(keys), "left_anti")
    return found.where(test).select(*keys)


def title_key(title: Column | str) -> Column:
    """The words of a title: lower case, sorted, distinct."""
    t = F.col(title) if isinstance(title, str) else title
    words = F.filter(F.split(F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    return F.array_join(F.array_sort(F.array_distinct(words)), " ")


def title_clusters(titles: DataFrame, keys: Sequence[str], similarity: float = 0.8) -> DataFrame:
    """(keys..., cluster): recipes whose titles have similar word sets, directly or through other titles.

    Each distinct word set is compared once, however many recipes carry it. The
    cluster is named by its smallest word set; titles without words are one cluster.
    ``titles`` is read once: its word sets are stored, and counted and looked up from there.
    """
    named = materialize(titles.where(F.col("title").isNotNull()).select(*keys, title_key("title").alias("title_key")), "title_keys")
    sets = materialize(named.groupBy("title_key").agg(F.count(F.lit(1)).alias("_rows")), "titles")
    found = clusters(sets.withColumn("words", F.split("title_key", " ")).where("title_key <> ''"), "title_key", "words", similarity)
    table = materialize(
        sets.join(found, "title_key", "left").select("title_key", "_rows", F.coalesce("cluster", "title_key").alias("cluster")), "clusters")
    return join_hot_apart(named, table, "title_key", ["cluster"], keys).select(*keys, "cluster")


def averaged_recipes(lines: DataFrame, titles: DataFrame, keys: Sequence[str], similarity: float = 0.8) -> DataFrame:
    """Mean share of each ingredient over all recipes of a title cluster (absent counts as 0).

    ``titles(keys..., title)``. Shares are summed per (cluster, ingredient) with
    a map-side combine, so a title half the recipes carry is no single task.
    """
    grouped = materialize(title_clusters(titles, keys, similarity), "grouped")
    sizes = grouped.groupBy("cluster").agg(F.count(F.lit(1)).alias("recipes"))
    shares = weight_shares(lines, keys).join(grouped, list(keys))
    summed = shares.groupBy("cluster", "cleaned").agg(F.sum("share").alias("_sum"))
    return summed.join(sizes, "cluster").select(
        "cluster", "cleaned", "recipes", (F.col("_sum") / F.col("recipes")).alias("mean_share")
    )


def coverage(lines: DataFrame, share: float = 0.9) -> DataFrame:
    """The fewest ingredients that cover ``share`` of all lines, most used first."""
    counts = lines.groupBy("cleaned").agg(F.count(F.lit(1)).alias("n"))
    ranked = with_running(counts, [F.desc("n"), F.col("cleaned")], {"running": "n"}, "rank")
    total = ranked.agg(F.sum("n").alias("t")).scalar()  # the ranked table is stored: no second pass over the lines
    needed = (F.col("running") - F.col("n")) < total * F.lit(share)
    return ranked.where(needed).select("rank", "cleaned", "n", (F.col("running") / total).alias("covered"))


def simple_and_good(recipes: DataFrame, min_rating: float, max_lines: int, line_count: Column) -> DataFrame:
    """Recipes at or above a rating with at most ``max_lines`` ingredients."""
    return recipes.where((F.col("misc.rating") >= min_rating) & (line_count <= max_lines))
