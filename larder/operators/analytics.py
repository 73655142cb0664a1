"""Exploration of a recipes table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.ranking import with_running

# Characters stripped from the end of a path when a link is built (a set, not a suffix).
PATH_TAIL_CHARS = ".html"


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna("any", subset=list(columns))


def reindex(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Number rows 0..n-1 in ``order``."""
    out = with_running(df, [F.col(c) for c in order], position="_position")
    return out.withColumn(name, F.col("_position") - 1).drop("_position")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; NULL is not a value; ties by value."""
    out = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )
    return out.limit(top) if top else out


def part_count(parts: Column | str) -> Column:
    """Number of named parts; NULL stays NULL."""
    c = F.col(parts) if isinstance(parts, str) else parts
    return F.when(c.isNotNull(), F.size(c))


def line_count(parts: Column | str) -> Column:
    """Lines summed over the parts; NULL stays NULL."""
    c = F.col(parts) if isinstance(parts, str) else parts
    return F.aggregate(c, F.lit(0), lambda acc, g: acc + F.size(g["lines"]))


def site_url(domain: Column | str, path: Column | str) -> Column:
    """Address on the site, trailing characters of ``.html`` stripped from the path."""
    d = F.col(domain) if isinstance(domain, str) else domain
    p = F.col(path) if isinstance(path, str) else path
    return F.concat(F.lit("https://"), d, F.lit("/"), F.rtrim(p, F.lit(PATH_TAIL_CHARS)))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from min to max, last bin closed, empty bins kept.

    One pass finds the range and the total (a one-row scalar subquery), one
    counts rows per bin.
    """
    x = F.col(column).cast("double")
    known = df.where(x.isNotNull()).select(x.alias("_x"))
    limits = known.agg(
        F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.count(F.lit(1)).alias("n")).alias("s")
    )
    lim = limits.scalar()
    # a single value gets a range of one around it
    lo = F.when(lim["lo"] == lim["hi"], lim["lo"] - 0.5).otherwise(lim["lo"])
    hi = F.when(lim["lo"] == lim["hi"], lim["hi"] + 0.5).otherwise(lim["hi"])
    counted = (
        known.withColumn("_lo", lo)
        .withColumn("_w", (hi - lo) / F.lit(bins))
        .select(F.least(F.floor((F.col("_x") - F.col("_lo")) / F.col("_w")), F.lit(bins - 1)).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    width = (hi - lo) / F.lit(bins)
    return frame.join(counted, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("left_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
        (F.coalesce("n", F.lit(0)) / (lim["n"] * width)).alias("density"),
    )


def title_variants(df: DataFrame) -> DataFrame:
    """Titles used more than once, with how many distinct contents stand behind them.

    Contents are compared by digest, so a shuffle moves 64 characters a row.
    """
    def digest(c: str) -> Column:
        return F.sha2(F.to_json(F.struct(c)), 256)

    return (
        df.where(F.col("title").isNotNull())
        .groupBy("title")
        .agg(
            F.count(F.lit(1)).alias("recipes"),
            F.count_distinct(digest("ingredients")).alias("distinct_ingredients"),
            F.count_distinct(digest("instructions")).alias("distinct_instructions"),
        )
        .where(F.col("recipes") > 1)
    )
