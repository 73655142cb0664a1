"""Queries over insights, stored tables and the incremental job, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import urls
from larder.operators import analytics as an
from larder.operators import insights as ins
from larder.operators.search import IngredientIndex
from larder.operators.normalize import conversion_table, convert, normalize
from larder.plans import views as v
from larder.plans.line_queries import CNT, CONVERSIONS, SPREAD, VOL, WT, conversions
from larder.plans.oracles import FACTS, LINES, RECIPES, URL_PARTS
from larder.session import materialize, stage_path
from larder.sources import pages as pg
from larder.sources import recipes as rs
from larder.streaming.incremental import corpus_stream, start_scrape

Query = Callable[[SparkSession, str], DataFrame]


def _parsed(s: SparkSession, d: str) -> DataFrame:
    lines = v.ingredient_lines(s, d).select("path", *SPREAD, "line")
    return normalize(lines, SPREAD)


def insights() -> dict[str, Query]:
    def shares(s: SparkSession, d: str) -> DataFrame:
        return ins.weight_shares(_parsed(s, d), ["path"]).select(
            "path", "cleaned", F.round("grams", 4).alias("grams"), F.round("share", 6).alias("share")
        )

    def portions(s: SparkSession, d: str) -> DataFrame:
        kind = F.col("p_partkey") % 3
        return v.table(s, d, "part").select(
            v.ingredient_name(F.col("p_name")).alias("ingredient"),
            F.when(kind == 0, "1/2 cup").when(kind == 1, "1 medium").otherwise("2 tablespoons").alias("measure"),
            (F.col("p_size") + 10.0).alias("grams"),
        )

    def index(s: SparkSession, d: str) -> IngredientIndex:
        """The index of all lines, filled in two appends that overlap in a third of the recipes."""
        built = IngredientIndex(s, stage_path(s, "ingredients"))
        lines = materialize(_parsed(s, d).select("path", "cleaned", "l_linenumber"), "lines")
        third = F.pmod(F.xxhash64("path"), F.lit(3))
        built.append(lines.where(third < 2))
        built.append(lines.where(third > 0))
        return built

    def named(s: SparkSession, d: str) -> DataFrame:
        """Titles as people write them: words added, repeated, in another order and case."""
        k = F.col("o_orderkey") % 4
        title = F.concat("title", F.lit(" for two"))
        return v.titled_orders(s, d).select(
            "path",
            F.when(k == 0, title)
            .when(k == 1, F.concat(F.lit("Easy "), title))
            .when(k == 2, F.concat(F.lit("For TWO: quick "), "title", F.lit("!")))
            .otherwise(F.concat(F.lit("two, two "), "title", F.lit(" (for)"))).alias("title"),
        ).where("title IS NOT NULL")

    return {
        "g1_weight_shares": shares,
        "g2_search": lambda s, d: ins.search(_parsed(s, d), ["path"], ["blue bolt"], ["red ring", "hot rod"]),
        "g2_search_without": lambda s, d: ins.search(_parsed(s, d), ["path"], [], ["red ring", "hot rod"]),
        "g2_index_search": lambda s, d: index(s, d).search(["blue bolt"], ["red ring", "hot rod"]),
        "g2_index_search_without": lambda s, d: index(s, d).search([], ["red ring", "hot rod"]),
        "g3_averaged_recipes": lambda s, d: ins.averaged_recipes(
            _parsed(s, d), v.titled_orders(s, d).select("path", "title"), ["path"]
        ).select("cluster", "cleaned", "recipes", F.round("mean_share", 6).alias("mean_share")),
        "g3_similar_titles": lambda s, d: ins.title_clusters(named(s, d), ["path"]),
        "g4_coverage": lambda s, d: ins.coverage(_parsed(s, d)).select(
            "rank", "cleaned", "n", F.round("covered", 6).alias("covered")
        ),
        "g5_rating_and_complexity": lambda s, d: ins.simple_and_good(
            v.recipes(s, d), 0.5, 3, an.line_count("ingredients")
        ).select("path"),
        "g6_grams_by_table": lambda s, d: convert(_parsed(s, d), conversions(s, d), SPREAD)
        .groupBy("cleaned")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("weight"), 4).alias("grams")),
        "g7_conversion_table": lambda s, d: conversion_table(portions(s, d)).select(
            "ingredient", F.round("per_cup", 6).alias("per_cup"), F.round("per_count", 6).alias("per_count")
        ),
    }


def insights_sql() -> dict[str, str]:
    parsed = f"""{LINES}, parsed AS (
      SELECT 'recipes/' || l_orderkey || '.html' AS path, l_orderkey, name AS cleaned,
             round(coalesce({WT}, ({VOL}) * 180, ({CNT}) * 120), 4) AS weight FROM lp)"""
    shares = f"""{parsed}, grams AS (SELECT path, l_orderkey, cleaned, sum(weight) AS grams FROM parsed GROUP BY 1, 2, 3),
      shares AS (SELECT *, grams / sum(grams) OVER (PARTITION BY path) AS share FROM grams)"""
    bad = "('red ring', 'hot rod')"
    return {
        "g1_weight_shares": f"WITH {shares} SELECT path, cleaned, round(grams, 4) AS grams, round(share, 6) AS share FROM shares",
        "g2_search": f"""WITH {parsed} SELECT path FROM parsed GROUP BY path
            HAVING bool_or(cleaned = 'blue bolt') AND NOT bool_or(cleaned IN {bad})""",
        "g2_search_without": f"WITH {parsed} SELECT path FROM parsed GROUP BY path HAVING NOT bool_or(cleaned IN {bad})",
        "g2_index_search": f"""WITH {parsed} SELECT path FROM parsed GROUP BY path
            HAVING bool_or(cleaned = 'blue bolt') AND NOT bool_or(cleaned IN {bad})""",
        "g2_index_search_without": f"WITH {parsed} SELECT path FROM parsed GROUP BY path HAVING NOT bool_or(cleaned IN {bad})",
        "g3_similar_titles": f"""WITH RECURSIVE {LINES}, first AS (
            SELECT l_orderkey, arg_min(name, pos) AS name FROM lp WHERE l_orderkey % 97 <> 0 GROUP BY 1),
          named AS (
            SELECT l_orderkey, list_distinct(string_split(name, ' ') || ['pie', 'for', 'two']
              || CASE l_orderkey % 4 WHEN 1 THEN ['easy'] WHEN 2 THEN ['quick'] ELSE [] END) AS words FROM first),
          keyed AS (SELECT l_orderkey, words, array_to_string(list_sort(words), ' ') AS title FROM named),
          sets AS MATERIALIZED (SELECT DISTINCT title, list_sort(words) AS words FROM keyed),
          linked AS MATERIALIZED (
            SELECT a.title AS a, b.title AS b FROM sets a, sets b
            WHERE len(list_intersect(a.words, b.words)) >= 0.8 * (len(a.words) + len(b.words) - len(list_intersect(a.words, b.words)))),
          walk(title, other) AS (SELECT title, title FROM sets UNION SELECT walk.title, b FROM walk JOIN linked ON a = other),
          labelled AS (SELECT title, min(other) AS cluster FROM walk GROUP BY 1)
          SELECT 'recipes/' || l_orderkey || '.html' AS path, cluster FROM keyed JOIN labelled USING (title)""",
        "g3_averaged_recipes": f"""WITH {shares}, titles AS (
            SELECT l_orderkey, arg_min(name, pos) || ' pie' AS title FROM lp WHERE l_orderkey % 97 <> 0 GROUP BY 1),
          clusters AS (SELECT *, list_aggregate(list_sort(string_split(title, ' ')), 'string_agg', ' ') AS cluster FROM titles),
          sizes AS (SELECT cluster, count(*) AS recipes FROM clusters GROUP BY 1)
          SELECT c.cluster, s.cleaned, recipes, round(sum(share) / recipes, 6) AS mean_share
          FROM shares s JOIN clusters c USING (l_orderkey) JOIN sizes z ON z.cluster = c.cluster GROUP BY 1, 2, 3""",
        "g4_coverage": f"""WITH {parsed}, c AS (SELECT cleaned, count(*) AS n FROM parsed GROUP BY 1),
          r AS (SELECT row_number() OVER w AS rank, cleaned, n, sum(n) OVER w AS running, (SELECT count(*) FROM parsed) AS total
                FROM c WINDOW w AS (ORDER BY n DESC, cleaned))
          SELECT rank, cleaned, n, round(running / total, 6) AS covered FROM r WHERE running - n < total * 0.9::DOUBLE""",
        "g5_rating_and_complexity": f"WITH {RECIPES} SELECT path FROM recipes WHERE rating >= 0.5 AND n_lines <= 3",
        "g6_grams_by_table": f"""WITH {LINES},{CONVERSIONS}
          SELECT name AS cleaned, count(*) AS n,
                 round(sum(round(coalesce({WT}, ({VOL}) * per_cup, ({CNT}) * per_count), 4)), 4) AS grams
          FROM lp JOIN conv ON ingredient = name GROUP BY 1""",
        "g7_conversion_table": """WITH p AS (
            SELECT replace(replace(p_name, 'small', 'green'), 'large', 'amber') AS ingredient, p_partkey % 3 AS kind,
                   p_size + 10.0::DOUBLE AS grams FROM part)
          SELECT ingredient, round(median(CASE kind WHEN 0 THEN grams / 0.5::DOUBLE WHEN 2 THEN grams / 0.125::DOUBLE END), 6) AS per_cup,
                 round(median(CASE kind WHEN 1 THEN grams END), 6) AS per_count FROM p GROUP BY 1""",
    }


def _failed(s: SparkSession, d: str) -> DataFrame:
    """Two kinds of failed rows, by order key."""
    facts = v.order_facts(s, d)
    k = F.col("o_orderkey")
    bad_count = rs.error_rows(facts.where(k % 50 == 0), "ValueError", F.concat(F.lit("bad count in "), "path"), "scrape")
    timeouts = rs.error_rows(facts.where(k % 70 == 0), "TimeoutError", F.lit("no answer"), "crawl", F.lit("image"))
    return bad_count.unionByName(timeouts)


def _error_log(s: SparkSession, d: str) -> DataFrame:
    target = stage_path(s, "errors")
    rs.append_errors(_failed(s, d), target)
    return rs.read_errors(s, target)


def stored() -> dict[str, Query]:
    def recipes_table(s: SparkSession, d: str) -> str:
        target = stage_path(s, "recipes")
        rs.append_recipes(v.recipes(s, d), target)
        return target

    def key_rule(s: SparkSession, d: str) -> DataFrame:
        facts = v.order_facts(s, d)
        k = F.col("o_orderkey")
        times = F.explode(F.sequence(F.lit(1), F.when(k % 4 == 0, 3).otherwise(1)))
        rows = facts.select("domain", "path", times.alias("seq"))
        known = facts.where(k % 10 == 0).select("domain", "path")
        ok, bad = rs.enforce_key(rows, ["seq"], known)
        return ok.withColumn("accepted", F.lit(True)).unionByName(bad.withColumn("accepted", F.lit(False)))

    def corpus_round_trip(s: SparkSession, d: str) -> DataFrame:
        target = stage_path(s, "corpus")
        binary = v.table(s, d, "pages").select(
            urls.url_parts("url")["path"].alias("path"), F.encode("html", "UTF-8").alias("html")
        )
        pg.write_corpus(binary, target)
        return pg.read_corpus(s, target, "any").select("path", "html")

    def saved_files(s: SparkSession, d: str) -> DataFrame:
        """Pages written as one file each, and beside them files that are none; read back from the folder."""
        target = stage_path(s, "saved")
        parts = urls.url_parts("url")
        domain = F.coalesce(parts["domain"], F.lit("unknown"))
        pages = v.table(s, d, "pages").select(domain.alias("domain"), parts["path"].alias("path"), "html")
        pg.save_pages(pages, target)
        pg.save_pages(pages, target, "txt")
        return pg.read_saved_pages(s, target).select("domain", "path", "html")

    def incremental(s: SparkSession, d: str) -> DataFrame:
        """Two batches of the corpus, with a restart between them; the second repeats half of the first."""
        root = stage_path(s, "stream")
        pages = v.recipe_pages(s, d)
        k = F.col("o_orderkey")
        for batch in (pages.where(k % 2 == 0), pages.where((k % 2 == 1) | (k % 4 == 0))):
            pg.write_corpus(batch, f"{root}/corpus")
            run = start_scrape(corpus_stream(s, f"{root}/corpus", "any.example"), f"{root}/recipes", f"{root}/errors", f"{root}/state")
            run.awaitTermination()
        done = rs.read_recipes(s, f"{root}/recipes").select("path", "title", F.lit("stored").alias("outcome"))
        twice = rs.read_errors(s, f"{root}/errors").select("path", F.lit(None).cast("string").alias("title"), F.col("error_type").alias("outcome"))
        return done.unionByName(twice)

    return {
        "s1_scan_saved_files": saved_files,
        "s1_scan_html_paths": lambda s, d: v.table(s, d, "pages")
        .select("page_id", urls.url_parts("url")["path"].alias("path"))
        .where(F.endswith("path", F.lit(".html"))),
        "s2_corpus_round_trip": corpus_round_trip,
        "s4_read_one_domain": lambda s, d: rs.read_recipes(s, recipes_table(s, d), "www.site7.example").select("path", "title"),
        "s5_append_nested": lambda s, d: rs.read_recipes(s, recipes_table(s, d)).select(
            "domain", "path",
            an.part_count("ingredients").cast("string").alias("parts"),
            an.line_count("ingredients").cast("string").alias("lines"),
            "misc.servings", "misc.author", "misc.rating",
        ),
        "s6_key_rule": key_rule,
        "s7_error_log": lambda s, d: _error_log(s, d).select(
            "path", "error_type", F.col("error_message")[0].alias("message"), "note", "stage"
        ),
        "s8_error_counts": lambda s, d: rs.error_counts(_error_log(s, d)),
        "t1_incremental_scrape": incremental,
    }


def stored_sql() -> dict[str, str]:
    w, f = f"WITH {RECIPES}", f"WITH {FACTS}"
    errors = f"""{f}, errors AS (
        SELECT path, 'ValueError' AS error_type, 'bad count in ' || path AS message, NULL AS note, 'scrape' AS stage
        FROM facts WHERE o_orderkey % 50 = 0
        UNION ALL SELECT path, 'TimeoutError', 'no answer', 'image', 'crawl' FROM facts WHERE o_orderkey % 70 = 0)"""
    return {
        "s1_scan_saved_files": f"WITH {URL_PARTS} SELECT CASE WHEN length(path) > 1 THEN domain ELSE 'unknown' END AS domain, "
        "CASE WHEN length(path) > 1 THEN ltrim(path, '/') ELSE url END AS path, html FROM url_parts",
        "s1_scan_html_paths": f"WITH {URL_PARTS} SELECT page_id, path FROM url_parts WHERE path LIKE '%.html'",
        "s2_corpus_round_trip": f"""WITH {URL_PARTS} SELECT CASE WHEN length(path) > 1 THEN ltrim(path, '/') ELSE url END AS path,
            html FROM url_parts""",
        "s4_read_one_domain": f"{w} SELECT path, title FROM recipes WHERE c_nationkey = 7",
        "s5_append_nested": f"""{w} SELECT domain, path, CAST(n_parts AS VARCHAR) AS parts, CAST(n_lines AS VARCHAR) AS lines,
            servings, author, rating FROM recipes""",
        "s6_key_rule": f"""{f} SELECT domain, path, CAST(t.seq AS INTEGER) AS seq, t.seq = 1 AND o_orderkey % 10 <> 0 AS accepted
            FROM facts, (VALUES (1), (2), (3)) t(seq) WHERE t.seq = 1 OR o_orderkey % 4 = 0""",
        "s7_error_log": f"{errors} SELECT * FROM errors",
        "s8_error_counts": f"{errors} SELECT error_type, count(*) AS n FROM errors GROUP BY 1",
        "t1_incremental_scrape": f"""{w} SELECT path, title, 'stored' AS outcome FROM recipes
            UNION ALL SELECT path, NULL, 'UniqueViolation' FROM recipes WHERE o_orderkey % 4 = 0""",
    }
