"""Registered queries: one per operator, over the views of :mod:`larder.plans.views`."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import urls
from larder.functions.text import percent_ratio, rating_ratio, stripped_text
from larder.operators import analytics as an
from larder.operators import dom, extract, frontier, links
from larder.operators.dom import Sel
from larder.operators.joins import spread_join
from larder.plans import line_queries, more_queries
from larder.plans import views as v

Query = Callable[[SparkSession, str], DataFrame]


def analytics() -> dict[str, Query]:
    def usable(s: SparkSession, d: str) -> DataFrame:
        return an.drop_missing(v.recipes(s, d), ["title", "ingredients"])

    return {
        "a1_preview": lambda s, d: an.preview(v.recipes(s, d), ["domain", "path"]).select("domain", "path", "title"),
        "a2_row_count": lambda s, d: an.row_count(v.recipes(s, d)),
        "a3_missing_titles": lambda s, d: an.missing(v.recipes(s, d), "title").select("domain", "path"),
        "a4_drop_missing": lambda s, d: usable(s, d).select("path", "title"),
        "a5_reindex": lambda s, d: an.reindex(usable(s, d).select("domain", "path"), ["domain", "path"]),
        "a6_title_value_counts": lambda s, d: an.value_counts(v.recipes(s, d), "title", 10),
        "a7_title_equals": lambda s, d: v.recipes(s, d)
        .where(F.col("title") == "blue bolt pie")
        .select("domain", "path", "title"),
        "a8_part_count": lambda s, d: an.value_counts(
            v.recipes(s, d).select(an.part_count("ingredients").alias("parts")), "parts"
        ),
        "a9_ingredient_count": lambda s, d: v.recipes(s, d)
        .where(F.col("ingredients").isNotNull())
        .select("path", an.line_count("ingredients").alias("ingredient_count")),
        "a10_mean_ingredient_count": lambda s, d: v.recipes(s, d).agg(
            F.avg(an.line_count("ingredients")).alias("mean_count")
        ),
        "a11_site_url": lambda s, d: v.recipes(s, d).select("path", an.site_url("domain", "path").alias("url")),
        "a12_histogram": lambda s, d: an.histogram(
            v.recipes(s, d).select(an.line_count("ingredients").alias("n_lines")), "n_lines"
        ).select("bin", F.round("left_edge", 9).alias("left_edge"), "n", F.round("density", 9).alias("density")),
        "a13_title_variants": lambda s, d: an.title_variants(v.recipes(s, d)),
    }


OWN_HOST = "www.ththhe.example.com"


def _page_urls(s: SparkSession, d: str) -> DataFrame:
    return v.table(s, d, "pages").select("page_id", "url").withColumn("parts", urls.url_parts("url"))


def _site_links(s: SparkSession, d: str, allow: tuple[str, ...] = ()) -> DataFrame:
    parsed = dom.parse_pages(v.site_pages(s, d), keep=("a",), outer=("a",), with_text=False)
    return links.page_links(parsed, ["path"], allow).withColumnRenamed("path", "src")


def url_and_link() -> dict[str, Query]:
    def hrefs(s: SparkSession, d: str) -> DataFrame:
        """Every way a page of the table could be linked to."""
        p = _page_urls(s, d).where(F.col("parts.domain").isNotNull())
        dom_, path = F.col("parts.domain"), F.col("parts.path")
        forms = F.array(
            F.col("url"),
            F.concat(F.lit("//"), dom_, path),
            F.concat(F.lit("/.."), path),
            path,
            F.substring(path, F.lit(2), F.length(path)),
            F.concat(F.lit("//"), dom_),
        )
        return p.select("page_id", F.posexplode(forms).alias("form", "href"))

    def resolved(s: SparkSession, d: str) -> DataFrame:
        return hrefs(s, d).withColumn("t", urls.resolve_href("href")).select(
            "page_id", "form", "t.domain", "t.path", F.col("t.error").isNotNull().alias("failed")
        )

    def resolved_site(s: SparkSession, d: str) -> DataFrame:
        return links.resolve_links(_site_links(s, d))

    rules = links.LinkRules(avoid=("private",))
    return {
        "s3_stored_file_key": lambda s, d: _page_urls(s, d)
        .withColumn("file_name", urls.path_to_file_name("parts.path"))
        .select("page_id", "file_name", urls.file_name_to_path("file_name").alias("path")),
        "l1_url_parts": lambda s, d: _page_urls(s, d).select("page_id", "parts.scheme", "parts.domain", "parts.path"),
        "l2_seed_base_url": lambda s, d: _page_urls(s, d)
        .withColumn("base_url", urls.base_url(F.col("parts")))
        .where(F.col("base_url").isNotNull())
        .select("page_id", "base_url"),
        "l3_page_links": lambda s, d: links.page_links(
            dom.parse_pages(v.table(s, d, "pages"), keys=["page_id"], keep=("a",), with_text=False), ["page_id"]
        ).select("page_id", "pos", "href"),
        "l3_allowed_links": lambda s, d: _site_links(s, d, ("/o/", "/s/", "o/../", "two/")).select("src", "href"),
        "l4_resolve_href": resolved,
        "l5_same_domain": lambda s, d: _page_urls(s, d).select(
            "page_id", urls.same_domain("parts.domain", F.lit(OWN_HOST)).alias("internal")
        ),
        "l6_visible_links": lambda s, d: _site_links(s, d).where(urls.visible("outer_html")).select("src", "href"),
        "l7_avoided_links": lambda s, d: resolved_site(s, d)
        .where(F.col("path").isNotNull() & ~urls.contains_any("path", rules.avoid))
        .select("src", "path"),
        "l8_tidy_paths": lambda s, d: resolved_site(s, d).where(urls.tidy_path("path")).select("src", "path"),
        "l9_unseen_links": lambda s, d: links.unseen(
            resolved_site(s, d)
            .where(F.col("error").isNull())
            .select(F.coalesce("domain", F.lit(v.MARKET)).alias("domain"), "path"),
            v.crawl_state(s, d),
        ),
        "l10_admitted_links": lambda s, d: links.admit(_site_links(s, d), v.MARKET, rules, v.crawl_state(s, d)),
    }


RECIPE_MARK = (Sel("h2", id="recipe-page", text=r"(?i)^\s*Ingredients\s*$"),)
CRAWL_LIMIT = 1000


def crawl() -> dict[str, Query]:
    def paths(s: SparkSession, d: str) -> DataFrame:
        return v.site_nodes(s, d)

    def held(s: SparkSession, d: str, *states: str) -> DataFrame:
        return v.crawl_state(s, d).where(F.col("state").isin(*states)).select("path")

    def marked(s: SparkSession, d: str) -> DataFrame:
        return frontier.classify(
            v.site_pages(s, d), ["path"], predicate=dom.has_element(*RECIPE_MARK), keep=("h2",)
        )

    def reached(s: SparkSession, d: str) -> DataFrame:
        return frontier.reach(links_of(s, d), ["/"])

    def links_of(s: SparkSession, d: str) -> DataFrame:
        """The site's links, and one to a page that does not exist on each region page."""
        lost = v.table(s, d, "region").select(
            F.concat(F.lit("/r/"), F.col("r_regionkey").cast("string")).alias("src"),
            F.concat(F.lit("/lost/"), F.col("r_regionkey").cast("string")).alias("dst"),
        )
        return v.site_edges(s, d).unionByName(lost).withColumn("domain", F.lit(v.MARKET))

    def roots(s: SparkSession, *domains: str) -> DataFrame:
        return s.createDataFrame([(x, "/") for x in domains], "domain string, path string")

    def limited(s: SparkSession, d: str) -> DataFrame:
        held_pages = corpus(s, d).withColumn("domain", F.lit(v.MARKET))
        return frontier.closure(links_of(s, d), roots(s, v.MARKET), held_pages, CRAWL_LIMIT)

    def crawled(s: SparkSession, d: str, limit: int | None = None) -> DataFrame:
        return frontier.crawl(
            v.two_sites(s, d), roots(s, v.MARKET, v.SECOND), links.LinkRules(avoid=("private",)),
            predicate=dom.has_element(*RECIPE_MARK), keep=("h2",), limit=limit,
        )

    def corpus(s: SparkSession, d: str) -> DataFrame:
        return paths(s, d).withColumn("scrapable", F.lit(False))

    def listing(s: SparkSession, d: str) -> DataFrame:
        parsed = dom.parse_pages(v.listing_pages(s, d), keys=["page_no"], keep=("h1",))
        end = dom.has_element(Sel("h1", text=frontier.END_HEADING))
        return parsed.select("page_no", end(F.col("nodes"), F.col("text")).alias("is_end"))

    return {
        "f1_reachable": reached,
        "f1_reachable_from_two": lambda s, d: frontier.reach(v.site_edges(s, d), ["/n/3", "/r/1"]).select("path"),
        "f1_crawl_pages": lambda s, d: crawled(s, d).select("domain", "path", "depth", "state"),
        "f2_page_limit": lambda s, d: limited(s, d).select("path", "depth", "state", "position"),
        "f2_limit_by_site": lambda s, d: crawled(s, d, CRAWL_LIMIT).select("domain", "path", "depth", "state", "position"),
        "f3_set_union": lambda s, d: frontier.add_to_set(held(s, d, "in_progress", "to_scrape"), paths(s, d)),
        "f4_set_difference": lambda s, d: frontier.remove_from_set(paths(s, d), held(s, d, "finished")),
        "f5_state_sizes": lambda s, d: frontier.state_sizes(v.crawl_state(s, d)),
        "f5_membership": lambda s, d: frontier.in_set(paths(s, d), held(s, d, "errored")),
        "f6_page_states": lambda s, d: frontier.page_states(
            reached(s, d).select("path"), marked(s, d)
        ),
        "f7_redirects": lambda s, d: frontier.redirect_states(paths(s, d), v.redirects(s, d)),
        "f7_reach_redirected": lambda s, d: frontier.reach(
            # links leave from where their page has moved to
            spread_join(v.site_edges(s, d), v.redirects(s, d).withColumnRenamed("old_path", "src"), ["src"], ["dst"])
            .select(F.coalesce("new_path", "src").alias("src"), "dst"),
            ["/"],
            v.redirects(s, d),
        ).select("path"),
        "f8_classify_by_path": lambda s, d: frontier.classify(
            _page_urls(s, d).select("page_id", F.col("parts.path").alias("path")), ["page_id"], r"/EN/\d+"
        ),
        "f9_classify_by_element": lambda s, d: marked(s, d).groupBy("path").agg(F.max("scrapable").alias("scrapable")),
        "f10_listing_ranges": lambda s, d: frontier.listing_ranges(
            # the pages of every third hundred are lost, and one has a wrong number
            listing(s, d).where(F.floor(F.col("page_no") / 100) % 3 != 1).select(
                F.when(F.col("page_no") == 5, F.lit(10**12)).otherwise(F.col("page_no")).alias("page_no"), F.lit(False).alias("is_end")),
            v.listing_visited(s, d).where("page_no <= 10"),
        ),
        "f10_listing_scan": lambda s, d: frontier.listing_scan(listing(s, d), v.listing_visited(s, d)),
        "f11_drain": lambda s, d: frontier.drain(v.crawl_state(s, d), v.site_pages(s, d)),
        "f12_early_stop": lambda s, d: frontier.listing_scan(
            listing(s, d), v.listing_visited(s, d), stop_after_seen=20
        ),
        "f13_resume": lambda s, d: frontier.resume(v.crawl_state(s, d), v.MARKET, "/"),
    }


def _recipe_dom(s: SparkSession, d: str, *paths: Sequence[Sel], children_of: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Recipe pages parsed for the elements on ``paths``."""
    return dom.parse_pages(
        v.recipe_pages(s, d), keys=["path"], keep=extract.tags_of(*paths), children_of=children_of
    )


def _field(name: str, *paths: Sequence[Sel], children_of: Sequence[tuple[str, str]] = ()) -> Query:
    def run(s: SparkSession, d: str) -> DataFrame:
        read = extract.fields(extract.DEFAULT_LAYOUT)[name]
        parsed = _recipe_dom(s, d, *paths, children_of=children_of)
        return parsed.select("path", read(F.col("nodes"), F.col("text")).alias(name))

    return run


def _exploded(rows: DataFrame, column: str) -> DataFrame:
    groups = rows.select("path", F.posexplode(column).alias("group_pos", "g"))
    return groups.select("path", "group_pos", F.col("g.group").alias("group"), F.posexplode("g.lines").alias("pos", "line"))


def html_and_recipes() -> dict[str, Query]:

    def page() -> tuple[Column, Column]:
        """Columns of a parsed page; made late, as the catalog is listed without a session."""
        return F.col("nodes"), F.col("text")

    lay = extract.DEFAULT_LAYOUT

    def ratings(s: SparkSession, d: str) -> DataFrame:
        return _recipe_dom(s, d, lay.review_count, lay.rating, lay.make_again).select("path", extract.ratings(*page(), lay).alias("r")).select(
            "path", "r.rating", "r.make_again", F.col("r.ratings").cast("string").alias("ratings")
        )

    def scraped(s: SparkSession, d: str) -> DataFrame:
        return extract.scrape(v.recipe_pages(s, d).drop("o_orderkey"), images=v.image_manifest(s, d))

    def per_site(s: SparkSession, d: str) -> DataFrame:
        """Two layouts: every second site names its recipes by author."""
        own = extract.SiteLayout(override={"title": lambda n, t: extract.author_names(n, t, lay.authors)})
        layouts = {f"www.site{i}.example": own if i % 2 else lay for i in range(25)}
        return extract.scrape(v.recipe_pages(s, d).drop("o_orderkey"), layouts).select("path", "title")

    def by_table(s: SparkSession, d: str) -> DataFrame:
        """A thousand sites as rows; every second one has its title and its ingredients elsewhere."""
        own = extract.SiteLayout(
            title=lay.authors, ingredient_groups=lay.instruction_groups, skip_ingredient_prefix=None, summary={"servings": "total-time"})
        table = extract.layout_table(s, {f"www.site{i}.example": own if i % 2 else lay for i in range(1000)})
        rows = extract.scrape(v.recipe_pages(s, d).drop("o_orderkey"), table)
        return rows.select("path", "title", an.part_count("ingredients").cast("string").alias("parts"), "misc.servings", "misc.prep_time")

    def ratio_texts(s: SparkSession, d: str) -> DataFrame:
        o = v.table(s, d, "orders")
        k = F.col("o_orderkey")
        return o.select(
            "o_orderkey",
            F.concat(F.lit("about "), (k % 9).cast("string"), F.lit(" / "), (k % 5).cast("string")).alias("ratio"),
            F.concat((k % 101).cast("string"), F.when(k % 2 == 0, F.lit(" %")).otherwise(F.lit(""))).alias("percent"),
        )

    return {
        "h1_node_table": lambda s, d: dom.html_nodes(dom.parse_pages(v.table(s, d, "pages"), keys=["page_id"]), ["page_id"])
        .where(F.col("tag").isin("a", "li", "h1", "article", "footer", "title", "script"))
        .groupBy("page_id", "tag")
        .agg(F.count(F.lit(1)).alias("n")),
        "h2_select_elements": lambda s, d: dom.parse_pages(v.table(s, d, "pages"), keys=["page_id"], keep=("nav", "ul", "a"))
        .select("page_id", F.explode(dom.texts_of(dom.select_all(*page(), Sel("nav"), Sel("ul"), Sel("a")), F.col("text"))).alias("label")),
        "h3_stripped_text": lambda s, d: v.table(s, d, "documents").select("doc_id", stripped_text("text").alias("text")),
        "h4_main_content": lambda s, d: extract.trim_pages(v.recipe_pages(s, d)).select(
            "path",
            F.startswith("html", F.lit('<div class="main-content')).alias("trimmed"),
            F.endswith("html", F.lit("</div>")).alias("closed"),
            F.contains("html", F.lit("<nav>")).alias("has_menu"),
        ),
        "h5_title": lambda s, d: dom.parse_pages(v.table(s, d, "pages"), keys=["page_id"], keep=("h1",)).select(
            "page_id", dom.first_text(*page(), Sel("h1")).alias("title")
        ),
        "h5_recipe_title": _field("title", lay.title),
        "h6_ingredient_groups": lambda s, d: _exploded(
            _field("ingredients", lay.ingredient_groups, (lay.group_name, lay.group_line))(s, d), "ingredients"
        ),
        "h7_instruction_groups": lambda s, d: _exploded(
            _field("instructions", lay.instruction_groups, (lay.group_name, lay.group_line))(s, d), "instructions"
        ),
        "h8_summary": lambda s, d: _recipe_dom(s, d, (lay.summary_list, Sel("dd"))).select(
            "path",
            *[extract.summary_field(*page(), lay.summary_list, c).alias(k) for k, c in lay.summary.items()],
        ),
        "h9_authors": _field("author", lay.authors),
        "h10_description": _field("description", lay.description, children_of=[("itemprop", "description")]),
        "h11_ratings": ratings,
        "h12_rating_ratio": lambda s, d: ratio_texts(s, d).select("o_orderkey", F.round(rating_ratio("ratio"), 9).alias("value")),
        "h13_percent_ratio": lambda s, d: ratio_texts(s, d).select("o_orderkey", percent_ratio("percent").alias("value")),
        "h14_images": lambda s, d: scraped(s, d).select("path", "misc.image_url", "misc.image_location"),
        "h15_image_plan": lambda s, d: extract.image_plan(
            v.site_pages(s, d),
            v.table(s, d, "orders").where(F.col("o_orderkey") % 3 == 0).select(
                urls.path_to_file_name(F.concat(F.lit("/o/"), F.col("o_orderkey").cast("string")), "png").alias("file_name")
            ),
            (Sel("div", cls="my-image"), Sel("img")),
            "src",
            "https://" + v.MARKET,
        ),
        "h15_image_plan_by_site": lambda s, d: extract.image_plan(
            v.two_sites(s, d),
            v.table(s, d, "orders").where(F.col("o_orderkey") % 3 == 0).select(
                F.when(F.col("o_orderkey") % 2 == 0, v.MARKET).otherwise(v.SECOND).alias("domain"),
                urls.path_to_file_name(F.concat(F.lit("/o/"), F.col("o_orderkey").cast("string")), "png").alias("file_name"),
            ),
            (Sel("div", cls="my-image"), Sel("img")),
            "src",
        ),
        "h16_recipe_rows": lambda s, d: scraped(s, d).select(
            "domain", "path", "title",
            an.part_count("ingredients").cast("string").alias("parts"),
            an.line_count("ingredients").cast("string").alias("lines"),
            "misc.servings", "misc.author", "misc.rating", "misc.image_location",
        ),
        "h17_site_layouts": per_site,
        "h17_layout_table": by_table,
    }


def all_queries() -> dict[str, Query]:
    return {
        **analytics(), **url_and_link(), **crawl(), **html_and_recipes(),
        **line_queries.queries(), **more_queries.insights(), **more_queries.stored(),
    }
