"""Crawl sets over a page corpus: what is reachable, in which state pages end.

Pages are known by (domain, path). Links, corpus and visited pages are tables in
the shared folder, cut into folders by the hash of that key, so a level of a
crawl reads the folders its frontier falls in and no others. Each level is
stored before the next: plans stay short and lost executors cost a task, not the
crawl.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.dom import parse_pages
from larder.operators.joins import heavy_keys, spread_join
from larder.operators.links import LinkRules, anchor_array, followable, resolve_links
from larder.operators.ranking import with_running
from larder.session import delete_path, discard, materialize, stage_path

# Fixed value: the heading behind the last listing page.
END_HEADING = r"(?i)Don't\s+Cry"

PAGE = ["domain", "path"]
MOST_BUCKETS = 1024  # folders of a table; more data makes larger folders


class PageTables:
    """Tables keyed by (domain, path), in folders ``bucket=...`` by the hash of the key."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, stage_path(spark, "crawl")
        self.buckets = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8), MOST_BUCKETS)

    def place(self, pages: DataFrame) -> DataFrame:
        return pages.withColumn("bucket", F.pmod(F.xxhash64(*PAGE), F.lit(self.buckets)).cast("int"))

    def store(self, rows: DataFrame, name: str) -> DataFrame:
        """Write rows with a ``bucket``; a crowded folder is dealt over several writers, small ones share one."""
        here = f"{self.root}/{name}"
        rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(here)
        return self.read(rows, name)

    def read(self, like: DataFrame, name: str) -> DataFrame:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    @staticmethod
    def near(table: DataFrame, pages: DataFrame) -> DataFrame:
        """The folders of ``table`` that keys of ``pages``, a stored table, fall in: at most as many numbers as folders."""
        wanted = [r.bucket for r in pages.select("bucket").distinct().collect()]
        return table.where(F.col("bucket").isin(wanted))


def closure(
    edges: DataFrame,
    seeds: DataFrame,
    corpus: DataFrame | None = None,
    limit: int | None = None,
    redirects: DataFrame | None = None,
    max_depth: int | None = None,
) -> DataFrame:
    """(domain, path, depth) of all pages reachable from ``seeds(domain, path)`` over ``edges(domain, src, dst)``.

    Breadth first, a level at a time, until a level brings nothing new. Links
    stay inside a domain. With ``redirects(domain, old_path, new_path)`` a moved
    page is followed one hop and expanded at its new path.

    With ``corpus(domain, path, scrapable)`` each page has a ``state``: errored
    where the corpus lacks it, to_scrape or finished. With ``limit`` each domain
    stops at its ``limit``-th page in the order (depth, path), given as
    ``position``: errored pages count, but only a success stops the crawl, so the
    last page is the first success at or beyond the limit. The count goes from
    level to level, and a domain that has ended is expanded no further.
    """
    spark = edges.sparkSession
    tables = PageTables(spark)
    key = ["bucket", *PAGE]
    hubs = edges.select("domain", F.col("src").alias("path"), "dst")
    links = tables.store(tables.place(hubs), "links")
    heavy = heavy_keys(links, PAGE)
    if corpus is not None:
        known = corpus.groupBy(*PAGE).agg(F.max("scrapable").alias("scrapable"))
        corpus = tables.store(tables.place(known), "corpus")
    if redirects is not None:
        # one target a page, the same at every level
        redirects = materialize(redirects.groupBy("domain", "old_path").agg(F.min("new_path").alias("new_path")), "redirects")
    counts = None
    level, depth = seeds.select(*PAGE).distinct(), 0
    while True:
        if redirects is not None:
            level = follow_redirects(level, redirects).select(*PAGE).distinct()
        level = tables.place(level)
        if depth:
            found = tables.store(level, f"found-{depth}")
            visited = tables.read(level.withColumn("depth", F.lit(0)), "pages")
            level = found.join(PageTables.near(visited, found), key, "left_anti")
        here = f"pages/depth={depth}"
        new = tables.store(level, here)
        if depth:
            delete_path(spark, f"{tables.root}/found-{depth}")
        if new.isEmpty():
            break
        frontier = new
        if corpus is not None:
            ends = new.join(PageTables.near(corpus, new), key, "left").select(*key, page_state(F.col("scrapable")).alias("state"))
            if limit is not None:
                ends, counts = cut_at_limit(ends, limit, counts)
            frontier = tables.store(ends, f"ends/depth={depth}")
            if limit is not None:
                frontier = frontier.join(counts.where("NOT ended"), "domain", "left_semi")
        if depth == max_depth:
            break
        level = spread_join(PageTables.near(links, new), frontier.select(*key), key, ["dst"], "left_semi", heavy).select(
            "domain", F.col("dst").alias("path")).distinct()
        depth += 1
    delete_path(spark, f"{tables.root}/links")
    if corpus is None:
        return spark.read.schema("domain string, path string, depth int").parquet(f"{tables.root}/pages")
    delete_path(spark, f"{tables.root}/corpus")
    columns = "domain string, path string, state string" + (", position long" if limit is not None else "")
    return spark.read.schema(columns + ", depth int").parquet(f"{tables.root}/ends")


def page_state(scrapable: Column) -> Column:
    return F.when(scrapable.isNull(), "errored").when(scrapable, "to_scrape").otherwise("finished")


def cut_at_limit(level: DataFrame, limit: int, counts: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """One level's pages up to the limit of their domain, with ``position``; and per domain the pages so far and whether it ended.

    Positions are global ones in the order (domain, path), less where the domain begins.
    """
    ranked = materialize(with_running(level, [F.col(c) for c in PAGE], position="place"), "level")
    starts = ranked.groupBy("domain").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("here"))
    if counts is not None:
        starts = starts.join(counts.select("domain", F.col("n").alias("before")), "domain", "left")
    else:
        starts = starts.withColumn("before", F.lit(0).cast("long"))
    starts = starts.select("domain", "here", F.coalesce("before", F.lit(0)).alias("before"), "start")
    placed = spread_join(ranked, starts, ["domain"], ["path"]).withColumn("position", F.col("place") - F.col("start") + 1 + F.col("before"))
    placed = materialize(placed, "placed")
    success = placed.where((F.col("position") >= limit) & (F.col("state") != "errored"))
    last = success.groupBy("domain").agg(F.min("position").alias("last"))
    new = placed.select("domain", "here", "before").distinct().join(last, "domain", "left").select(
        "domain", (F.col("before") + F.col("here")).alias("n"), F.col("last").isNotNull().alias("ended"), "last")
    new = materialize(new, "counts")
    kept = spread_join(placed, new.select("domain", "last"), ["domain"], ["path"]).where(
        F.col("position") <= F.coalesce("last", "position"))
    return kept.select(*[c for c in level.columns], "position"), new.drop("last")


def reach(
    edges: DataFrame,
    seeds: Sequence[str] | DataFrame,
    redirects: DataFrame | None = None,
    max_depth: int | None = None,
) -> DataFrame:
    """(path, depth) of every page of one site reachable over ``edges(src, dst)``; see :func:`closure`."""
    one = F.lit("").alias("domain")
    if not isinstance(seeds, DataFrame):
        seeds = edges.sparkSession.createDataFrame([(p,) for p in sorted(set(seeds))], "path string")
    moved = None if redirects is None else redirects.select(one, "old_path", "new_path")
    found = closure(edges.select(one, "src", "dst"), seeds.select(one, "path"), redirects=moved, max_depth=max_depth)
    return found.select("path", "depth")


def crawl(
    pages: DataFrame,
    seeds: DataFrame,
    rules: LinkRules = LinkRules(),
    path_pattern: str | None = None,
    predicate: Callable[[Column, Column], Column] | None = None,
    keep: Sequence[str] = (),
    limit: int | None = None,
    redirects: DataFrame | None = None,
    max_depth: int | None = None,
) -> DataFrame:
    """A crawl of ``pages(domain, path, html)``: links, admission, closure and states, as :func:`closure` gives them.

    Every page is parsed once, for its links and for the predicate (``keep``
    names the elements that looks at). A link is followed where the rules admit
    it and it stays on its page's site.
    """
    wanted = sorted({"a", *keep})
    dom = parse_pages(pages, keys=PAGE, keep=wanted, outer=("a",), with_text=predicate is not None)
    by_path = F.coalesce(F.col("path").rlike(f"(?i){path_pattern}"), F.lit(False)) if path_pattern else F.lit(False)
    marked = F.coalesce(predicate(F.col("nodes"), F.col("text")), F.lit(False)) if predicate else F.lit(False)
    anchors = anchor_array(F.col("nodes"), F.col("text"), rules.allow)
    read = materialize(dom.select(*PAGE, (by_path | marked).alias("scrapable"), anchors.alias("anchors")), "read")
    found = read.select(F.col("domain").alias("own"), F.col("path").alias("src"), F.inline("anchors"))
    edges = resolve_links(found).where(followable(F.col("own"), rules)).select(F.col("own").alias("domain"), "src", F.col("path").alias("dst"))
    out = closure(edges, seeds, read.select(*PAGE, "scrapable"), limit, redirects, max_depth)
    discard(read)
    return out


def follow_redirects(paths: DataFrame, redirects: DataFrame) -> DataFrame:
    """One hop: ``path`` becomes its new path; ``old_path`` is set where it moved."""
    on = [c for c in PAGE if c in paths.columns]
    hops = redirects.withColumnRenamed("old_path", "path").select(*on, "new_path")
    moved = F.col("new_path").isNotNull()
    return paths.join(hops, on, "left").select(
        *on[:-1], F.coalesce("new_path", "path").alias("path"), F.when(moved, F.col("path")).alias("old_path")
    )


def redirect_states(paths: DataFrame, redirects: DataFrame) -> DataFrame:
    """Old paths are finished, their targets and all others in progress, each once."""
    hop = follow_redirects(paths, redirects)
    old = hop.where(F.col("old_path").isNotNull()).select(F.col("old_path").alias("path"), F.lit("finished").alias("state"))
    return hop.select("path", F.lit("in_progress").alias("state")).union(old).distinct()


def add_to_set(members: DataFrame, new: DataFrame) -> DataFrame:
    return members.unionByName(new).dropDuplicates()


def remove_from_set(members: DataFrame, gone: DataFrame) -> DataFrame:
    return members.join(gone.distinct(), members.columns, "left_anti")


def in_set(paths: DataFrame, members: DataFrame) -> DataFrame:
    return paths.join(members.distinct(), members.columns, "left_semi")


def state_sizes(state: DataFrame) -> DataFrame:
    return state.groupBy("domain", "state").agg(F.count(F.lit(1)).alias("n"))


def classify(
    pages: DataFrame,
    keys: Sequence[str],
    path_pattern: str | None = None,
    predicate: Callable[[Column, Column], Column] | None = None,
    path: str = "path",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``scrapable``: the path matches the pattern (any case) or the page predicate holds.

    The predicate takes a page's nodes and text and returns a boolean column (a
    pandas UDF call is one too). Pages are parsed only where one is given;
    without pattern and predicate no page is scrapable.
    """
    by_path = F.col(path).rlike(f"(?i){path_pattern}") if path_pattern else F.lit(False)
    if predicate is None:
        return pages.select(*keys, F.coalesce(by_path, F.lit(False)).alias("scrapable"))
    dom = parse_pages(pages, keys=keys, keep=keep)
    hit = F.coalesce(predicate(F.col("nodes"), F.col("text")), F.lit(False))
    return dom.select(*keys, (F.coalesce(by_path, F.lit(False)) | hit).alias("scrapable"))


def page_states(paths: DataFrame, corpus: DataFrame) -> DataFrame:
    """End state of each path: ``to_scrape``, ``finished``, or ``errored`` where no page exists.

    ``corpus(path, scrapable)`` may hold several captures of a page; one
    scrapable capture is enough.
    """
    known = corpus.groupBy("path").agg(F.max("scrapable").alias("scrapable"))
    return paths.join(known, "path", "left").withColumn("state", page_state(F.col("scrapable"))).drop("scrapable")


def limit_pages(states: DataFrame, limit: int) -> DataFrame:
    """Stop a crawl at ``limit`` pages, in the order (depth, path).

    Errored pages count, but only a success stops the crawl: the last page kept
    is the first success at or beyond the limit.
    """
    ranked = materialize(with_running(states, [F.col("depth"), F.col("path")]), "limited")
    success = ranked.where((F.col("position") >= limit) & (F.col("state") != "errored"))
    last = success.agg(F.min("position").alias("last")).scalar()
    return ranked.where(F.col("position") <= F.coalesce(last, F.col("position")))


def drain(state: DataFrame, corpus: DataFrame) -> DataFrame:
    """Second stage of a directed crawl: every pending path, no further links."""
    pending = state.where(F.col("state") == "in_progress").select("path").distinct()
    found = corpus.select("path", F.lit(False).alias("scrapable"))
    return page_states(pending, found)


def resume(state: DataFrame, domain: str, seed: str) -> DataFrame:
    """(path): the pending pages of a domain, or the seed where none is pending."""
    pending = state.where((F.col("domain") == domain) & (F.col("state") == "in_progress")).select("path").distinct()
    start = state.sparkSession.range(1).select(F.lit(seed).alias("path"))
    return pending.union(start.where(~pending.exists()))


def listing_ranges(
    pages: DataFrame, visited: DataFrame, start: int = 1, last: int | None = None, stop_after_seen: int | None = None
) -> DataFrame:
    """(page_no, to_page, state) of a scan over numbered listing pages.

    ``pages(page_no, is_end)``; visited pages are skipped, and the scan ends
    before the first unvisited page with ``is_end``. With ``stop_after_seen`` it
    also ends once that many visited pages were met. Pages that are asked for and
    missing are errored: a gap between known pages is one row, whatever its
    length, so a wrong number among the pages adds a row and not a range. Pages
    up to ``last`` are asked for; without it, up to the highest page known.
    """
    seen = visited.select("page_no", F.lit(True).alias("seen")).distinct()
    inside = F.col("page_no") >= start if last is None else F.col("page_no").between(start, last)
    known = pages.select("page_no", "is_end").join(seen, "page_no", "full").where(inside).select(
        "page_no", "is_end", F.coalesce("seen", F.lit(False)).alias("seen"), F.coalesce("seen", F.lit(False)).cast("int").alias("one"))
    placed = materialize(with_running(known, [F.col("page_no")], {"met": "one"}), "listing")
    before = placed.select((F.col("position") + 1).alias("position"), F.col("page_no").alias("previous"))
    met = F.col("met") - F.col("one")  # visited pages before this one
    rows = placed.join(before, "position", "left").select(
        "page_no", "is_end", "seen", met.alias("met"), F.coalesce("previous", F.lit(start - 1)).alias("previous"))
    state = F.when(F.col("is_end").isNull(), "errored").otherwise("finished")
    single = rows.where("NOT seen").select("page_no", F.col("page_no").alias("to_page"), state.alias("state"), "met")
    gap = [(F.col("previous") + 1).alias("page_no"), (F.col("page_no") - 1).alias("to_page"), F.lit("errored").alias("state"), "met"]
    out = single.unionByName(rows.select(*gap).where("page_no <= to_page"))
    if last is not None:
        rest = placed.agg(F.coalesce(F.max("page_no"), F.lit(start - 1)).alias("previous"), F.coalesce(F.max("met"), F.lit(0)).alias("met"))
        rest = rest.withColumn("page_no", F.lit(last + 1).cast("long"))
        out = out.unionByName(rest.select(*gap).where("page_no <= to_page"))
    if stop_after_seen is not None:
        out = out.where(F.col("met") < stop_after_seen)
    end = placed.where("is_end AND NOT seen").agg(F.min("page_no").alias("n")).scalar()
    return out.where(F.col("page_no") < F.coalesce(end, F.col("page_no") + 1)).select("page_no", "to_page", "state")


def listing_scan(
    pages: DataFrame, visited: DataFrame, start: int = 1, last: int | None = None, stop_after_seen: int | None = None
) -> DataFrame:
    """(page_no, state): :func:`listing_ranges` with a row for each page."""
    found = listing_ranges(pages, visited, start, last, stop_after_seen)
    return found.select(F.explode(F.sequence("page_no", "to_page")).alias("page_no"), "state")
