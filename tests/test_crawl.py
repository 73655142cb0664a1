import random

import pytest
from pyspark.sql import functions as F

from larder.functions import urls
from larder.operators import dom, extract, frontier, links
from larder.operators.dom import Sel

HOST = "website.com"
MARK = (Sel("h2", id="recipe-page", text=r"(?i)^\s*Ingredients\s*$"),)
IMAGE = '<div class="my-image"><img src="https://image.com/best.png"></div>'
SITE = {
    "/home": f'<h1>Home</h1><a href="https://{HOST}/path1">1</a> <a href="https://{HOST}/path2">2</a>{IMAGE}',
    "/path1": "<h1>One deep</h1><!-- no links -->",
    "/path2": f'<h1>One deep</h1><a href="https://{HOST}/path3">3</a><h2 id="recipe-page">Ingredients</h2>',
    "/path3": f'<h1>Two deep</h1><div><h2 id="recipe-page">Ingredients</h2>{IMAGE}',
}


def crawl(spark, avoid=(), pattern=None, predicate=None):
    pages = spark.createDataFrame(list(SITE.items()), "path string, html string")
    found = links.resolve_links(links.page_links(dom.parse_pages(pages, keep=("a",), outer=("a",)), ["path"]).withColumnRenamed("path", "src"))
    edges = found.where(links.followable(F.lit(HOST), links.LinkRules(avoid=avoid))).select("src", F.col("path").alias("dst"))
    reached = frontier.reach(edges, ["/home"]).select("path")
    flags = frontier.classify(pages, ["path"], pattern, predicate)
    states = frontier.page_states(reached, flags)
    return pages, {r.path: r.state for r in states.collect()}


def sizes(states):
    v = list(states.values())
    return v.count("finished"), v.count("to_scrape")


def test_whole_site(spark):
    assert sizes(crawl(spark)[1]) == (4, 0)


def test_avoid(spark):
    assert sizes(crawl(spark, avoid=["path2"])[1]) == (2, 0)


def test_scrapable_by_path_with_image(spark):
    pages, states = crawl(spark, avoid=["path"], pattern="HOME")
    assert sizes(states) == (0, 1)
    chosen = pages.where(F.col("path").isin([p for p, s in states.items() if s == "to_scrape"]))
    none = spark.createDataFrame([], "file_name string")
    plan = extract.image_plan(chosen, none, (Sel("div", cls="my-image"), Sel("img")), "src", f"https://{HOST}").collect()
    assert [(r.image_url, r.file_name) for r in plan] == [("https://image.com/best.png", "home.png")]


def test_scrapable_by_element(spark):
    assert sizes(crawl(spark, predicate=dom.has_element(*MARK))[1]) == (2, 2)


@pytest.mark.parametrize("seed", [1, 2])
def test_reach_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    edges = [(f"/{rnd.randrange(60)}", f"/{rnd.randrange(60)}") for _ in range(80)]
    edges += [("/1", f"/{i}") for i in range(30)] * 3  # a hub with repeated links
    want, todo = {"/0": 0, "/1": 0}, ["/0", "/1"]
    while todo:
        p = todo.pop(0)
        for a, b in edges:
            if a == p and b not in want:
                want[b] = want[p] + 1
                todo.append(b)
    got = frontier.reach(spark.createDataFrame(edges, "src string, dst string"), ["/0", "/1", "/0"])
    rows = got.collect()
    assert len(rows) == len(want) and {r.path: r.depth for r in rows} == want


def test_reach_from_unlinked_seed(spark):
    edges = spark.createDataFrame([("/a", "/b")], "src string, dst string")
    assert [tuple(r) for r in frontier.reach(edges, ["/z"]).collect()] == [("/z", 0)]


def test_limit_stops_at_a_success(spark):
    rows = [("/a", 0, "finished"), ("/b", 1, "errored"), ("/c", 1, "errored"), ("/d", 1, "to_scrape"), ("/e", 2, "finished")]
    df = spark.createDataFrame(rows, "path string, depth int, state string")
    assert sorted(r.path for r in frontier.limit_pages(df, 2).collect()) == ["/a", "/b", "/c", "/d"]
    assert sorted(r.path for r in frontier.limit_pages(df, 1).collect()) == ["/a"]
    assert frontier.limit_pages(df, 99).count() == 5


def test_resume(spark):
    schema = "domain string, path string, state string"
    busy = spark.createDataFrame([("d", "/x", "in_progress"), ("d", "/y", "finished"), ("e", "/z", "in_progress")], schema)
    assert [r.path for r in frontier.resume(busy, "d", "/s").collect()] == ["/x"]
    assert [r.path for r in frontier.resume(busy.where("path = '/y'"), "d", "/s").collect()] == ["/s"]


def test_listing(spark):
    pages = spark.createDataFrame([(n, n == 6) for n in range(1, 9) if n != 3], "page_no long, is_end boolean")
    seen = spark.createDataFrame([(2,), (4,)], "page_no long")
    got = {r.page_no: r.state for r in frontier.listing_scan(pages, seen).collect()}
    assert got == {1: "finished", 3: "errored", 5: "finished"}
    assert {r.page_no for r in frontier.listing_scan(pages, seen, start=4).collect()} == {5}
    assert {r.page_no for r in frontier.listing_scan(pages, seen, stop_after_seen=1).collect()} == {1}
    no_end = frontier.listing_scan(pages.where("page_no < 5"), seen, last=10).collect()
    assert {r.page_no: r.state for r in no_end if r.state == "errored"} == {n: "errored" for n in (3, 5, 6, 7, 8, 9, 10)}


def test_redirects(spark):
    paths = spark.createDataFrame([("/a",), ("/b",), ("/n",)], "path string")
    moves = spark.createDataFrame([("/a", "/n")], "old_path string, new_path string")
    assert {tuple(r) for r in frontier.redirect_states(paths, moves).collect()} == {
        ("/a", "finished"), ("/n", "in_progress"), ("/b", "in_progress")}


def test_allow_gives_one_copy_per_substring(spark):
    df = spark.createDataFrame([(1, '<a href="/recipes/food">x</a><a href="/other"><b>y</b> z</a><a>n</a>')], "id long, html string")
    parsed = dom.parse_pages(df, keep=("a",), outer=("a",))
    got = [r.href for r in links.page_links(parsed, ["id"], ["recipes/", "food", "oth"]).collect()]
    assert got == ["/recipes/food", "/recipes/food", "/other"]
    assert [r.href for r in links.page_links(parsed, ["id"]).collect()] == ["/recipes/food"]
    assert urls.MAX_PATH_LENGTH == 120


def small_web(rng, n):
    hosts = ("one.example", "two.example")
    pages = []
    for host in hosts:
        for i in range(n):
            if rng.random() < 0.85 or i == 0:
                hrefs = [rng.choice([f"/{rng.randrange(n)}", f"https://{host}/{rng.randrange(n)}", f"https://else.example/{i}"]) for _ in range(rng.randrange(5))]
                body = "".join(f'<a href="{h}">x</a>' for h in hrefs) + ('<h2 id="recipe-page">Ingredients</h2>' if rng.random() < 0.3 else "")
                pages.append((host, f"/{i}", body, hrefs))
    pages.append((hosts[0], "/0", "".join(f'<a href="/{i}">x</a>' for i in range(25)), [f"/{i}" for i in range(25)]))  # a second capture, a hub
    return hosts, pages


def plain_crawl(host, pages, limit):
    links, marks = {}, {}
    for h, path, body, hrefs in pages:
        if h == host:
            inside = {x.removeprefix(f"https://{host}") for x in hrefs if x.startswith("/") or x.startswith(f"https://{host}")}
            links.setdefault(path, set()).update(inside)
            marks[path] = marks.get(path, False) or "recipe-page" in body
    level, depth, seen, out = {"/0"}, 0, set(), []
    while level:
        for p in sorted(level):
            out.append((host, p, depth, "errored" if p not in marks else "to_scrape" if marks[p] else "finished"))
            if limit is not None and len(out) >= limit and p in marks:
                return out
        seen |= level
        level, depth = {x for p in level for x in links.get(p, ())} - seen, depth + 1
    return out


@pytest.mark.parametrize("seed, limit", [(1, None), (2, None), (3, 1), (4, 7), (5, 30)])
def test_crawl_of_two_sites(spark, seed, limit):
    hosts, web = small_web(random.Random(seed), 40)
    pages = spark.createDataFrame([p[:3] for p in web], "domain string, path string, html string")
    seeds = spark.createDataFrame([(h, "/0") for h in hosts], "domain string, path string")
    got = frontier.crawl(pages, seeds, predicate=dom.has_element(*MARK), keep=("h2",), limit=limit).collect()
    want = [r for h in hosts for r in plain_crawl(h, web, limit)]
    assert sorted((r.domain, r.path, r.depth, r.state) for r in got) == sorted(want)
    if limit:
        for h in hosts:
            ordered = sorted((r for r in got if r.domain == h), key=lambda r: r.position)
            assert [r.position for r in ordered] == list(range(1, len(ordered) + 1))
            assert [r.path for r in ordered] == [r[1] for r in want if r[0] == h]


def test_levels_beyond_the_limit_are_not_expanded(spark):
    edges = spark.createDataFrame([("d", f"/{i}", f"/{i + 1}") for i in range(50)], "domain string, src string, dst string")
    corpus = spark.createDataFrame([("d", f"/{i}", False) for i in range(50)], "domain string, path string, scrapable boolean")
    seeds = spark.createDataFrame([("d", "/0")], "domain string, path string")
    out = frontier.closure(edges, seeds, corpus, limit=3)
    assert sorted(r.path for r in out.collect()) == ["/0", "/1", "/2"]
    root = out.inputFiles()[0].split("/ends/")[0]
    assert len(spark.read.parquet(f"{root}/pages").select("depth").distinct().collect()) == 3


def test_a_level_reads_the_folders_of_its_frontier(spark):
    tables = frontier.PageTables(spark)
    rows = spark.createDataFrame([("d", f"/{i}", f"/{i + 1}") for i in range(200)], "domain string, path string, dst string")
    links = tables.store(tables.place(rows), "links")
    one = tables.store(tables.place(rows.limit(1)), "one")
    pruned = frontier.PageTables.near(links, one)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan or "PartitionFilters: [(bucket" in plan
    assert 0 < pruned.count() < links.count() == 200


def test_pages_as_files(spark, tmp_path):
    from larder.sources import pages as pg

    rows = [("a.example", "/x/ü?q=1&r=+", "<p>Ü\nzwei\n"), ("b.example", "/x/ü?q=1&r=+", "other"), ("a.example", "/home", ""), ("a.example", "/none", None), (None, "/z", "z")]
    df = spark.createDataFrame(rows, "domain string, path string, html string")
    folder = str(tmp_path / "saved")
    assert pg.save_pages(df, folder) == 3 == pg.save_pages(df, folder)
    pg.save_pages(df, folder, "txt")
    got = sorted((r.domain, r.path, r.html) for r in pg.read_saved_pages(spark, folder).collect())
    # Spark's scan leaves out files without a byte
    assert got == [("a.example", "x/ü?q=1&r=+", "<p>Ü\nzwei\n"), ("b.example", "x/ü?q=1&r=+", "other")]
