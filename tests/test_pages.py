"""Parsing, selection, extraction: edge rows."""

import random
import time

import pytest
from pyspark.sql import functions as F

from larder.operators import dom, extract
from larder.operators.dom import Sel
from larder.operators.markup import Page

PAGE = """<html><body><div class="main-content x"><h1>Big
 Cake &amp; Co </h1>
<cite class="contributors"><a class="contributor">Ann</a>, <a class="contributor">Bo  B</a></cite>
<div itemprop="description"> text <p>One.<p> <p>Two <b>bold</b>.</div>
<script>var t = "</p><h1>no</h1>";</script>
<div class="recipe-image"><img srcset="https://i.example/a.b.jpg"></div>
<dl class="summary-data"><dd class="yield extra">no</dd><dd class="yield">Serves 44</dd><dd class="total-time"> 2  hr</dd></dl>
<div class="ingredients-info"><ol class="ingredient-groups">
<li class="ingredient-group"><strong>For cake</strong><ul><li>13 eggs<li> 5 cups  sugar</ul>
<li class="ingredient-group"><strong>Tools</strong><ul><li>Equipment: pan</ul></li>
<li class="ingredient-group"><ul><li>3 cups cream</li><li> </li></ul></li>
<li class="ingredient-group"><strong>For cake</strong><ul><li>1 lemon</ul></li>
</ol></div>
<div class="instructions"><ol class="preparation-groups"><li class="preparation-group"><ol><li>Equipment first.<li>Bake.</ol></ol></div>
<div class="review-rating"><span class="rating">3/4</span><span itemprop="reviewCount">{count}</span></div>
<div class="prepare-again-rating"><span>{again}</span></div></div></body></html>"""


def scrape(spark, *pages):
    df = spark.createDataFrame([("d", str(i), h) for i, h in enumerate(pages)], "domain string, path string, html string")
    return sorted(extract.scrape(df).collect(), key=lambda r: r.path)


def test_full_page(spark):
    r = scrape(spark, PAGE.format(count="77", again="94%"))[0]
    assert r.title == "Big Cake & Co"
    assert [(g["group"], g["lines"]) for g in r.ingredients] == [("For cake", ["1 lemon"]), ("part_3", ["3 cups cream"])]
    assert [(g["group"], g["lines"]) for g in r.instructions] == [("part_1", ["Equipment first.", "Bake."])]
    m = r.misc
    assert (m.servings, m.prep_time, m.cook_time) == ("Serves 44", None, "2 hr")
    assert m.author == "Ann\nBo B" and m.description == "One.\nTwo bold."
    assert (m.rating, m.make_again, m.ratings) == (0.75, 0.94, 77)
    assert m.image_url == "https://i.example/a.b.jpg" and m.image_location is None


@pytest.mark.parametrize("count,again,want", [
    ("0", "94%", (None, None, None)), ("1,234", "94%", (None, None, None)), ("3", "0%", (0.75, None, 3)),
])
def test_rating_gate(spark, count, again, want):
    m = scrape(spark, PAGE.format(count=count, again=again))[0].misc
    assert (m.rating, m.make_again, m.ratings) == want


def test_unreadable_count_is_an_error(spark):
    df = spark.createDataFrame([("d", "p", PAGE.format(count="1,234", again="x"))], "domain string, path string, html string")
    (e,) = extract.scrape_errors(extract.scrape(df)).collect()
    assert e.path == "p" and e.error_type == "ValueError" and "1,234" in e.error_message[0]


def test_empty_and_missing_groups(spark):
    none = "<h1>x</h1><div class='recipe-image'><img></div>"
    empty = "<div class='ingredients-info'><ol class='ingredient-groups'><li class='ingredient-group'><ul><li>Equipment<li> </ul></ol></div>"
    a, b, c = scrape(spark, none, empty, "")
    assert a.ingredients is None and a.misc.image_url is None and a.misc.author is None and a.misc.description is None
    assert b.ingredients == [] and b.title is None
    assert c.title is None and c.misc.ratings is None


def test_trim(spark):
    df = spark.createDataFrame([("a", "<p>x<div class='main-content'>in<p>y</div>out"), ("b", "<p>x")], "path string, html string")
    assert {r.path: r.html for r in extract.trim_pages(df).collect()} == {"a": "<div class='main-content'>in<p>y</div>", "b": "<p>x"}


def test_images(spark):
    df = spark.createDataFrame([("d", "recipes/1", '<div class="recipe-image"><img srcset="/i/1.png"></div>'),
                                ("d", "recipes/2", '<div class="recipe-image"><img srcset="https://h.com/2.jpg"></div>'),
                                ("d", "recipes/3", "<p>")], "domain string, path string, html string")
    stored = spark.createDataFrame([("recipes%2F2.jpg",)], "file_name string")
    rows = {r.path: r.misc.image_location for r in extract.scrape(df, images=stored).collect()}
    assert rows == {"recipes/1": None, "recipes/2": "images/recipes%2F2.jpg", "recipes/3": None}
    plan = extract.image_plan(df.drop("domain"), stored, extract.DEFAULT_LAYOUT.image, "srcset", "https://site.com").collect()
    assert [(r.path, r.image_url, r.file_name) for r in plan] == [("recipes/1", "https://site.com/i/1.png", "recipes%2F1.png")]


def test_tokenizer():
    p = Page('<p>a<p>b<br>c<ul><li>1<li>2<ul><li>3</ul><li>4</ul><!--x--><i title="a>b" x=\'y\'>t</i></nope><td>z')
    assert p.text == "abc1234tz"
    assert list(zip(p.tag, p.parent, strict=True)) == [
        ("p", -1), ("p", -1), ("br", 1), ("ul", -1), ("li", 3), ("li", 3), ("ul", 5), ("li", 6), ("li", 3), ("i", -1), ("td", -1)]
    assert p.end[5] == 7 and p.end[3] == 8
    assert p.attrs[9] == {"title": "a>b", "x": "y"}


def test_source_ranges():
    source = "<div><p>a<p>b</div><script>if (a<b) '</p>'</script><a href=/x>y</a><b>open"
    p = Page(source)
    parts = {t: source[b:e] for t, b, e in zip(p.tag, p.begin, p.to, strict=True)}
    assert parts == {"div": "<div><p>a<p>b</div>", "p": "<p>b", "script": "<script>if (a<b) '</p>'</script>",
                     "a": "<a href=/x>y</a>", "b": "<b>open"}
    assert p.text == "abyopen"


@pytest.mark.parametrize("html", ["<", "<a", "<a href='x", "</", "<!--", "<script>x", "a < b > c", "<p <b>x</b>", "<>", "&#0; &bogus; &amp"])
def test_broken_markup_is_read(html):
    p = Page(html)
    assert all(p.end[i] >= i and p.start[i] <= p.stop[i] <= len(p.text) for i in range(len(p.tag)))


def test_node_table_and_selection(spark):
    df = spark.createDataFrame([(1, '<div id="a" class="x y"><p>one <b>two</b></p></div><div class="x"><b k="v">thrée</b></div>')], "id long, html string")
    parsed = dom.parse_pages(df)
    rows = dom.html_nodes(parsed, ["id"]).orderBy("node_id").collect()
    assert [(r.node_id, r.end_id, r.parent_id, r.depth, r.tag, r.text, r.string) for r in rows] == [
        (0, 2, -1, 0, "div", "one two", None), (1, 2, 0, 1, "p", "one two", None), (2, 2, 1, 2, "b", "two", "two"),
        (3, 4, -1, 0, "div", "thrée", "thrée"), (4, 4, 3, 1, "b", "thrée", "thrée")]
    n, t = F.col("nodes"), F.col("text")
    got = parsed.select(
        dom.first_text(n, t, Sel("div", cls="x"), Sel("b")).alias("first"),
        F.size(dom.select_all(n, t, Sel(cls="x"), Sel("b"))).alias("all"),
        dom.first_text(n, t, Sel(id="a")).alias("by_id"),
        dom.first_text(n, t, Sel(attr=("k", "v"))).alias("by_attr"),
        dom.first_text(n, t, Sel("b", text="^two$")).alias("by_text"),
        dom.first_text(n, t, Sel("h9")).alias("none"),
    ).first()
    assert tuple(got) == ("two", 2, "one two", "thrée", "two", None)


def test_output_batches_are_cut(spark):
    df = spark.range(50).select("id", F.lit("<p>a<p>b").alias("html")).coalesce(1)
    got = dom.parse_pages(df, nodes_per_batch=7)
    assert got.where(F.size("nodes") == 2).count() == 50


@pytest.mark.parametrize("piece", ['<a href="x', "<a '>\" <b \">'", '<a ">" ', "<p 'x>", "<!-", "</p \"", "<title>", "<script"])
def test_stray_quotes_are_read_in_linear_time(piece):
    """A hundred times the length must not take much more than a hundred times as long."""
    def seconds(times):
        start = time.process_time()
        Page(piece * times)
        return time.process_time() - start

    assert seconds(200_000) < 300 * max(seconds(2_000), 0.005)


def test_slashes_and_text_elements():
    p = Page('<a href=/recipes/>text</a><br/><i class="x"/><title>a<b &amp; c</title><textarea><p></textarea><b/>t')
    at = {t: i for i, t in enumerate(p.tag)}
    assert p.tag == ["a", "br", "i", "title", "textarea", "b"] and p.attrs[at["a"]] == {"href": "/recipes/"}
    shown = {t: p.text[p.start[i]:p.stop[i]] for t, i in at.items()}
    assert shown == {"a": "text", "br": "", "i": "", "title": "a<b & c", "textarea": "<p>", "b": ""}


def test_both_readers_read_alike():
    """The reader of regular pages gives what the careful one gives, or leaves the page to it."""
    from larder.operators import markup

    def seen(parts):
        p = object.__new__(Page)
        with pytest.MonkeyPatch.context() as m:
            m.setattr(markup, "_regular", lambda source: parts)
            Page.__init__(p, source)
        return p.text, p.tag, p.attrs, p.parent, p.depth, p.end, p.start, p.stop, p.begin, p.to, p.single()

    bits = ["<", ">", '"', "'", "/", "-->", "<!--", "<!-->", "<!d>", "<p>", "</p>", "<li>", "<ul>", "</ul>", '<div class="a>b">', "</div>",
            "<script>", "</Script ", "</script>", "<title>", "</title>", "<textarea/>", "\u017fcript", "<\u017fcript>", "&amp;", "é", " x=", "<br/>", "<a href=/x/>"]
    rnd, regular = random.Random(7), 0
    for _ in range(5_000):
        source = "".join(rnd.choices(bits, k=rnd.randrange(1, 14)))
        parts = markup._regular(source)
        regular += parts is not None
        assert parts is None or seen(parts) == seen(markup._any(source)), source
    assert regular > 2_000


def test_a_repeated_tag_is_read_once(monkeypatch):
    """Pages of a site repeat their tags; what a tag says is taken from its text once."""
    from larder.operators import markup

    read, plain = [], markup._attributes
    monkeypatch.setattr(markup, "_attributes", lambda rest: read.append(rest) or plain(rest))
    markup._known.clear()
    rows = markup.NodeRows()
    for i in range(50):
        rows.add('<div class="once"><li id=n>1<li id=n>2</div>' + str(i), frozenset((".once", "li")), frozenset(), True)
    assert len(read) == 2 and rows.count == 150


def test_what_a_tag_says_is_made_once_a_batch(monkeypatch):
    """Elements take the name, classes and attributes of their tag from one Arrow value, on however many pages it stands."""
    from larder.operators import markup

    split = []
    plain = markup.Tag.classes.fget
    monkeypatch.setattr(markup.Tag, "classes", property(lambda tag: split.append(tag.rest) or plain(tag)))
    markup._known.clear()
    rows = markup.NodeRows()
    for i in range(50):
        rows.add(f'<div class="once k"><p id=n>é{i}<p id=n>2</div>', None, frozenset(), True)
    text, nodes = rows.arrays()
    assert len(split) == 2 and len(nodes) == 50
    assert [(n["tag"], n["classes"], n["attrs"], n["parent"], n["end"], n["start"], n["stop"], n["single"]) for n in nodes[7].as_py()] == [
        ("div", ["once", "k"], [("class", "once k")], -1, 2, 0, 4, False), ("p", [], [("id", "n")], 0, 1, 0, 3, True), ("p", [], [("id", "n")], 0, 2, 3, 4, True)]


@pytest.mark.parametrize("html, single", [
    ("<b>x</b>", [True]), ("<b></b>", [False]), ("<p><b>x</b></p>", [True, True]), ("<p><b>x</b> </p>", [False, True]),
    ("<p><b>x</b><i></i></p>", [False, True, False]), ("<p>x<!--c--></p>", [False]), ("<p><b>x<!--c--></b></p>", [False, False]),
    ("<p><!--c--><b>x</b></p>", [False, True]), ("<p>x<br></p>", [False, False]), ("<b>x</i></b>", [True]), ("<b>x</i>y</b>", [False]),
    ("<b>&#1;</b>", [True]), ("<b><i>x", [True, True]), ("<b><!d>x</b>", [True]), ("<p><b><i></i></b>x</p>", [False, False, False]),
])
def test_elements_of_one_text(html, single):
    assert Page(html).single() == single


def list_page(items):
    return ('<div class="ingredients-info"><ol class="ingredient-groups"><li class="ingredient-group"><strong>Höme</strong><ul>'
            + "".join(f"<li>{i} cups of flöur" for i in range(items)) + "</ul></li></ol></div>")


def test_a_page_of_many_items_is_read_in_linear_time(spark):
    lay = extract.DEFAULT_LAYOUT
    paths = (lay.ingredient_groups, (lay.group_name, lay.group_line))

    def run(items):
        df = spark.createDataFrame([(1, list_page(items))], "id int, html string")
        parsed = dom.parse_pages(df, keys=["id"], keep=extract.tags_of(*paths))
        got = extract.fields(lay)["ingredients"](F.col("nodes"), F.col("text"))
        start = time.process_time(), time.perf_counter()
        row = parsed.select(got.alias("g")).first()
        assert [g.group for g in row.g] == ["Höme"] and len(row.g[0].lines) == items
        assert row.g[0].lines[-1] == f"{items - 1} cups of flöur"
        return time.perf_counter() - start[1]

    run(100)
    small = run(5_000)
    assert run(100_000) < 60 * max(small, 0.2)


def test_nested_matches_count_once(spark):
    html = "<ul><li>a<ul><li>b<b>x</b></li></ul></li></ul><ul><b>y</b></ul>"
    parsed = dom.parse_pages(spark.createDataFrame([(1, html)], "id int, html string"), keep=("ul", "b"))
    n, t = F.col("nodes"), F.col("text")
    static = dom.texts_of(dom.select_all(n, t, Sel("ul"), Sel("b")), t)
    steps = F.expr("array(named_struct('tag', 'ul', 'cls', null, 'id', null, 'attr', null, 'value', null, 'text', null), "
                   "named_struct('tag', 'b', 'cls', null, 'id', null, 'attr', null, 'value', null, 'text', null))").cast(f"array<{dom.STEP_TYPE}>")
    by_column = dom.texts_of(dom.select_all(n, t, steps), t)
    none = F.size(dom.select_all(n, t, F.slice(steps, 1, 0)))
    assert tuple(parsed.select(static.alias("a"), by_column.alias("b"), none.alias("c")).first()) == (["x", "y"], ["x", "y"], 0)


def test_layouts_as_rows(spark):
    own = extract.SiteLayout(title=(Sel("div", cls="head"), Sel("b", id="t")), image=(Sel("img", attr=("role", "main")),), image_attribute="src")
    html = '<h1>one</h1><div class="head x"><b>no</b><b id="t">two</b></div><img src="a.png"><img role="main" src="b.png" srcset="c.png">'
    pages = spark.createDataFrame([(d, "/p", html) for d in ("a", "b", "unknown")] , "domain string, path string, html string")

    def scraped(layouts):
        return extract.scrape(pages, extract.layout_table(spark, layouts))

    rows = {r.domain: (r.title, r.misc.image_url) for r in scraped({"a": extract.DEFAULT_LAYOUT, "b": own}).collect()}
    assert rows == {"a": ("one", None), "b": ("two", "b.png")}
    one, many = (scraped({f"s{i}": own for i in range(n)})._jdf.queryExecution().optimizedPlan().toString().count("\n") for n in (1, 1000))
    assert one == many
    with pytest.raises(ValueError):
        extract.layout_table(spark, {"a": extract.SiteLayout(override={"title": lambda n, t: t})})
