import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.functions import urls
from larder.functions.text import percent_ratio, rating_ratio, stripped_text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("url,want", [
    ("https://website.com/home", ("https", "website.com", "/home")),
    ("HTTP://www.Web.com/a?b=1#c", ("HTTP", "www.Web.com", "/a?b=1#c")),
    ("https://website.com/", (None, None, "/https://website.com/")),
    ("https://website.com", (None, None, "/https://website.com")),
    ("recipes.v2/food", (None, "recipes.v2", "/food")),
    ("recipes/food", (None, None, "/recipes/food")),
    ("/food", (None, None, "/food")),
    ("", (None, None, "/")),
])
def test_url_parts(spark, url, want):
    assert tuple(one(spark, urls.url_parts(F.lit(url)))) == want


@pytest.mark.parametrize("href,want", [
    ("//website.com/a/b", ("website.com", "/a/b")),
    ("//website.com/", ("website.com", "/")),
    ("/../x/y", (None, "/x/y")),
    ("/x", (None, "/x")),
    ("x/y", (None, "/x/y")),
    ("https://o.com/z", ("o.com", "/z")),
])
def test_resolve_href(spark, href, want):
    got = one(spark, urls.resolve_href(F.lit(href)))
    assert (got.domain, got.path, got.error) == (*want, None)


@pytest.mark.parametrize("href", ["//website.com", "//ab", "//"])
def test_unresolvable_href(spark, href):
    got = one(spark, urls.resolve_href(F.lit(href)))
    assert (got.domain, got.path) == (None, None) and got.error.endswith(href)


@pytest.mark.parametrize("a,b,want", [
    (None, "web.com", True), ("", "web.com", True), ("www.web.com", "web.com", True),
    ("www.web.com", "eb.com", True), ("web.com/", "web.com", True), ("other.com", "web.com", False),
])
def test_same_domain(spark, a, b, want):
    assert one(spark, urls.same_domain(F.lit(a).cast("string"), F.lit(b))) is want


def test_visible_and_tidy(spark):
    assert one(spark, urls.visible(F.lit('<a class="HIDDEN">')) ) is False
    assert one(spark, urls.visible(F.lit('<a class="overflow-hidden">'))) is True
    assert one(spark, urls.tidy_path(F.lit("/" + "x" * 119))) is True
    assert one(spark, urls.tidy_path(F.lit("/" + "x" * 120))) is False
    assert one(spark, urls.tidy_path(F.lit("/a?u=http"))) is False
    assert one(spark, urls.tidy_path(F.lit(""))) is False


def test_file_name(spark):
    assert one(spark, urls.path_to_file_name(F.lit("/home"), "png")) == "home.png"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",)), min_size=1, max_size=30), min_size=1, max_size=40))
def test_file_name_round_trip(spark, paths):
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = df.select("p", urls.file_name_to_path(urls.path_to_file_name("p")).alias("back")).collect()
    assert all(r.back == r.p.lstrip("/") for r in rows)


@pytest.mark.parametrize("text,want", [("3/4", 0.75), ("3.5 / 4", 0.875), ("x", None), ("1/0", None), ("3.5.1/4", None), (None, None)])
def test_rating(spark, text, want):
    assert one(spark, rating_ratio(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text,want", [("94%", 0.94), ("12.5 %", 0.13), ("0%", 0.0), ("94", None)])
def test_percent(spark, text, want):
    assert one(spark, percent_ratio(F.lit(text))) == want


def test_stripped_text(spark):
    assert one(spark, stripped_text(F.lit(" a \n\t b\x1c\x85c "))) == "a b c"
