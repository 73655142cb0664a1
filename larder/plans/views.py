"""Recipe, page and site tables rendered from the star-schema test tables.

Each view has a SQL twin in :mod:`larder.plans.oracles` that reaches the same
values from the columns, without reading any rendered text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import urls

MARKET = "www.market.example"
UNITS = ("cup", "tablespoon", "ounce", "gram", "pinch", "pound")  # by line number, 7 is a bare count
IMAGE_HOST = "https://img.example/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- ingredient lines --------------------------------------------------------


def ingredient_name(p_name: Column) -> Column:
    """Part name without the two words that are sizes to the line parser."""
    return F.replace(F.replace(p_name, F.lit("small"), F.lit("green")), F.lit("large"), F.lit("amber"))


def line_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with the pieces a line is made of.

    Volumes come in quarters, written as a mixed number; all else in whole numbers.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus",
    )
    part = table(spark, sf_dir, "part").select("p_partkey", ingredient_name(F.col("p_name")).alias("name"))
    units = ", ".join(f"'{u}'" for u in UNITS)
    return (
        li.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(
            *li.columns,
            "name",
            """CASE WHEN l_linenumber > 2 THEN string(int(l_quantity)) ELSE concat_ws(' ',
                 CASE WHEN l_quantity >= 4 THEN string(int(l_quantity) div 4) END,
                 CASE WHEN l_quantity % 4 > 0 THEN concat(int(l_quantity) % 4, '/4') END) END AS amount_text""",
            "CASE WHEN l_linenumber <= 2 THEN l_quantity / 4 ELSE l_quantity END AS amount",
            f"get(array({units}), l_linenumber - 1) AS unit",
        )
        .selectExpr(
            "*",
            "CASE WHEN amount <= 1 THEN unit WHEN unit = 'pinch' THEN 'pinches' ELSE concat(unit, 's') END AS unit_text",
            "CASE WHEN amount <= 1 THEN name ELSE concat(name, 's') END AS noun",
        )
        .selectExpr("*", "concat_ws(' ', amount_text, unit_text, noun) AS line")
    )


def line_order() -> list[str]:
    return ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def recipe_path(orderkey: Column) -> Column:
    return F.concat(F.lit("recipes/"), orderkey.cast("string"), F.lit(".html"))


def ingredient_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, part letter, ordering columns, name, line): one row per lineitem row."""
    return line_parts(spark, sf_dir).withColumn("path", recipe_path(F.col("l_orderkey")))


# --- recipes -------------------------------------------------------------------


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the row-level facts of a recipe."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "c_nationkey",
        "concat('www.site', c_nationkey, '.example') AS domain",
        "concat('recipes/', o_orderkey, '.html') AS path",
        "concat('Serves ', o_orderkey % 12 + 1) AS servings",
        "concat(o_custkey % 60, ' minutes') AS prep_time",
        "CASE WHEN o_orderkey % 7 <> 0 THEN concat(o_orderkey % 90 + 1, ' minutes') END AS cook_time",
        r"CASE WHEN o_orderkey % 11 = 0 THEN concat(c_name, '\nGuest Cook') ELSE c_name END AS author",
        r"CASE WHEN o_orderkey % 9 <> 0 THEN concat('Made by ', c_name, '.\nKeeps well.') END AS description",
        "int(o_custkey % 5) AS rating_count",
        "int(o_orderkey % 5) AS quarters",
        "int(o_orderkey % 101) AS percent",
        f"CASE WHEN o_orderkey % 13 <> 0 THEN concat('{IMAGE_HOST}', o_orderkey, '.jpg') END AS image_url",
    )


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: lines in order, with their return flag and line status.

    The stated partition count keeps the stage wide for the rendering behind it
    (adaptive execution would size it by the few bytes going in), and serves the
    grouping and the join on the order key alike. Nothing shrinks in this
    grouping, so no partial aggregation is lost.
    """
    lp = line_parts(spark, sf_dir)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return lp.repartition(n, "l_orderkey").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct(*line_order(), "l_returnflag", "l_linestatus", "line", "name"))).alias("ls")
    )


def _groups_sql(*groups: tuple[str | None, str, str, str]) -> str:
    """Non-empty groups (name, column, letter, text of a line x); an unnamed one is called by its place."""
    each = ", ".join(
        f"named_struct('name', {repr(n) if n else 'CAST(NULL AS STRING)'}, "
        f"'lines', transform(filter(ls, x -> x.{column} = '{letter}'), x -> {text}))"
        for n, column, letter, text in groups
    )
    return (
        f"CASE WHEN ls IS NOT NULL THEN transform(filter(array({each}), g -> size(g.lines) > 0), "
        "(g, i) -> named_struct('group', coalesce(g.name, concat('part_', i + 1)), 'lines', g.lines)) END"
    )


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order facts with title and grouped lines."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    facts = order_facts(spark, sf_dir).repartition(n, "o_orderkey")  # the partitioning of _parts
    joined = facts.join(_parts(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    step = "concat('Add the ', x.name, '.')"
    ingredients = _groups_sql(
        ("For A", "l_returnflag", "A", "x.line"), (None, "l_returnflag", "N", "x.line"), ("For R", "l_returnflag", "R", "x.line")
    )
    instructions = _groups_sql((None, "l_linestatus", "F", step), ("Finish:", "l_linestatus", "O", step))
    return joined.selectExpr(
        *facts.columns,
        "CASE WHEN o_orderkey % 97 <> 0 THEN concat(get(ls, 0).name, ' pie') END AS title",
        f"{ingredients} AS ingredients",
        f"{instructions} AS instructions",
    )


def titled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, path, title) of every order, as in ``recipes``; of an order's lines only the first is kept."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = line_parts(spark, sf_dir).select("l_orderkey", F.struct(*line_order(), "name").alias("line"))
    first = lines.repartition(n, "l_orderkey").groupBy("l_orderkey").agg(F.min("line").alias("first"))
    facts = order_facts(spark, sf_dir).select("o_orderkey", "path").repartition(n, "o_orderkey")
    return facts.join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left").selectExpr(
        "o_orderkey", "path", "CASE WHEN o_orderkey % 97 <> 0 THEN concat(first.name, ' pie') END AS title"
    )


def image_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images already stored: every third order's."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 3 == 0)
    return o.select(urls.path_to_file_name(recipe_path(F.col("o_orderkey")), "jpg").alias("file_name"))


def recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, as a scrape of its page gives it."""
    return _content(spark, sf_dir).selectExpr(
        "domain",
        "path",
        "title",
        "ingredients",
        "instructions",
        """struct(servings, prep_time, cook_time, author, description,
            CASE WHEN rating_count > 0 THEN nullif(quarters / 4D, 0D) END AS rating,
            CASE WHEN rating_count > 0 THEN nullif(round(percent * 0.01D, 2), 0D) END AS make_again,
            CASE WHEN rating_count > 0 THEN rating_count END AS ratings,
            CASE WHEN image_url IS NOT NULL AND o_orderkey % 3 = 0
                 THEN concat('images/', url_encode(path), '.jpg') END AS image_location,
            image_url) AS misc""",
    )


# --- recipe pages ------------------------------------------------------------


def _list_html(column: str, outer_cls: str, list_cls: str, group_cls: str, inner: str) -> str:
    """Groups as markup; the last ``li`` of each list is left open."""
    name = "CASE WHEN startswith(g.group, 'part_') THEN '' ELSE concat('<strong>', g.group, '</strong>') END"
    items = "array_join(transform(g.lines, t -> concat('<li>', t)), '')"
    group = f"""concat('<li class="{group_cls}">', {name}, '<{inner}>', {items}, '</{inner}></li>')"""
    return f"""coalesce(concat('<div class="{outer_cls}"><ol class="{list_cls}">',
        array_join(transform({column}, g -> {group}), ''), '</ol></div>'), '')"""


def recipe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(domain, path, html, o_orderkey): ``recipes`` as saved pages.

    Every tenth page lacks the main-content box, every fifth carries a script
    with a stray end tag, and description paragraphs are left open. A part that
    is NULL leaves no markup.
    """
    inner = rf"""concat(
        coalesce(concat('<h1>', replace(title, ' ', '\n  '), '</h1>'), ''),
        CASE WHEN o_orderkey % 5 = 0 THEN '<script>var t="</p><h1>no</h1>";</script>' ELSE '' END,
        '<cite class="contributors">',
        array_join(transform(split(author, '\n'),
                   a -> concat('<a class="contributor" href="/cook">', a, '</a>')), ' '), '</cite>',
        coalesce(concat('<div itemprop="description">',
                 array_join(transform(split(description, '\n'), p -> concat('<p>', p)), ''), '<p> </div>'), ''),
        coalesce(concat('<div class="recipe-image"><img srcset="', image_url, '"></div>'), ''),
        '<dl class="summary-data"><dd class="yield extra">not this one</dd><dd class="yield">', servings,
        '</dd><dd class="active-time">', prep_time, '</dd>',
        coalesce(concat('<dd class="total-time">', cook_time, '</dd>'), ''), '</dl>',
        {_list_html("ingredients", "ingredients-info", "ingredient-groups", "ingredient-group", "ul")},
        {_list_html("instructions", "instructions", "preparation-groups", "preparation-group", "ol")},
        '<div class="review-rating"><span class="rating">', quarters, '/4</span><span itemprop="reviewCount"> ',
        rating_count, ' </span></div><div class="prepare-again-rating"><span>', percent, '%</span></div>')"""
    return (
        _content(spark, sf_dir)
        .selectExpr("domain", "path", f"{inner} AS body", "o_orderkey")
        .selectExpr(
            "domain",
            "path",
            """concat('<html><head><title>x</title></head><body><nav>Menu</nav>',
                CASE WHEN o_orderkey % 10 = 0 THEN body
                     ELSE concat('<div class="main-content wide">', body, '</div>') END, '</body></html>') AS html""",
            "o_orderkey",
        )
    )


# --- a site -----------------------------------------------------------------------


def _page(path: Column, body: Column) -> list[Column]:
    return [path.alias("path"), F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html")]


def _path(kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"/{kind}/"), key.cast("string"))


def _link(path: Column) -> Column:
    return F.concat(F.lit('<a href="'), path, F.lit('">go</a>'))


def site_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst): root -> regions -> nations -> customers -> orders -> nation."""
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    oc = o.join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    levels = [
        r.select(F.lit("/").alias("src"), _path("r", F.col("r_regionkey")).alias("dst")),
        n.select(_path("r", F.col("n_regionkey")).alias("src"), _path("n", F.col("n_nationkey")).alias("dst")),
        c.select(_path("n", F.col("c_nationkey")).alias("src"), _path("c", F.col("c_custkey")).alias("dst")),
        o.select(_path("c", F.col("o_custkey")).alias("src"), _path("o", F.col("o_orderkey")).alias("dst")),
        oc.select(_path("o", F.col("o_orderkey")).alias("src"), _path("n", F.col("c_nationkey")).alias("dst")),
    ]
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def site_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path): the pages that exist."""
    out = spark.range(1).select(F.lit("/").alias("path"))
    for name, kind, key in (
        ("region", "r", "r_regionkey"), ("nation", "n", "n_nationkey"),
        ("customer", "c", "c_custkey"), ("orders", "o", "o_orderkey"),
    ):
        out = out.unionByName(table(spark, sf_dir, name).select(_path(kind, F.col(key)).alias("path")))
    return out


DECOY_HTML = (
    '<a href="https://other.example/x/{k}">away</a>'
    '<a class="hidden" href="/hid/{k}">hidden</a>'
    '<a href="/go?u=http://z/{k}">messy</a>'
    '<a href="/' + "l" * 121 + '/{k}">long</a>'
    '<a href="//x{k}">scary</a>'
    '<a class="overflow-hidden" href="/s/{k}">shown</a>'
    '<a href="/two/{k}"><b>two</b> parts</a>'
    '<a href="/private/{k}">avoid</a>'
    '<a href="/o/../{k}">kept</a>'
    '<a href="https://www.market.example/abs/{k}">absolute</a>'
    '<a href="rel/{k}">relative</a>'
)


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, html): the site as captures.

    A listing is kept as one capture per entry, as a paged listing is saved, so
    no page grows with the data; several captures may share a path. Every
    seventh customer carries one link of each kind. Orders with status ``F``
    have the recipe mark and an image.
    """
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    # spread the narrow keys before they grow into pages: the stage that parses them is then wide
    o = o.select("o_orderkey", "o_custkey", "o_orderstatus").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey"
    )
    oc = o.join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("c_custkey").cast("string")
    decoys = F.when(F.col("c_custkey") % 7 == 0, F.replace(F.lit(DECOY_HTML), F.lit("{k}"), k)).otherwise(F.lit(""))
    mark = F.when(
        F.col("o_orderstatus") == "F",
        F.concat(
            F.lit('<h2 id="recipe-page"> Ingredients\n</h2><div class="my-image"><img src="/img/'),
            F.col("o_orderkey").cast("string"),
            F.lit('.png"></div>'),
        ),
    ).otherwise(F.lit("<h2>Notes</h2>"))
    captures = [
        r.select(*_page(F.lit("/"), _link(_path("r", F.col("r_regionkey"))))),
        n.select(*_page(_path("r", F.col("n_regionkey")), _link(_path("n", F.col("n_nationkey"))))),
        c.select(*_page(_path("n", F.col("c_nationkey")), _link(_path("c", F.col("c_custkey"))))),
        c.select(*_page(_path("c", F.col("c_custkey")), F.concat(F.lit("<h1>Customer</h1>"), decoys))),
        o.select(*_page(_path("c", F.col("o_custkey")), _link(_path("o", F.col("o_orderkey"))))),
        oc.select(*_page(_path("o", F.col("o_orderkey")), F.concat(mark, _link(_path("n", F.col("c_nationkey")))))),
    ]
    out = captures[0]
    for lv in captures[1:]:
        out = out.unionByName(lv)
    return out


SECOND = "www.second.example"


def two_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(domain, path, html): the site under two domains with the same paths; the second lacks every fifth customer."""
    pages = site_pages(spark, sf_dir)
    lost = F.startswith("path", F.lit("/c/")) & (F.substring("path", 4, 20).try_cast("long") % 5 == 0)
    return pages.select(F.lit(MARKET).alias("domain"), "path", "html").unionByName(
        pages.where(~lost).select(F.lit(SECOND).alias("domain"), "path", "html"))


def crawl_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(domain, path, state, depth) of the orders already met by a crawl."""
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    state = (
        F.when(s == "F", "finished").when(s == "P", "errored").when(k % 5 == 0, "to_scrape").when(k % 5 == 1, "in_progress")
    )
    return (
        table(spark, sf_dir, "orders")
        .select(F.lit(MARKET).alias("domain"), _path("o", k).alias("path"), state.alias("state"), F.lit(4).alias("depth"))
        .where(F.col("state").isNotNull())
    )


def redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(old_path, new_path): every tenth customer has moved."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(k % 10 == 0).select(
        _path("c", k).alias("old_path"), _path("member", k).alias("new_path")
    )


LISTING_ENTRIES = 10


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_no, html): ten order keys a page; the end mark at half way."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    no = F.floor(F.col("o_orderkey") / LISTING_ENTRIES) + 1
    last = o.agg(F.max(no).alias("m")).scalar()
    sentinel = F.ceil(last / 2)
    pages = o.groupBy(no.alias("page_no")).agg(  # at most ten keys a page
        F.array_join(
            F.transform(F.sort_array(F.collect_list("o_orderkey")), lambda x: _link(F.concat(F.lit("/"), recipe_path(x)))), ""
        ).alias("links")
    )
    head = F.when(F.col("page_no") == sentinel, F.lit("<h1>Don't  Cry</h1>")).otherwise(F.lit("<h1>Results</h1>"))
    return pages.select(
        F.col("page_no").cast("long"),
        F.concat(F.lit("<html><body>"), head, "links", F.lit("</body></html>")).alias("html"),
    )


def listing_visited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_no): listing pages an earlier crawl has finished: 1, 4, 7, ..."""
    o = table(spark, sf_dir, "orders").select((F.floor(F.col("o_orderkey") / LISTING_ENTRIES) + 1).alias("page_no"))
    return o.where(F.col("page_no") % 3 == 1).distinct()


