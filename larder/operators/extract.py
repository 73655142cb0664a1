"""From parsed pages to recipe rows.

All fields of a page are column expressions over its node array, so a recipe
row needs neither a join nor a shuffle. What differs between sites is a
:class:`SiteLayout`: selectors as data, and the field functions as defaults a
site may replace.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import urls
from larder.functions.text import let, non_empty, percent_ratio, rating_ratio, stripped_text
from larder.operators.dom import STEP_TYPE, Sel, StepColumn, below, first_text, node_text, parse_pages, select_all, select_first, texts_of, with_text
from larder.operators.joins import heavy_keys, spread_join

PARTS_TYPE = "array<struct<`group`:string,lines:array<string>>>"
MISC_FIELDS = (
    "servings", "prep_time", "cook_time", "author", "description",
    "rating", "make_again", "ratings", "image_location", "image_url",
)


@dataclass(frozen=True)
class SiteLayout:
    """Where a site keeps the parts of a recipe."""

    title: Sequence[Sel] = (Sel("h1"),)
    main: Sequence[Sel] = (Sel("div", cls="main-content"),)
    ingredient_groups: Sequence[Sel] = (
        Sel("div", cls="ingredients-info"),
        Sel("ol", cls="ingredient-groups"),
        Sel("li", cls="ingredient-group"),
    )
    instruction_groups: Sequence[Sel] = (
        Sel("div", cls="instructions"),
        Sel("ol", cls="preparation-groups"),
        Sel("li", cls="preparation-group"),
    )
    group_name: Sel = Sel("strong")
    group_line: Sel = Sel("li")
    skip_ingredient_prefix: str = "Equipment"
    summary: dict[str, str] = field(
        default_factory=lambda: {"servings": "yield", "prep_time": "active-time", "cook_time": "total-time"}
    )
    summary_list: Sel = Sel("dl", cls="summary-data")
    authors: Sequence[Sel] = (Sel("cite", cls="contributors"), Sel("a", cls="contributor"))
    description: Sequence[Sel] = (Sel("div", attr=("itemprop", "description")),)
    review_count: Sequence[Sel] = (Sel("div", cls="review-rating"), Sel("span", attr=("itemprop", "reviewCount")))
    rating: Sequence[Sel] = (Sel("div", cls="review-rating"), Sel("span", cls="rating"))
    make_again: Sequence[Sel] = (Sel("div", cls="prepare-again-rating"), Sel("span"))
    image: Sequence[Sel] = (Sel("div", cls="recipe-image"), Sel("img"))
    image_attribute: str = "srcset"
    # site-specific replacements: field name -> f(nodes, text) -> Column
    override: dict[str, Callable[[Column, Column], Column]] = field(default_factory=dict)


DEFAULT_LAYOUT = SiteLayout()


def grouped_lines(
    nodes: Column, text: Column, groups: Sequence[Sel], name: Sel, line: Sel, skip_prefix: str | None = None
) -> Column:
    """Named lists of lines, in page order.

    An unnamed group is ``part_{i}``, counting all groups from 1. Empty lines
    and lines starting with ``skip_prefix`` are left out, then groups without
    lines. A repeated name keeps its first place and its last lines. No group on
    the page is NULL, only empty groups an empty array.
    """
    def build(found: Column, t: Column) -> Column:
        def one(g: Column, i: Column) -> Column:
            own = below(nodes, g)
            label = F.get(F.filter(own, lambda n: name.test(n, t)), F.lit(0))
            texts = F.transform(F.filter(own, lambda n: line.test(n, t)), lambda n: stripped_text(node_text(n, t)))
            keep = F.filter(
                texts,
                lambda x: (x != "") & (~F.startswith(x, F.lit(skip_prefix)) if skip_prefix is not None else F.lit(True)),
            )
            return F.struct(
                F.coalesce(
                    non_empty(stripped_text(node_text(label, t))), F.concat(F.lit("part_"), (i + 1).cast("string"))
                ).alias("group"),
                keep.alias("lines"),
            )

        filled = F.filter(F.transform(found, one), lambda g: F.size(g["lines"]) > 0)
        merged = let(
            filled,
            lambda gs: F.transform(
                F.array_distinct(F.transform(gs, lambda g: g["group"])),
                lambda nm: F.element_at(F.filter(gs, lambda g: g["group"] == nm), -1),
            ),
        )
        return F.when(F.size(found) > 0, merged)

    return with_text(text, lambda t: let(select_all(nodes, t, *groups), lambda found: build(found, t)))


def summary_field(nodes: Column, text: Column, block: Sel, css_class: str) -> Column:
    """``dd`` below the block whose class attribute is exactly ``css_class``."""
    return first_text(nodes, text, block, Sel("dd", attr=("class", css_class)))


def author_names(nodes: Column, text: Column, path: Sequence[Sel]) -> Column:
    found = select_all(nodes, text, *path)
    return let(texts_of(found, text), lambda a: F.when(F.size(a) > 0, F.array_join(a, "\n")))


def description_text(nodes: Column, text: Column, path: Sequence[Sel]) -> Column:
    """Texts of the element children, blank ones dropped, one per line."""
    def children(box: Column) -> Column:
        parts = texts_of(F.filter(nodes, lambda n: n["parent"] == box["id"]), text)
        return non_empty(F.array_join(F.filter(parts, lambda t: t != ""), "\n"))

    return let(select_first(nodes, text, *path), lambda b: F.when(b.isNotNull(), children(b)))


def ratings(nodes: Column, text: Column, layout: SiteLayout) -> Column:
    """STRUCT<rating, make_again, ratings, raw_count>: all but ``raw_count`` NULL unless the count is above 0."""
    raw = first_text(nodes, text, *layout.review_count)

    def gate(r: Column) -> Column:
        n = r.try_cast("int")
        rated = n > 0
        return F.struct(
            F.when(rated, F.nullif(rating_ratio(first_text(nodes, text, *layout.rating)), F.lit(0.0))).alias("rating"),
            F.when(rated, F.nullif(percent_ratio(first_text(nodes, text, *layout.make_again)), F.lit(0.0))).alias(
                "make_again"
            ),
            F.when(rated, n).alias("ratings"),
            r.alias("raw_count"),
        )

    return let(raw, gate)


def image_source(nodes: Column, text: Column, path: Sequence[Sel], attribute: str) -> Column:
    """Image attribute of the first match; NULL without image or attribute."""
    return let(
        select_first(nodes, text, *path), lambda n: F.when(n.isNotNull(), F.element_at(n["attrs"], attribute))
    )


def image_file_name(image_url: Column | str, path: Column | str) -> Column:
    """Stored-file name of a page's image: the page key with the image's extension."""
    u = F.col(image_url) if isinstance(image_url, str) else image_url
    return urls.path_to_file_name(path, F.element_at(F.split(u, r"\."), -1))


def fields(layout: SiteLayout) -> dict[str, Callable[[Column, Column], Column]]:
    """Every field of a recipe as a function of a page's nodes and text."""
    def parts(groups: Sequence[Sel], skip: str | None = None) -> Callable[[Column, Column], Column]:
        return lambda n, t: grouped_lines(n, t, groups, layout.group_name, layout.group_line, skip)

    def summary(css_class: str) -> Callable[[Column, Column], Column]:
        return lambda n, t: summary_field(n, t, layout.summary_list, css_class)

    return {
        "title": lambda n, t: first_text(n, t, *layout.title),
        "ingredients": parts(layout.ingredient_groups, layout.skip_ingredient_prefix),
        "instructions": parts(layout.instruction_groups),
        **{k: summary(c) for k, c in layout.summary.items()},
        "author": lambda n, t: author_names(n, t, layout.authors),
        "description": lambda n, t: description_text(n, t, layout.description),
        "_ratings": lambda n, t: ratings(n, t, layout),
        "image_url": lambda n, t: image_source(n, t, layout.image, layout.image_attribute),
        **layout.override,
    }


def tags_of(*paths: Sequence[Sel]) -> list[str] | None:
    """Tags the parser must emit for some selectors; None (all) where a step names no tag."""
    tags = {s.tag for p in paths for s in p}
    return None if None in tags else sorted(tags)


def parse_for(pages: DataFrame, layout: SiteLayout, keys: Sequence[str]) -> DataFrame:
    """Parse with only the elements a layout looks at; all where a site brings own functions."""
    box = layout.description[-1] if layout.description else None
    if layout.override or (box is not None and box.attr is None):
        return parse_pages(pages, keys=keys)
    keep = tags_of(
        layout.title, layout.ingredient_groups, layout.instruction_groups, layout.authors, layout.description,
        layout.review_count, layout.rating, layout.make_again, layout.image,
        (layout.group_name, layout.group_line, layout.summary_list, Sel("dd")),
    )
    return parse_pages(pages, keys=keys, keep=keep, children_of=[box.attr] if box else [])


PATHS = ("title", "ingredient_groups", "instruction_groups", "authors", "description", "review_count", "rating", "make_again", "image")
STEPS = ("group_name", "group_line", "summary_list")
LAYOUT_SCHEMA = (
    "domain string, layout struct<" + ",".join([f"{p}:array<{STEP_TYPE}>" for p in PATHS] + [f"{p}:{STEP_TYPE}" for p in STEPS])
    + ",skip_ingredient_prefix:string,servings:string,prep_time:string,cook_time:string,image_attribute:string>"
)


def layout_table(spark: SparkSession, layouts: dict[str, SiteLayout]) -> DataFrame:
    """(domain, layout): the selectors of sites as rows, one a domain. Layouts with functions of their own do not fit in."""
    def step(s: Sel) -> tuple:
        return (s.tag, s.cls, s.id, *(s.attr or (None, None)), s.text)

    def row(lay: SiteLayout) -> tuple:
        if lay.override:
            raise ValueError("a layout with functions of its own is no data")
        return (
            *[[step(s) for s in getattr(lay, p)] for p in PATHS], *[step(getattr(lay, p)) for p in STEPS], lay.skip_ingredient_prefix,
            *[lay.summary.get(k) for k in ("servings", "prep_time", "cook_time")], lay.image_attribute,
        )

    return spark.createDataFrame([(d, row(lay)) for d, lay in layouts.items()], LAYOUT_SCHEMA)


def layout_of(column: str) -> SiteLayout:
    """A layout whose parts are read from a row's own ``column``: the plan is the same for any number of sites."""
    c = F.col(column)
    return SiteLayout(
        **{p: (c[p],) for p in PATHS},
        **{p: StepColumn(c[p]) for p in STEPS},
        # without a prefix no line is skipped: no line begins with NUL
        skip_ingredient_prefix=F.coalesce(c["skip_ingredient_prefix"], F.lit("\x00")),
        summary={k: c[k] for k in ("servings", "prep_time", "cook_time")},
        image_attribute=c["image_attribute"],
    )


def fields_by_site(layouts: dict[str, SiteLayout], domain: Column, nodes: Column, text: Column) -> dict[str, Column]:
    """The fields of :func:`fields`, each chosen by the page's domain; unknown sites get NULL."""
    sites: list[tuple[SiteLayout, list[str]]] = []
    for d, lay in layouts.items():
        same = next((names for known, names in sites if known is lay), None)
        if same is None:
            sites.append((lay, [d]))
        else:
            same.append(d)
    per_layout = [(domain.isin(names), fields(lay)) for lay, names in sites]
    out = {}
    for k, first in per_layout[0][1].items():
        chosen = F.when(per_layout[0][0], first(nodes, text))
        for mine, got in per_layout[1:]:
            chosen = chosen.when(mine, got[k](nodes, text))
        out[k] = chosen
    return out


def scrape(
    pages: DataFrame,
    layouts: dict[str, SiteLayout] | DataFrame | SiteLayout = DEFAULT_LAYOUT,
    images: DataFrame | None = None,
    image_folder: str = "images",
) -> DataFrame:
    """``pages(domain, path, html)`` -> recipe rows, plus ``raw_count`` for the error table.

    With several layouts each page takes its site's, after one common parse;
    pages of other sites are left out. A table of layouts, see
    :func:`layout_table`, meets the pages by domain, in a join that splits large
    sites where the table is too large for the planner to broadcast; a dict is
    for few sites, some with functions of their own, and grows the plan.
    ``images`` (column ``file_name``, unique) says which images are stored.
    """
    keys = [c for c in pages.columns if c != "html"]
    nodes, text = F.col("nodes"), F.col("text")
    if isinstance(layouts, DataFrame):
        unique = layouts.groupBy("domain").agg(F.min("layout").alias("_layout"))
        parsed = parse_pages(pages, keys=keys)
        dom = spread_join(parsed, unique, ["domain"], ["path"], "inner", heavy_keys(pages, ["domain"]))
        got = {k: f(nodes, text) for k, f in fields(layout_of("_layout")).items()}
    elif isinstance(layouts, dict):
        dom = parse_pages(pages.where(F.col("domain").isin(list(layouts))), keys=keys)
        got = fields_by_site(layouts, F.col("domain"), nodes, text)
    else:
        dom = parse_for(pages, layouts, keys)
        got = {k: f(nodes, text) for k, f in fields(layouts).items()}
    rows = dom.select(*keys, *[c.alias(k) for k, c in got.items()])
    if images is not None:
        # pages without an image get a key of their own, or they would all meet in one task
        name = F.coalesce(image_file_name("image_url", "path"), F.concat(F.lit("/"), F.col("path")))
        stored = images.select(F.col("file_name").alias("_file")).distinct()
        rows = rows.withColumn("_name", name).join(stored, F.col("_name") == F.col("_file"), "left")
        location = F.when(F.col("_file").isNotNull(), F.concat(F.lit(image_folder + "/"), F.col("_file")))
    else:
        location = F.lit(None).cast("string")
    misc = {k: F.col(k) for k in MISC_FIELDS if k not in ("rating", "make_again", "ratings", "image_location")}
    misc |= {k: F.col(f"_ratings.{k}") for k in ("rating", "make_again", "ratings")}
    misc["image_location"] = location
    return rows.select(
        *keys,
        "title",
        "ingredients",
        "instructions",
        F.struct(*[misc[k].alias(k) for k in MISC_FIELDS]).alias("misc"),
        F.col("_ratings.raw_count").alias("raw_count"),
    )


def scrape_errors(rows: DataFrame) -> DataFrame:
    """Pages whose review count could not be read, as error records."""
    bad = F.col("raw_count").isNotNull() & F.col("raw_count").try_cast("int").isNull()
    return rows.where(bad).select(
        "path",
        F.lit("ValueError").alias("error_type"),
        F.array(F.concat(F.lit("review count is not a number: "), F.col("raw_count"))).alias("error_message"),
        F.lit(None).cast("string").alias("note"),
        F.lit("scrape").alias("stage"),
    )


def trim_pages(pages: DataFrame, layout: SiteLayout = DEFAULT_LAYOUT) -> DataFrame:
    """Keep only the main content of each page; a page without it stays whole."""
    keys = pages.columns
    marks = ["." + s.cls for s in layout.main if s.cls]
    dom = parse_pages(pages, keys=keys, keep=marks, outer=marks, with_text=False)
    main = select_first(F.col("nodes"), F.col("text"), *layout.main)
    out = {"html": F.coalesce(let(main, lambda n: n["outer"]), F.col("html"))}
    return dom.withColumns(out).select(*keys)


def image_plan(
    pages: DataFrame,
    images: DataFrame,
    css: Sequence[Sel],
    attribute: str,
    site: str | None = None,
) -> DataFrame:
    """Images still to fetch: one row per page with an image that is not stored.

    ``pages([domain,] path, html)``, ``images([domain,] file_name)``: with a
    domain, sites with equal paths keep their images apart. A relative address is
    completed with ``site``, or with the page's own domain where none is given.
    """
    keys = [c for c in ("domain", "path") if c in pages.columns]
    own = keys[:-1]
    dom = parse_pages(pages, keys=keys, keep=tags_of(css), with_text=False)
    source = image_source(F.col("nodes"), F.col("text"), css, attribute)
    found = dom.select(*keys, source.alias("_src")).where(F.col("_src").isNotNull() & (F.col("_src") != ""))
    parts = urls.url_parts("_src")
    base = F.lit(site) if site is not None else F.concat(F.lit("https://"), F.col("domain"))
    plan = found.select(
        *keys,
        F.when(parts["domain"].isNull(), F.concat(base, parts["path"])).otherwise(F.col("_src")).alias("image_url"),
        image_file_name("_src", "path").alias("file_name"),
    )
    # of several addresses for one file the first by (path, address), the same at every run
    first = plan.groupBy(*own, "file_name").agg(F.min(F.struct("path", "image_url")).alias("_first")).select(*own, "_first.*", "file_name")
    on = [*[c for c in own if c in images.columns], "file_name"]
    return first.join(images.select(*on).distinct(), on, "left_anti")
