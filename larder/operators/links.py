"""Links of a page, and which of them a crawl admits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import urls


@dataclass(frozen=True)
class LinkRules:
    """What a crawl follows: ``allow`` and ``avoid`` are substrings, avoid wins."""

    allow: Sequence[str] = field(default_factory=tuple)
    avoid: Sequence[str] = field(default_factory=tuple)


def anchor_array(nodes: Column, text: Column, allow: Sequence[str] = ()) -> Column:
    """Anchors of a page as ARRAY<STRUCT<href, outer_html>>.

    Without an allow list an anchor needs an href and a single piece of text;
    with one, its href needs an allowed substring, and it appears once per
    substring it contains.
    """
    anchors = F.filter(nodes, lambda n: (n["tag"] == "a") & F.element_at(n["attrs"], "href").isNotNull())

    def shape(n: Column) -> Column:
        return F.struct(F.element_at(n["attrs"], "href").alias("href"), n["outer"].alias("outer_html"))

    if not allow:
        return F.transform(F.filter(anchors, lambda n: n["single"]), shape)

    def containing(word: str) -> Column:
        return F.filter(anchors, lambda n: F.contains(F.element_at(n["attrs"], "href"), F.lit(word)))

    lists = [F.transform(containing(word), shape) for word in allow]
    return lists[0] if len(lists) == 1 else F.concat(*lists)


def page_links(dom: DataFrame, keys: Sequence[str], allow: Sequence[str] = ()) -> DataFrame:
    """One row per link: ``keys``, position on the page, href and source of the anchor."""
    found = dom.select(*keys, F.posexplode(anchor_array(F.col("nodes"), F.col("text"), allow)).alias("pos", "link"))
    return found.select(*keys, "pos", "link.href", "link.outer_html")


def resolve_links(links: DataFrame) -> DataFrame:
    """Add the target's domain and path, and ``error`` where it cannot be resolved."""
    shown = links.where(urls.visible("outer_html") & (F.col("href") != ""))
    # a generator, so that tests on the target do not work it out again
    return shown.select("*", F.inline(F.array(urls.resolve_href("href"))))


def followable(own_domain: Column | str, rules: LinkRules) -> Column:
    """The tests on a resolved link that need no crawl state."""
    return (
        F.col("error").isNull()
        & urls.tidy_path("path")
        & urls.same_domain("domain", own_domain)
        & ~urls.contains_any("path", rules.avoid)
    )


SEEN_STATES = ("finished", "errored", "to_scrape")


def unseen(links: DataFrame, state: DataFrame) -> DataFrame:
    """Drop links whose (domain, path) was handled; pending ones stay.

    Targets are made distinct first: a page half the site links to is then one
    row, however often it was found.
    """
    seen = state.where(F.col("state").isin(*SEEN_STATES)).select("domain", "path")
    return links.dropDuplicates(["domain", "path"]).join(seen, ["domain", "path"], "left_anti")


def admit(links: DataFrame, own_domain: str, rules: LinkRules, state: DataFrame | None = None) -> DataFrame:
    """Distinct (domain, path) targets that pass every rule."""
    ok = (
        resolve_links(links)
        .where(followable(F.lit(own_domain), rules))
        .select(F.lit(own_domain).alias("domain"), "path")
    )
    return ok.dropDuplicates(["domain", "path"]) if state is None else unseen(ok, state)
