"""URL columns: splitting, resolving, admission tests and the stored-file key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.text import col, non_empty

# These patterns and limits decide which links a crawl admits.
FULL_URL = r"(?i)(?:(https?)://)?((?:www\.)?[^/]+\.[^/]+)(/[^\n]+)"
PROTOCOL_RELATIVE = r"//([^/]{3,})(/[^\n]*)"
HOST_LEADING_CHARS = "w."
HOST_TRAILING_CHARS = "/"
MAX_PATH_LENGTH = 120
MESSY_MARK = "http"
HIDDEN_MARK = "hidden"
HIDDEN_EXCEPTION = "overflow-hidden"


def url_parts(url: Column | str) -> Column:
    """STRUCT<scheme, domain, path>; what does not look like a full url is a path.

    The path keeps query and fragment. Scheme and domain may be NULL.
    """
    u = col(url)
    path = F.regexp_extract(u, FULL_URL, 3)
    matched = path != ""
    return F.when(
        u.isNotNull(),
        F.struct(
            F.when(matched, non_empty(F.regexp_extract(u, FULL_URL, 1))).alias("scheme"),
            F.when(matched, F.regexp_extract(u, FULL_URL, 2)).alias("domain"),
            F.when(matched, path)
            .when(F.startswith(u, F.lit("/")), u)
            .otherwise(F.concat(F.lit("/"), u))
            .alias("path"),
        ),
    )


def base_url(parts: Column) -> Column:
    """``scheme://domain`` of a seed; NULL for a seed without a domain (to be rejected)."""
    return F.when(
        parts["domain"].isNotNull(),
        F.concat(F.coalesce(parts["scheme"], F.lit("https")), F.lit("://"), parts["domain"]),
    )


def resolve_href(href: Column | str) -> Column:
    """STRUCT<domain, path, error> of an href; relative paths count from the root.

    A protocol-relative href without a path cannot be resolved: its ``error`` is
    set and domain and path are NULL.
    """
    h = col(href)
    host = F.regexp_extract(h, PROTOCOL_RELATIVE, 1)
    two_slashes = F.startswith(h, F.lit("//"))
    rooted = F.startswith(h, F.lit("/"))
    parts = url_parts(h)
    none = F.lit(None).cast("string")
    return (
        F.when(
            two_slashes,
            F.struct(
                non_empty(host).alias("domain"),
                non_empty(F.regexp_extract(h, PROTOCOL_RELATIVE, 2)).alias("path"),
                F.when(host == "", F.concat(F.lit("unresolvable link: "), h)).alias("error"),
            ),
        )
        .when(
            F.startswith(h, F.lit("/../")),
            F.struct(none.alias("domain"), F.substring(h, F.lit(4), F.length(h)).alias("path"), none.alias("error")),
        )
        .when(rooted, F.struct(none.alias("domain"), h.alias("path"), none.alias("error")))
        .when(
            h.isNotNull(),
            F.struct(parts["domain"].alias("domain"), parts["path"].alias("path"), none.alias("error")),
        )
    )


def _bare_host(c: Column) -> Column:
    # character-set trims: leading w's and dots, trailing slashes
    return F.rtrim(F.ltrim(c, F.lit(HOST_LEADING_CHARS)), F.lit(HOST_TRAILING_CHARS))


def same_domain(domain: Column | str, own: Column | str) -> Column:
    """Links without a domain are internal; others are compared without leading ``www.``."""
    d = F.coalesce(col(domain), F.lit(""))
    return (d == "") | (_bare_host(d) == _bare_host(col(own)))


def visible(outer_html: Column | str) -> Column:
    """False for an element marked hidden (an ``overflow-hidden`` mark is no objection)."""
    h = F.lower(col(outer_html))
    return ~F.contains(h, F.lit(HIDDEN_MARK)) | F.contains(h, F.lit(HIDDEN_EXCEPTION))


def contains_any(c: Column | str, words: Sequence[str]) -> Column:
    if not words:
        return F.lit(False)
    found = F.contains(col(c), F.lit(words[0]))
    for w in words[1:]:
        found = found | F.contains(col(c), F.lit(w))
    return found


def tidy_path(path: Column | str) -> Column:
    """Non-empty, not too long, no url inside."""
    p = F.coalesce(col(path), F.lit(""))
    return (p != "") & (F.length(p) <= MAX_PATH_LENGTH) & ~F.contains(p, F.lit(MESSY_MARK))


def path_to_file_name(path: Column | str, extension: Column | str = "html") -> Column:
    """Stored-file key of a path: percent-encoded, one extension; reversible."""
    ext = F.lit(extension) if isinstance(extension, str) else extension
    return F.concat(F.url_encode(F.ltrim(col(path), F.lit("/"))), F.lit("."), ext)


def file_name_to_path(name: Column | str) -> Column:
    """Inverse of :func:`path_to_file_name`: the path without its leading slash."""
    return F.url_decode(F.regexp_replace(col(name), r"\.[^.]*$", ""))
