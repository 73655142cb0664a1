"""Main text of web pages by composite text density.

For every element the density is its characters per tag, adjusted by its links:
dense prose scores high, link lists low. The element whose children's densities
sum highest is the content, with the whole article around it if the page marks
one; on every page other elements join it if their density reaches the lowest
one on the path from the content up to the body. What pages name as menus, notices, adverts, forms or comments carries
no text from the start. A name counts if it consists of such words only, and not
inside an article on a heading or on what holds half of its text with few links.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import without

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SILENT = RAW | frozenset(
    "head nav footer aside form template noscript button select option dialog menu svg canvas audio video "
    "fieldset datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike "
    "strong sub sup time tt u var wbr ruby rb rt rp nobr label output object picture slot meter progress "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mpadded "
    "menclose semantics annotation".split())
#: An open element of the key ends when one of the values begins.
ENDS = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 header hr main menu nav ol p pre section table ul li dd dt".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option"]),
}
#: An implied end does not reach out of these.
WALLS = frozenset("table ul ol dl div section article main body html td th".split())
COMMENTS = frozenset("comment comments commentlist respond disqus replies reactions".split())
NOT_TEXT = COMMENTS | frozenset(
    "nav navbar navigation navi menu menus submenu topbar toolbar footer sidebar sidenav aside ad ads adv advert "
    "adverts advertisement advertising banner cookie cookies consent gdpr notice notices alert promo promotion sponsor "
    "sponsored share sharing sharebar social related recommended recommendations newsletter subscribe subscription "
    "signup login breadcrumb breadcrumbs pagination pager popup modal overlay widget widgets masthead skiplink "
    "siteheader sitefooter hidden".split())
#: May stand beside those in a name ("cookie-bar", "site-footer"); any other word makes it the name of something else.
BESIDE = frozenset("a the my main site page top bottom left right first last bar box block wrap wrapper container inner outer "
                   "content area section list item items links link header buttons button icons form post article".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMED = NOT_TEXT | BESIDE
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
PLAIN = re.compile(r"""[^"'>]*""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")


class Page:
    """Elements in page order as parallel lists; element 0 is the page itself."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attrs = ["#page"], [-1], [""]
        self.texts: list[tuple[int, str]] = []  # (element, text) in page order; "" marks a line break
        self._read(source)

    def _read(self, src: str) -> None:
        stack, pos, n = [0], 0, len(src)
        absent: set[str] = set()  # quote characters that the rest of the page does not hold
        while pos < n:
            lt = src.find("<", pos)
            if lt < 0:
                lt = n
            if lt > pos:
                self.texts.append((stack[-1], src[pos:lt]))
            if lt == n:
                return
            nxt = src[lt + 1:lt + 2]
            if src.startswith("<!--", lt):
                end = src.find("-->", lt + 4)
                pos = n if end < 0 else end + 3
            elif nxt in ("!", "?"):
                end = src.find(">", lt)
                pos = n if end < 0 else end + 1
            elif m := NAME.match(src, lt + 1 + (nxt == "/")):
                tag, at = m[0].lower(), m.end()
                while True:  # to the ">" that no quotes enclose
                    at = PLAIN.match(src, at).end()
                    if at >= n or src[at] == ">":
                        break
                    quote = src[at]
                    close = -1 if quote in absent else src.find(quote, at + 1)
                    if close < 0:
                        absent.add(quote)
                    at = max(close, at) + 1
                if at >= n:
                    return
                pos = at + 1
                if nxt == "/":
                    self._close(stack, tag)
                else:
                    pos = self._open(stack, tag, src[m.end():at], src, pos)
            else:
                self.texts.append((stack[-1], "<"))
                pos = lt + 1

    def _open(self, stack: list[int], tag: str, attrs: str, src: str, pos: int) -> int:
        for k in range(len(stack) - 1, 0, -1):
            open_tag = self.tag[stack[k]]
            if tag in ENDS.get(open_tag, ()):
                del stack[k:]
                break
            if open_tag in WALLS:
                break
        if tag == "br":
            self.texts.append((stack[-1], " "))
        self.tag.append(tag), self.parent.append(stack[-1]), self.attrs.append(attrs)
        me = len(self.tag) - 1
        if tag in RAW:
            end = re.compile(f"</{tag}", re.I).search(src, pos)
            return len(src) if end is None else end.start()  # its end tag closes nothing
        if tag not in VOID and not attrs.endswith(" /"):
            stack.append(me)
        return pos

    def _close(self, stack: list[int], tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] == tag:
                del stack[k:]
                return
            if tag in INLINE and self.tag[stack[k]] not in INLINE:
                return

    # --- what carries no text ------------------------------------------------

    def silent(self) -> list[bool]:
        """Whether an element, by itself or by an ancestor, is not part of an article."""
        size = len(self.tag)
        doubt, inside_article = [False] * size, [False] * size
        out = [False] * size
        for i in range(1, size):
            tag, up = self.tag[i], self.parent[i]
            inside_article[i] = inside_article[up] or tag in ("article", "main")
            words, role, hidden = self._names(i)
            if tag in SILENT or (tag == "header" and not inside_article[i]) or hidden or role in ROLES:
                out[i] = True
            elif tag not in ("html", "body", "main") and words & COMMENTS:
                out[i] = True
            elif tag not in ("html", "body", "main", "article") and (
                    words & NOT_TEXT or ("header" in words and not inside_article[i])):
                doubt[i] = True
            out[i] = out[i] or out[up]
        if any(doubt):
            self._clear(doubt, out)
        keeps = [False] * size  # holds an article: a name such as "page with sidebar" does not silence it
        for i in range(size - 1, 0, -1):
            keeps[i] |= self.tag[i] in ("article", "main", "h1") and not out[i]
            keeps[self.parent[i]] |= keeps[i]
        for i in range(1, size):
            out[i] = out[i] or out[self.parent[i]] or (doubt[i] and not keeps[i])
        return out

    def _clear(self, doubt: list[bool], out: list[bool]) -> None:
        """Inside an article or main element, take the doubt from headings and from what cannot be boilerplate.

        That is what holds half of that element's text, at most a fifth of it in links.
        """
        size = len(self.tag)
        chars, links, linked, scope = [0] * size, [0] * size, [False] * size, [0] * size
        for i in range(1, size):
            up = self.parent[i]
            linked[i] = linked[up] or self.tag[i] == "a"
            scope[i] = up if self.tag[up] in ("article", "main") else scope[up]
        for i, text in self.texts:
            if not out[i]:
                k = len(text.strip())
                chars[i] += k
                links[i] += k * linked[i]
        for i in range(size - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            links[self.parent[i]] += links[i]
        for i in range(1, size):
            if doubt[i] and scope[i]:
                prose = chars[i] * 2 >= chars[scope[i]] and links[i] * 5 <= chars[i]
                doubt[i] = not (prose or self.tag[i] in ("h1", "h2", "h3", "h4", "h5", "h6"))

    def _names(self, i: int) -> tuple[set[str], str, bool]:
        if not self.attrs[i]:
            return set(), "", False
        found = {m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "") for m in ATTRIBUTE.finditer(self.attrs[i])}
        words: set[str] = set()
        for name in f"{found.get('class', '')} {found.get('id', '')}".lower().split():
            parts = set(re.findall("[^\\W\\d_]+", name))
            if parts <= NAMED:
                words |= parts
        style = found.get("style", "").replace(" ", "").lower()
        return words, found.get("role", "").lower(), "hidden" in found or "display:none" in style

    # --- densities -------------------------------------------------------------

    def content(self) -> list[bool]:
        """Whether an element belongs to the main text."""
        size, silent = len(self.tag), self.silent()
        chars, links, tags, link_tags = [0] * size, [0] * size, [0] * size, [0] * size
        in_link = [False] * size
        for i in range(1, size):
            in_link[i] = self.tag[i] == "a" or in_link[self.parent[i]]
        for i, text in self.texts:
            if not silent[i]:
                k = len(re.sub(r"\s+", " ", text).strip())
                chars[i] += k
                links[i] += k * in_link[i]
        for i in range(size - 1, 0, -1):
            if not silent[i]:
                up = self.parent[i]
                chars[up] += chars[i]
                links[up] += links[i]
                tags[up] += tags[i] + 1
                link_tags[up] += link_tags[i] + (self.tag[i] == "a")
        body = next((i for i in range(size) if self.tag[i] == "body"), 0)
        share = links[body] / max(chars[body], 1)

        def density(i: int) -> float:
            if not chars[i]:
                return 0.0
            c, lc, t, lt = chars[i], max(links[i], 1), max(tags[i], 1), max(link_tags[i], 1)
            base = math.log(c / max(c - links[i], 1) * links[i] + share * c + math.e)
            return c / t * math.log(c / lc * (t / lt)) / math.log(base) if base > 1 else c / t * math.log(c / lc * t / lt)

        dense = [0.0 if silent[i] else density(i) for i in range(size)]
        sums = [0.0] * size
        for i in range(1, size):
            sums[self.parent[i]] += dense[i]
        best = max(range(size), key=lambda i: (sums[i], chars[i], -i))
        threshold, article, i = dense[best], -1, best
        while i > 0:
            if self.tag[i] in ("article", "main") and article < 0:
                article = i
            if i == body:
                break
            i = self.parent[i]
            threshold = min(threshold, dense[i])
        chosen = [False] * size
        chosen[best if article < 0 else article] = True
        for i in range(size):
            # the body itself is the scope, not a candidate
            if i != body and self.tag[i] not in ("#page", "html") and chars[i] and dense[i] >= threshold:
                chosen[i] = True
        for i in range(1, size):
            chosen[i] = chosen[i] or chosen[self.parent[i]]
        return [c and not s for c, s in zip(chosen, silent, strict=True)]

    def main_text(self) -> str:
        """Blocks of the content in page order, one a line."""
        chosen, block_of = self.content(), [0] * len(self.tag)
        for i in range(1, len(self.tag)):
            block_of[i] = block_of[self.parent[i]] if self.tag[i] in INLINE or "-" in self.tag[i] else i  # own elements flow
        blocks: list[str] = []
        parts: list[str] = []
        last = -1
        for i, text in self.texts:
            if not chosen[i]:
                continue
            if block_of[i] != last and parts:
                blocks.append("".join(parts))
                parts = []
            last = block_of[i]
            parts.append(text)
        blocks.append("".join(parts))
        lines = (" ".join(entities.unescape(b).split()) for b in blocks)
        return "\n".join(x for x in lines if x)


def extract_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in ``out``.

    Null, empty or textless pages give an empty text; a page without tags is its
    own text. A column named like ``out`` is replaced. One narrow map: a page
    never leaves its row, and reading is linear in its length.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([Page(source).main_text() if source else "" for source in batch], dtype=object)

    return without(pages, [out] if out != html else []).withColumn(out, F.pandas_udf(run, "string")(F.col(html)))
