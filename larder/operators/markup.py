"""The per-page helper behind :func:`larder.operators.dom.parse_pages`: markup to element records.

It travels to the executors with the job, which need not have this package.
"""

from __future__ import annotations

import html
import re
import sys
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate, compress

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values from the HTML standard: elements without content, elements whose start ends an open paragraph, and what
# else a start tag ends (up to the nearest of the enclosing tags).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr main menu nav ol p pre section table ul li dd dt".split()
)
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dd": (("dd", "dt"), ("dl",)),
    "dt": (("dd", "dt"), ("dl",)),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

# Elements whose content is text: as it stands, or with character references.
RAW_TEXT = frozenset(("script", "style"))
DECODED_TEXT = frozenset(("title", "textarea"))

_NAME = re.compile(r"[a-z][^\s/>]*", re.I)
_TO_QUOTE = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        value = double or single or bare
        out.setdefault(name.lower(), html.unescape(value) if "&" in value else value)
    return out


class _Tags:
    """Finds where tags end, each part of a source being read a bounded number of times."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.last = {q: source.rfind(q) for q in ">\"'"}
        self.dead: set[int] = set()  # places outside quotes from which no tag end follows

    def end(self, at: int) -> int:
        """Place of the ">" that ends the tag read up to ``at``, or -1.

        Quotes enclose any character; where a quote is never closed, the next
        ">" ends the tag.
        """
        if self.last[">"] < at:
            return -1
        source, start, passed = self.source, at, []
        while at not in self.dead:
            passed.append(at)
            at = _TO_QUOTE.match(source, at).end()
            if at >= len(source):
                break
            if source[at] == ">":
                return at
            if self.last[source[at]] == at:
                break
            at = source.find(source[at], at + 1) + 1
        self.dead.update(passed)
        return source.find(">", start)


def _closes_itself(rest: str) -> bool:
    """Whether what follows a tag's name ends in a slash that is not part of an unquoted value."""
    if not rest.endswith("/"):
        return False
    tail = rest.rsplit(None, 1)[-1]
    value = tail.partition("=")[2]
    return not (value and '"' not in value and "'" not in value)


def _pieces(source: str) -> Iterator[tuple[int, int, str, str, str]]:
    """The source in order: (from, to, kind, tag, attributes); kind is text, raw, open, close, comment or mark."""
    tags, size, at, begun = _Tags(source), len(source), 0, 0
    while True:
        lt = source.find("<", at)
        if lt < 0:
            break
        if lt > tags.last[">"] and not source.startswith("<!--", lt):  # no tag ends any more; a comment may still begin
            lt = source.find("<!--", lt)
            if lt < 0:
                break
        nxt = source[lt + 1 : lt + 2]
        name = _NAME.match(source, lt + 1 + (nxt == "/"))
        kind = tag = rest = ""
        end = -1
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            kind, end = "comment", size if end < 0 else end + 3
        elif nxt in ("!", "?"):
            kind, end = "mark", source.find(">", lt) + 1
        elif name:
            stop = tags.end(name.end())
            if stop >= 0:
                kind, end = "close" if nxt == "/" else "open", stop + 1
                tag, rest = name[0].lower(), source[name.end() : stop]
        if end <= 0:
            at = lt + 1
            continue
        if lt > begun:
            yield begun, lt, "text", "", ""
        yield lt, end, kind, tag, rest
        at = begun = end
        if kind == "open" and tag in RAW_TEXT | DECODED_TEXT:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, end)
            at = size if close is None else close.start()
            if at > end:
                yield end, at, "raw" if tag in RAW_TEXT else "text", "", ""
            begun = at
    if begun < size:
        yield begun, size, "text", "", ""


# A tag in which every quote is closed, with the content of elements that hold text alone; comments and marks. What no
# tag end follows, or a quote that stays open, is taken to the end of the page, and :func:`_pieces` reads that page.
_REST = r"[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*>"
_HOLDS_TEXT = "|".join(
    rf"<{t}(?=[\s/>]){_REST}[^<]*(?:<(?!/{t}[\s/>])[^<]*)*" for t in sorted(RAW_TEXT | DECODED_TEXT)
)
_TAG = rf"</?[a-z][^\s/>]*(?=[\s/>]){_REST}"
_TOKEN = re.compile(rf"({_HOLDS_TEXT}|{_TAG}|<!--[\s\S]*?(?:-->|\Z)|<[!?][^>]*>|<(?:[!?]|/?[a-z])[\s\S]*)", re.I)
_ONE_TAG = re.compile(_TAG, re.I)

_OPEN, _CLOSE, _COMMENT, _OTHER = range(4)


class Tag:
    """What a tag says by itself, on whatever page it stands."""

    __slots__ = ("kind", "name", "rest", "alone", "ends_paragraph", "ends", "within", "_attrs")

    def __init__(self, kind: int, name: str = "", rest: str = "") -> None:
        self.kind, self.name, self.rest = kind, name, rest
        self.alone = name in VOID or _closes_itself(rest)
        # open elements that its start may end, and how far out
        self.ends_paragraph = name in ENDS_PARAGRAPH
        self.ends, self.within = IMPLIED_END.get(name, ((), ()))
        self._attrs: dict[str, str] | None = None

    @property
    def attrs(self) -> dict[str, str]:
        if self._attrs is None:
            self._attrs = _attributes(self.rest) if len(self.rest) > 1 else {}
        return self._attrs

    @property
    def classes(self) -> list[str]:
        return self.attrs["class"].split() if "class" in self.attrs else []


_MARKS = {"comment": Tag(_COMMENT), "mark": Tag(_OTHER), "raw": Tag(_OTHER)}
#: Tags as they were written last: sites repeat most of theirs. Bounded by number and by length.
_known: dict[str, Tag] = {}
_KNOWN_TAGS, _KNOWN_LENGTH = 8192, 256

# Texts, the tag after each, and a function for where in the source tags begin and how long they are: few pages need it.
Parts = tuple[Sequence[str], Sequence[Tag], Callable[[], tuple[Sequence[int], Sequence[int]]]]


def _regular(source: str) -> Parts | None:
    """The parts of a page, or None where a tag has no regular end."""
    split = _TOKEN.split(source)
    texts, tokens = split[::2], split[1::2]
    tags = list(map(_known.get, tokens))
    if None in tags:
        for i, tag in enumerate(tags):
            if tag is not None:
                continue
            token = tokens[i]
            if token in _known:  # met on this page
                tags[i] = _known[token]
                continue
            if token[1] in "!?":
                if token[1:4] != "!--" and token[-1] != ">":
                    return None
                tags[i] = _MARKS["comment" if token[1:4] == "!--" else "mark"]
                continue
            found = _ONE_TAG.match(token)
            if found is None:
                return None
            name = _NAME.match(token, 1 + (token[1] == "/"))
            word = name[0].lower()
            tags[i] = tag = Tag(_CLOSE if token[1] == "/" else _OPEN, word, token[name.end() : found.end() - 1])
            if found.end() < len(token):  # an element of text: its content comes before the next tag
                if word not in RAW_TEXT and word not in DECODED_TEXT:
                    return None
                texts[i + 1] = token[found.end() :] if word in DECODED_TEXT else ""
                tokens[i] = token[: found.end()]
            elif len(token) <= _KNOWN_LENGTH:
                if len(_known) >= _KNOWN_TAGS:
                    _known.clear()
                _known[token] = tag

    def places() -> tuple[Sequence[int], Sequence[int]]:
        return list(accumulate(map(len, split)))[::2], list(map(len, tokens))

    return texts, tags, places


def _any(source: str) -> Parts:
    """As :func:`_regular`, of any page."""
    texts, tags, begins, lengths, text = [], [], [], [], ""
    for before, at, kind, name, rest in _pieces(source):
        if kind == "text" and not text:
            text = source[before:at]
            continue
        texts.append(text)
        text = source[before:at] if kind == "text" else ""
        tags.append(Tag(_OPEN if kind == "open" else _CLOSE, name, rest) if name else _MARKS.get(kind, _MARKS["mark"]))
        begins.append(before)
        lengths.append(at - before)
    return [*texts, text], tags, lambda: (begins, lengths)


class Page:
    """Text of one page, and its elements as parallel lists in document order.

    ``opened``/``closed`` are places in the list of all tags: an element is open
    from its own tag up to the one that ends it, or to the end of the page.
    ``start``/``stop`` point into the text, ``begin``/``to`` into the source.
    """

    def __init__(self, source: str) -> None:
        pieces, self._all, self._places = _regular(source) or _any(source)
        self._pieces = self.texts = pieces
        if "&" in source:
            self.texts = [html.unescape(t) if "&" in t else t for t in pieces]
        self.text = "".join(self.texts)
        self._length = len(source)
        self.tags = [t for t in self._all if t.kind == _OPEN]
        # where nothing else is said, an element holds nothing
        self.end = list(range(len(self.tags)))
        self.opened: list[int] = []
        self.closed = [0] * len(self.tags)
        self.parent: list[int] = []
        self.depth: list[int] = []
        self._ids: list[int] = []  # open elements
        self._names: list[str] = []
        self._open: dict[str, int] = {}  # how many of each tag are open
        self._comments: list[int] = []
        self._read()
        self._close(0, len(self._all))

    @property
    def tag(self) -> list[str]:
        return [t.name for t in self.tags]

    @property
    def attrs(self) -> list[dict[str, str]]:
        return [t.attrs for t in self.tags]

    @property
    def start(self) -> list[int]:
        return list(map(self.sizes(len).__getitem__, self.opened))

    @property
    def stop(self) -> list[int]:
        return list(map(self.sizes(len).__getitem__, self.closed))

    @property
    def begin(self) -> list[int]:
        return [begin for begin, _ in self.spans(range(len(self.tags)))]

    @property
    def to(self) -> list[int]:
        return [to for _, to in self.spans(range(len(self.tags)))]

    def spans(self, chosen: Iterable[int]) -> Iterator[tuple[int, int]]:
        """Where elements begin and end in the source."""
        begins, lengths = self._places()
        for i in chosen:
            first, last = self.opened[i], self.closed[i]
            to = self._length
            if last < len(self._all):  # with its own end tag, or without the tag that implies its end
                by = self._all[last]
                own = first == last or (by.kind == _CLOSE and by.name == self.tags[i].name)
                to = begins[last] + (lengths[last] if own else 0)
            yield begins[first], to

    def sizes(self, size: Callable[[str], int]) -> list[int]:
        """For each tag and the end of the page, how much text comes before it."""
        return list(accumulate(map(size, self.texts)))

    def _close(self, level: int, k: int) -> None:
        """Close open elements down to ``level`` at tag ``k``."""
        last = len(self.opened) - 1
        while len(self._ids) > level:
            i = self._ids.pop()
            self._open[self._names.pop()] -= 1
            self.end[i], self.closed[i] = last, k

    def _level(self, tags: Sequence[str], barrier: Sequence[str] = ()) -> int:
        """Stack level of the innermost of ``tags``, not looking past ``barrier``; else -1."""
        names = self._names
        for i in range(len(names) - 1, -1, -1):
            if names[i] in tags:
                return i
            if names[i] in barrier:
                break
        return -1

    def _implied_ends(self, tag: Tag, k: int) -> None:
        if tag.ends_paragraph and self._open.get("p"):
            i = self._level(("p",), ("td", "th", "button", "object"))
            if i >= 0:
                self._close(i, k)
        if any(self._open.get(t) for t in tag.ends):
            i = self._level(tag.ends, tag.within)
            if i >= 0:
                self._close(i, k)

    def _read(self) -> None:
        ids, names, is_open = self._ids, self._names, self._open
        end, closed, parents, depths, opened = self.end, self.closed, self.parent, self.depth, self.opened
        number = 0
        for k, tag in enumerate(self._all):
            kind = tag.kind
            if kind == _CLOSE:
                name = tag.name
                if names and names[-1] == name:
                    names.pop()
                    is_open[name] -= 1
                    i = ids.pop()
                    end[i], closed[i] = number - 1, k
                elif is_open.get(name):
                    self._close(self._level((name,)), k)
            elif kind == _OPEN:
                name = tag.name
                if tag.ends_paragraph and is_open.get("p"):
                    self._implied_ends(tag, k)
                elif tag.ends and names:
                    inner = names[-1]
                    if inner in tag.ends:
                        names.pop()
                        is_open[inner] -= 1
                        i = ids.pop()
                        end[i], closed[i] = number - 1, k
                    elif inner not in tag.within:
                        self._implied_ends(tag, k)
                parents.append(ids[-1] if ids else -1)
                depths.append(len(ids))
                opened.append(k)
                if tag.alone:
                    closed[number] = k
                else:
                    ids.append(number)
                    names.append(name)
                    is_open[name] = is_open.get(name, 0) + 1
                number += 1
            elif kind == _COMMENT:
                self._comments.append(k)

    def single(self, chosen: Iterable[int] | None = None) -> list[bool]:
        """Whether an element holds one piece of text and nothing else, at any depth."""
        opened, closed, end, depth, comments = self.opened, self.closed, self.end, self.depth, self._comments
        pieces, before = self._pieces, None
        out = []
        for i in range(len(opened)) if chosen is None else chosen:
            first, stop, last = opened[i], closed[i], end[i]
            if stop <= first + 1:  # no tag in it
                out.append(stop > first and pieces[stop] != "")
                continue
            if depth[last] - depth[i] != last - i:  # what lies in it does not lie in each other
                out.append(False)
                continue
            before = before or list(accumulate(map(bool, pieces)))
            out.append(
                before[stop] - before[first] == 1
                and before[closed[last]] - before[opened[last]] == 1
                and not (comments and bisect_right(comments, first) < bisect_right(comments, stop))
            )
        return out


class _Answers(dict):
    """What is asked of a tag, answered once."""

    def __init__(self, ask: Callable[[Tag], bool]) -> None:
        self.ask = ask

    def __missing__(self, tag: Tag) -> bool:
        self[tag] = answer = self.ask(tag)
        return answer


class _Said(dict):
    """What the tags of a batch say, as columns, and the row of each tag in them."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.classes: list[list[str]] = []
        self.keys: list[str] = []
        self.texts: list[str] = []
        self.ends = [0]

    def __missing__(self, tag: Tag) -> int:
        self[tag] = row = len(self.names)
        self.names.append(tag.name)
        self.classes.append(tag.classes)
        self.keys.extend(tag.attrs)
        self.texts.extend(tag.attrs.values())
        self.ends.append(len(self.keys))
        return row

    def arrays(self) -> dict[str, pa.Array]:
        keys, values = pa.array(self.keys, pa.string()), pa.array(self.texts, pa.string())
        return {
            "tag": pa.array(self.names, pa.string()),
            "attrs": pa.MapArray.from_arrays(pa.array(self.ends, pa.int32()), keys, values),
            "classes": pa.array(self.classes, pa.list_(pa.string())),
        }


class NodeRows:
    """Column buffers of one output batch."""

    NUMBERS = ("id", "end", "parent", "depth", "start", "stop")

    def __init__(self) -> None:
        self.text: list[bytes | None] = []
        self.offsets = [0]
        self.numbers: dict[str, list[int]] = {f: [] for f in self.NUMBERS}
        self.single: list[bool] = []
        self.said = _Said()
        self.rows: list[int] = []  # of what is said, for each element
        self.outer: list[str | None] = []
        self.count = 0
        self._answers: dict[object, _Answers] = {}

    def _named(self, tags: Sequence[Tag], spec: frozenset[str]) -> list[bool]:
        """Which tags ``spec`` names, by tag or as ``.class``; a tag is asked once a batch."""
        if spec not in self._answers:
            self._answers[spec] = _Answers(lambda t: t.name in spec or any("." + c in spec for c in t.classes))
        return list(map(self._answers[spec].__getitem__, tags))

    def _children_of(self, page: Page, boxes: Sequence[tuple[str, str]], marked: list[bool]) -> None:
        """Mark the children of elements that carry one of some attribute values."""
        if boxes not in self._answers:
            self._answers[boxes] = _Answers(lambda t: any(t.attrs.get(k) == v for k, v in boxes))
        found = list(map(self._answers[boxes].__getitem__, page.tags))
        if True in found:
            for i, p in enumerate(page.parent):
                if p >= 0 and found[p]:
                    marked[i] = True

    def add(
        self,
        source: str | None,
        keep: frozenset[str] | None,
        outer: frozenset[str],
        with_text: bool,
        children_of: Sequence[tuple[str, str]] = (),
    ) -> None:
        if source is None:
            self.text.append(None)
            self.offsets.append(self.count)
            return
        page = Page(source)
        tags = page.tags
        self.text.append(page.text.encode() if with_text else None)
        marked = None if keep is None else self._named(tags, keep)
        if marked is not None and children_of:
            self._children_of(page, tuple(children_of), marked)
        chosen = range(len(tags)) if marked is None else list(compress(range(len(tags)), marked))
        if outer:
            named = list(compress(range(len(tags)), self._named(tags, outer)))
            shown = {i: source[begin:to] for i, (begin, to) in zip(named, page.spans(named))}
            self.outer.extend(map(shown.get, chosen))
        if chosen:
            self._add_elements(page, chosen, marked)
        self.count += len(chosen)
        self.offsets.append(self.count)

    def _add_elements(self, page: Page, chosen: Sequence[int], marked: Sequence[bool] | None) -> None:
        # places in the text count bytes
        sizes = page.sizes(len if page.text.isascii() else lambda t: len(t.encode()))
        ids, end, parent, depth, start, stop = (self.numbers[f] for f in self.NUMBERS)
        opened, closed, tags, depths = page.opened, page.closed, page.tags, page.depth
        # an element's number is its place among those that are emitted, so a subtree is a slice
        ids.extend(range(len(chosen)))
        if marked is None:
            end.extend(page.end)
            parent.extend(page.parent)
        else:
            number = list(accumulate(marked, initial=-1))[1:]
            end.extend([number[e] for e in compress(page.end, marked)])
            parent.extend([number[p] if p >= 0 and marked[p] else -1 for p in compress(page.parent, marked)])
            opened, closed, tags, depths = (compress(values, marked) for values in (opened, closed, tags, depths))
        depth.extend(depths)
        start.extend(map(sizes.__getitem__, opened))
        stop.extend(map(sizes.__getitem__, closed))
        self.single.extend(page.single(chosen))
        self.rows.extend(map(self.said.__getitem__, tags))

    def arrays(self) -> tuple[pa.Array, pa.Array]:
        rows = pa.array(self.rows, pa.int32())
        built = {f: pa.array(column, pa.int32()) for f, column in self.numbers.items()}
        built |= {f: said.take(rows) for f, said in self.said.arrays().items()}
        built["single"] = pa.array(self.single, pa.bool_())
        built["outer"] = pa.array(self.outer, pa.string()) if self.outer else pa.nulls(self.count, pa.string())
        order = ("id", "end", "parent", "depth", "tag", "attrs", "classes", "start", "stop", "single", "outer")
        nodes = pa.StructArray.from_arrays([built[f] for f in order], names=list(order))
        return (
            pa.array(self.text, pa.binary()),
            pa.ListArray.from_arrays(pa.array(self.offsets, pa.int32()), nodes),
        )
