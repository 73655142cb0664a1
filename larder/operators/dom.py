"""HTML to nodes, and element selection over them.

Spark ships no HTML parser, so one map over Arrow batches turns each page into
its text plus an array of element records. Everything after it is a column
expression over that array: a page never leaves its row, and extraction needs
no shuffle.

A node is identified by its place ``id`` in the array, in page order; its
descendants are ``id + 1 .. end``, so a subtree is a slice of the array, and a
selection looks at each node below a match once. Text is not repeated along the
tree: ``start`` and ``stop`` are byte places in the text of the page, which is
kept as bytes, so that a piece is cut out without counting characters from the
start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.text import let, stripped_text
from larder.operators.markup import NodeRows

NODE_TYPE = (
    "struct<id:int,end:int,parent:int,depth:int,tag:string,attrs:map<string,string>,"
    "classes:array<string>,start:int,stop:int,single:boolean,outer:string>"
)


def parse_pages(
    pages: DataFrame,
    html_col: str = "html",
    keys: Sequence[str] | None = None,
    keep: Sequence[str] | None = None,
    outer: Sequence[str] = (),
    with_text: bool = True,
    children_of: Sequence[tuple[str, str]] = (),
    nodes_per_batch: int = 50_000,
) -> DataFrame:
    """Add ``text`` and ``nodes`` to ``keys``; the page source is left behind unless it is a key.

    ``keep`` (tags, or classes as ``.name``) limits the elements that are
    emitted, with the children of elements that carry an attribute value of
    ``children_of``; ``outer`` names those that carry their own source. Output batches are cut
    by element count, so a run of large pages does not pile up.
    """
    keys = [c for c in pages.columns if c != html_col] if keys is None else list(keys)
    kept = None if keep is None else frozenset(keep)
    outer_of = frozenset(outer)
    boxes = tuple(children_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, acc = 0, NodeRows()
            for row, source in enumerate(batch.column(html_col).to_pylist(), 1):
                acc.add(source, kept, outer_of, with_text, boxes)
                if acc.count >= nodes_per_batch or row == batch.num_rows:
                    part = batch.slice(done, row - done)
                    text, nodes = acc.arrays()
                    yield pa.RecordBatch.from_arrays(
                        [part.column(k) for k in keys] + [text, nodes], [*keys, "text", "nodes"]
                    )
                    done, acc = row, NodeRows()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keys).schema.fields)
    schema = f"{schema + ', ' if keys else ''}text binary, nodes array<{NODE_TYPE}>"
    return pages.select(*keys, *([] if html_col in keys else [html_col])).mapInArrow(run, schema)


def html_nodes(dom: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The node table: one row per element, with its text."""
    def rows(text: Column) -> Column:
        return F.transform("nodes", lambda n: F.struct(n.alias("n"), node_text(n, text).alias("text")))

    flat = dom.select(*keys, F.inline(with_text("text", rows)))
    return flat.select(
        *keys,
        F.col("n.id").alias("node_id"),
        F.col("n.end").alias("end_id"),
        F.col("n.parent").alias("parent_id"),
        F.col("n.depth").alias("depth"),
        F.col("n.tag").alias("tag"),
        F.col("n.attrs").alias("attrs"),
        "text",
        F.when(F.col("n.single"), F.col("text")).alias("string"),
        F.col("n.outer").alias("html"),
    )


# --- selection -------------------------------------------------------------


@dataclass(frozen=True)
class Sel:
    """One step of a selector: tag, class, id, exact attribute, and text pattern."""

    tag: str | None = None
    cls: str | None = None
    id: str | None = None
    attr: tuple[str, str] | None = None
    text: str | None = None

    def test(self, node: Column, text: Column) -> Column:
        parts: list[Column] = []
        if self.tag:
            parts.append(node["tag"] == self.tag)
        if self.cls:
            parts.append(F.array_contains(node["classes"], self.cls))
        if self.id:
            parts.append(F.coalesce(F.element_at(node["attrs"], "id") == self.id, F.lit(False)))
        if self.attr:
            parts.append(F.coalesce(F.element_at(node["attrs"], self.attr[0]) == self.attr[1], F.lit(False)))
        if self.text:
            parts.append(node["single"] & node_text(node, text).rlike(self.text))
        out = F.lit(True) if not parts else parts[0]
        for p in parts[1:]:
            out = out & p
        return out


STEP_TYPE = "struct<tag:string,cls:string,id:string,attr:string,value:string,text:string>"


@dataclass(frozen=True)
class StepColumn:
    """One step of a selector that stands in a column of :data:`STEP_TYPE`; a null part asks for nothing."""

    step: Column

    def test(self, node: Column, text: Column) -> Column:
        def asked(part: str, holds: Column) -> Column:
            return self.step[part].isNull() | F.coalesce(holds, F.lit(False))

        return (
            asked("tag", node["tag"] == self.step["tag"])
            & asked("cls", F.array_contains(node["classes"], self.step["cls"]))
            & asked("id", F.element_at(node["attrs"], "id") == self.step["id"])
            & asked("attr", F.try_element_at(node["attrs"], self.step["attr"]) == self.step["value"])
            & asked("text", node["single"] & F.regexp_like(node_text(node, text), self.step["text"]))
        )


def with_text(text: Column | str, use: Callable[[Column], Column]) -> Column:
    """``use`` of a page's text, read from its row once: each reading copies it."""
    return let(F.col(text) if isinstance(text, str) else text, use)


def node_text(node: Column, text: Column) -> Column:
    """Text of a node, its descendants included; ``text`` should be bound by :func:`with_text`."""
    return F.substring(text, node["start"] + 1, node["stop"] - node["start"]).cast("string")


def texts_of(found: Column, text: Column) -> Column:
    """The stripped texts of some nodes."""
    return with_text(text, lambda t: F.transform(found, lambda n: stripped_text(node_text(n, t))))


def below(nodes: Column, ancestor: Column) -> Column:
    """The descendants of a node."""
    return F.slice(nodes, ancestor["id"] + 2, ancestor["end"] - ancestor["id"])


def ids_below(nodes: Column, found: Column, step: Sel | StepColumn, text: Column) -> Column:
    """Numbers of the nodes that match ``step`` below those of ``found``, in page order."""
    def inner(match: Column) -> Column:
        return F.transform(F.filter(below(nodes, match), lambda n: step.test(n, text)), lambda n: n["id"])

    # matches may lie in each other: what both hold counts once
    return F.array_distinct(F.flatten(F.transform(found, inner)))


def nodes_at(nodes: Column, ids: Column) -> Column:
    return F.transform(ids, lambda i: F.get(nodes, i))


def select_by(nodes: Column, text: Column, steps: Column) -> Column:
    """As :func:`select_all`, with the path in a column, an array of steps; no step, no match."""
    def run(t: Column) -> Column:
        first = F.filter(nodes, lambda n: StepColumn(F.get(steps, F.lit(0))).test(n, t))
        start = F.when(F.size(steps) > 0, F.transform(first, lambda n: n["id"])).otherwise(F.array().cast("array<int>"))
        rest = F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0)))
        ids = F.aggregate(rest, start, lambda ids, step: ids_below(nodes, nodes_at(nodes, ids), StepColumn(step), t))
        return nodes_at(nodes, ids)

    return with_text(text, run)


def select_all(nodes: Column, text: Column, *path: Sel | StepColumn | Column) -> Column:
    """Nodes matching the last step below the earlier ones, in document order.

    A path is steps, or one column with an array of them.
    """
    if len(path) == 1 and isinstance(path[0], Column):
        return select_by(nodes, text, path[0])

    def step(found: Column, rest: Sequence[Sel], t: Column) -> Column:
        if not rest:
            return found

        return step(nodes_at(nodes, ids_below(nodes, found, rest[0], t)), rest[1:], t)

    def run(t: Column) -> Column:
        return step(F.filter(nodes, lambda n: path[0].test(n, t)), path[1:], t)

    return with_text(text, run) if any(isinstance(s, StepColumn) or s.text for s in path) else run(text)


def select_first(nodes: Column, text: Column, *path: Sel) -> Column:
    """First match, or NULL."""
    return F.get(select_all(nodes, text, *path), F.lit(0))


def first_text(nodes: Column, text: Column, *path: Sel) -> Column:
    """Stripped text of the first match; NULL without one."""
    return let(select_first(nodes, text, *path), lambda n: with_text(text, lambda t: stripped_text(node_text(n, t))))


Predicate = Callable[[Column, Column], Column]


def has_element(*path: Sel) -> Predicate:
    """A page predicate for classification: does any element match?"""
    return lambda nodes, text: F.size(select_all(nodes, text, *path)) > 0
