"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The best segmentation of a text is the one whose pieces have the highest sum of
scores. The search walks the text once and holds, for each boundary in a window
of the longest piece's length, the best score and the piece that reaches it. As
soon as all surviving backward paths meet in one boundary, everything before it
is settled: its ids are committed and the window moves on. Memory per text is
thus bounded by the window, not by the text.

A space can only begin a piece (or be part of a run of spaces), so every path
meets at the boundary before a run of spaces. The stretch between two such
boundaries has the same ids wherever it occurs; a task remembers them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.bpe_counts import SPACE, pre_tokens
from larder.llm.common import fresh, without


NEVER = float("-inf")
UNKNOWN = (-1, 0.0)


class Recent:
    """A dict that forgets what was not asked for lately: two halves, the older dropped when the newer is full."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get_all(self, keys: list[str]) -> list[list[int] | None]:
        """What is known of each key. Those found in the older half move to the newer one."""
        found, old = list(map(self.new.get, keys)), self.old.get
        for k, ids in enumerate(found):
            if ids is None and (ids := old(keys[k])) is not None:
                found[k] = self.new[keys[k]] = ids
        return found

    def put_all(self, keys: list[str], values: list[list[int]]) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new.update(zip(keys, values, strict=True))


class PieceLattice:
    """Pieces with scores; finds best segmentations and joins pieces again."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(size)]
        self.shown = [p.replace(SPACE, " ") for p in self.names]
        self.byte_id = {int(p[1:-1], 16): i for i, p in enumerate(self.names) if sp.is_byte(i)}
        for b, i in self.byte_id.items():
            if b < 0x80:
                self.shown[i] = chr(b)
        self.byte_of = {i: bytes([b]) for b, i in self.byte_id.items() if b >= 0x80}  # these take several for a character
        self.many = np.zeros(size, bool)
        self.many[list(self.byte_of)] = True
        self.pieces = {p: (i, sp.get_score(i)) for i, p in enumerate(self.names)
                       if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.tree: dict = {}  # characters lead on; "" holds the piece that ends here
        for p, found in self.pieces.items():
            node = self.tree
            for c in p:
                node = node.setdefault(c, {})
            node[""] = found
        self._tables()
        self.longest = max(map(len, self.pieces))
        self.unknown_id = sp.unk_id()
        # a character of no piece costs more than any piece, and becomes its bytes
        self.unknown_score = min(s for _, s in self.pieces.values()) - 10.0
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("pieces that cross words: paths need not meet at spaces")

    def _ids(self, piece_id: int, char: str) -> list[int]:
        if piece_id >= 0:
            return [piece_id]
        return [self.byte_id[b] for b in char.encode()] if self.byte_id else [self.unknown_id]

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of ``text`` in committed stretches. Of equal scores the longer last piece wins."""
        tree, unknown, n = self.tree, self.unknown_score, len(text)
        base = reach = 0  # all before `base` is committed; `reach` is the furthest end of a piece begun so far
        best, back, via = [0.0], [0], [-1]  # by boundary - base: score, where its last piece begins, that piece
        next_look = self.longest * 4
        for i in range(n):
            score, node, end = best[i - base], tree, i
            while end < n and (node := node.get(text[end])) is not None:
                end += 1
                if (piece := node.get("")) is not None:
                    total = score + piece[1]
                elif end == i + 1:
                    total = score + unknown
                    piece = UNKNOWN
                else:
                    continue
                k = end - base
                if k < len(best):
                    if total > best[k]:
                        best[k], back[k], via[k] = total, i, piece[0]
                    continue
                while k > len(best):
                    best.append(NEVER), back.append(-1), via.append(-1)
                best.append(total), back.append(i), via.append(piece[0])
            if end == i:  # a character that begins no piece
                k = i + 1 - base
                if k == len(best):
                    best.append(NEVER), back.append(-1), via.append(-1)
                if score + unknown > best[k]:
                    best[k], back[k], via[k] = score + unknown, i, -1
            reach = base + len(best) - 1
            if reach == i + 1:
                meet = reach
            elif i - base >= next_look:
                meet = self._meeting(range(i + 1, reach + 1), back, base)
                next_look = (0 if meet > base else i - base) + self.longest * 4
            else:
                continue
            if meet > base:
                yield self._path(text, meet, base, back, via)
                del best[:meet - base], back[:meet - base], via[:meet - base]
                best = [s - best[0] for s in best]  # keeps sums small; differences alone matter
                base = meet

    def _meeting(self, ends: range, back: list[int], base: int) -> int:
        """The last boundary that the paths to all of ``ends`` share."""
        live = {e for e in ends if back[e - base] >= 0}
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(back[last - base] if last > base else base)
        return live.pop() if live else base

    def _path(self, text: str, end: int, base: int, back: list[int], via: list[int]) -> list[int]:
        steps = []
        while end > base:
            start = back[end - base]
            steps.append(self._ids(via[end - base], text[start:end]))
            end = start
        return [i for ids in reversed(steps) for i in ids]

    def _tables(self) -> None:
        """The tree of pieces as arrays: numbered nodes, sorted (node, character) keys, the piece of a node."""
        keys, nodes, self.piece_at, self.score_at, queue = [], [], [], [], [self.tree]
        for number, node in enumerate(queue):
            found = node.get("", (-1, NEVER))
            self.piece_at.append(found[0]), self.score_at.append(found[1])
            for c, below in node.items():
                if c:
                    keys.append((number << 21) + ord(c)), nodes.append(len(queue))
                    queue.append(below)
        order = np.argsort(keys)
        self.step_key, self.step_to = np.array(keys)[order], np.array(nodes)[order]
        self.piece_at, self.score_at = np.array(self.piece_at), np.array(self.score_at)
        self.first_step = np.full(0x110000, -1, np.int64)
        top = self.step_key < 1 << 21
        self.first_step[self.step_key[top]] = self.step_to[top]

    def together(self, words: list[str]) -> list[list[int]]:
        """Ids of many short stretches: the same search, one boundary of all of them after the other."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        char = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        at = (np.arange(len(char)) - starts[word]).astype(np.int32)
        left = (sizes[word] - at).astype(np.int32)
        # all pieces at all places, by walking the tree from every character at once
        live, node, found = np.arange(len(char), dtype=np.int32), self.first_step[char], []
        whole = np.zeros(len(char), bool)
        for length in range(1, self.longest + 1):
            known = node >= 0
            live, node = live[known], node[known]
            hit = self.piece_at[node] >= 0
            found.append((live[hit], np.full(hit.sum(), length, np.int32), self.piece_at[node[hit]], self.score_at[node[hit]]))
            if length == 1:
                whole[live[hit]] = True
            inside = left[live] > length
            live, node = live[inside], node[inside]
            if not len(live):
                break
            key = (node << 21) + char[live + length]
            k = np.minimum(np.searchsorted(self.step_key, key), len(self.step_key) - 1)
            node = np.where(self.step_key[k] == key, self.step_to[k], -1)
        bare = np.flatnonzero(~whole)
        found.append((bare, np.ones(len(bare), np.int32), -3 - char[bare], np.full(len(bare), self.unknown_score)))
        begin, length, piece, score = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(at[begin].astype(np.uint16), kind="stable")  # sorted by radix
        begin, length, piece, score = (x[order] for x in (begin, length, piece, score))
        place = at[begin]
        # a row of boundaries for each word, end to end
        first = starts + np.arange(len(words))
        begins = begin + word[begin]
        longest = int(sizes.max()) + 1
        best = np.full(len(char) + len(words), NEVER)
        best[first] = 0.0
        back, via = np.zeros((2, len(best)), np.int32)
        cut = np.searchsorted(place, np.arange(longest + 1))
        for i in range(longest):
            one = slice(cut[i], cut[i + 1])
            cell = begins[one] + length[one]  # a boundary gets one piece at most from each beginning
            total = best[begins[one]] + score[one]
            better = total > best[cell]
            cell = cell[better]
            best[cell], back[cell], via[cell] = total[better], i, piece[one][better]
        end, steps = sizes.copy(), []
        while end.any():
            steps.append(np.where(end > 0, via[first + end], -2))
            end = np.where(end > 0, back[first + end], 0)
        path = np.array(steps[::-1]).T
        kept = path != -2
        unknown = (path < -2).any(axis=1).tolist()  # -3 - a character that is no piece
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        flat = path[kept].tolist()
        return [[i for x in flat[a:b] for i in self._ids(x, chr(max(-3 - x, 0)))] if u else flat[a:b]
                for a, b, u in zip([0, *ends], ends, unknown, strict=False)]

    def encode(self, texts: list[str], known: Recent) -> list[list[int]]:
        return [ids.tolist() for ids in self.encode_arrays(texts, known)]

    def encode_arrays(self, texts: list[str], known: Recent, short: int = 40, at_once: int = 10_000) -> list[np.ndarray]:
        """Ids of each text. Stretches up to ``short`` characters that are new go ``together``, others ``stream``."""
        cut = [pre_tokens(t) for t in texts]
        held = np.fromiter(map(len, cut), np.int64, len(cut))
        number: dict[str, int] = defaultdict(count().__next__)  # distinct stretches in the order they come
        code = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64, int(held.sum()))
        del cut
        words = list(number)
        found = known.get_all(words)
        new = [k for k, ids in enumerate(found) if ids is None]
        brief = [k for k in new if len(words[k]) <= short]
        for k in new:
            if len(words[k]) > short:
                found[k] = [i for part in self.stream(words[k]) for i in part]
        for n in range(0, len(brief), at_once):
            some = brief[n:n + at_once]
            for k, ids in zip(some, self.together([words[k] for k in some]), strict=True):
                found[k] = ids
        known.put_all([words[k] for k in new], [found[k] for k in new])
        # the ids of distinct stretches once, end to end; each text then gathers its own
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(size.sum()))
        start = np.cumsum(size) - size
        size = size[code]
        end = np.r_[0, np.cumsum(size)]
        ids = flat[np.repeat(start[code] - end[:-1], size) + np.arange(end[-1])]
        return np.split(ids, end[np.cumsum(held)][:-1]) if texts else []

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``: pieces joined, bytes decoded, spaces restored, the added first space dropped."""
        if not self.many[ids].any():
            return "".join(map(self.shown.__getitem__, ids.tolist())).removeprefix(" ")
        ids = ids.tolist()
        names, text, raw = self.shown, [], b""
        for i in ids:
            if i in self.byte_of:
                raw += self.byte_of[i]
                continue
            if raw:
                text.append(raw.decode("utf-8", "replace"))
                raw = b""
            text.append(names[i])
        if raw:
            text.append(raw.decode("utf-8", "replace"))
        return "".join(text).removeprefix(" ")


def encode(docs: DataFrame, model_path: str, text: str = "text", out: str = "ids", exact: str | None = None,
           words_kept: int = 120_000, chars_at_once: int = 300_000) -> DataFrame:
    """``docs`` with the piece ids of each whole text in ``out`` (array of int).

    A null or empty text has no ids. With ``exact`` a boolean column of that name
    tells whether decoding the ids gives the text back. Columns of these names
    are replaced. The ids are those of the library's best-score search over the
    same pieces and scores. One narrow map without a shuffle; texts go through
    it ``chars_at_once`` at a time (or one long text alone).
    """
    with open(model_path, "rb") as f:
        model = f.read()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lattice, known = PieceLattice(model), Recent(words_kept)
        for batch in batches:
            group: list[str] = []
            held = 0
            for k, t in enumerate(batch, 1):
                group.append(t or "")
                held += len(group[-1])
                if held >= chars_at_once or k == len(batch):
                    ids = lattice.encode_arrays(group, known)
                    same = [lattice.decode(i) == t.replace(SPACE, " ") for i, t in zip(ids, group, strict=True)] if exact else True
                    yield pd.DataFrame({"ids": ids, "exact": same})
                    group, held = [], 0

    coded = F.pandas_udf(run, "struct<ids:array<int>,exact:boolean>")(F.col(text))
    names = [out, *([exact] if exact else [])]
    keep = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    name = fresh(docs, "_coded")
    done = docs.withColumn(name, coded)
    return done.select(*[F.col(f"`{c}`") for c in keep], F.col(f"{name}.ids").alias(out),
                       *([F.col(f"{name}.exact").alias(exact)] if exact else []))


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of the ids in ``out``; null ids give an empty text.

    The exact text comes back, but for "\\u2581", the file's own mark for a
    space, which comes back as a space.
    """
    with open(model_path, "rb") as f:
        model = f.read()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lattice = PieceLattice(model)
        for batch in batches:
            yield pd.Series([lattice.decode(np.array(x if x is not None else [], np.int32)) for x in batch], dtype=object)

    return without(encoded, [out]).withColumn(out, F.pandas_udf(run, "string")(F.col(ids)))
