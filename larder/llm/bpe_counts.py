"""Token counts by rank-synchronous array merging.

The merge model of a SentencePiece file joins, in a sequence of symbols, the two
neighbours whose concatenation is the piece of best score, the leftmost first.
Here many short sequences (pre-tokens) lie end to end in one numpy array. Each
round finds every sequence's lowest rank and applies that pair in all sequences
at once; sequences without a pair leave the array, and their surviving symbols
are their token count.

No piece of such a model holds a space after another character, so a text can be
cut before each run of spaces, and each distinct pre-token of a task is merged
only once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import without

SPACE = "▁"
NO_RANK = np.int64(1 << 40)


class MergeTable:
    """Pieces, ranks and mergeable pairs of a SentencePiece file, as arrays."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        normal = [i for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i): sp.get_score(i) for i in normal}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces that cross words: texts cannot be cut at spaces")
        ranks = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        # symbols: all pieces, then characters that occur in pieces only, then
        # one symbol for each byte length of a character no piece holds
        symbols = [*pieces, *sorted({c for p in pieces for c in p} - pieces.keys())]
        number = {p: i for i, p in enumerate(symbols)}
        self.base = len(symbols) + 5
        self.cost = np.ones(self.base, np.int64)
        self.char = np.empty(0x110000, np.int32)
        for low, high, n_bytes in ((0, 0x80, 1), (0x80, 0x800, 2), (0x800, 0x10000, 3), (0x10000, 0x110000, 4)):
            self.char[low:high] = len(symbols) + n_bytes
            self.cost[len(symbols) + n_bytes] = n_bytes
        for p, i in number.items():
            if len(p) == 1:
                self.char[ord(p)] = i
            if p not in pieces:
                self.cost[i] = len(p.encode())
        pairs = sorted(
            (number[p[:k]] * self.base + number[p[k:]], ranks[score], number[p])
            for p, score in pieces.items() for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        self.key, self.rank, self.made = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        # A merge is safe to apply to all its places at once unless the piece it
        # makes can at once join on into a piece of no worse rank.
        rank_of = np.full(self.base, -1, np.int64)
        rank_of[[number[p] for p in pieces]] = [ranks[s] for s in pieces.values()]
        self.single = np.zeros(len(ranks), bool)
        for part in (self.key // self.base, self.key % self.base):
            early = (rank_of[part] >= 0) & (self.rank <= rank_of[part])
            self.single[rank_of[part[early]]] = True

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return np.where(hit, self.rank[at], NO_RANK), self.made[at].astype(np.int32)

    def counts(self, tokens: list[str]) -> np.ndarray:
        """Symbols left in each of ``tokens`` (none empty) when no pair is left."""
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        sym = self.char[np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32)]
        seq = np.repeat(np.arange(len(tokens)), sizes)
        total = np.zeros(len(tokens), np.int64)

        def pairs(at: np.ndarray) -> None:
            """Rank and result of the pairs that begin at these places."""
            at = at[(at >= 0) & (at < len(sym) - 1)]
            at = at[seq[at] == seq[at + 1]]
            rank[at], made[at] = self.look_up(sym[at], sym[at + 1])

        rank, made = np.full(len(sym), NO_RANK), np.zeros(len(sym), np.int32)
        pairs(np.arange(len(sym)))
        while len(sym):
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            best = np.minimum.reduceat(rank, first)
            group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(sym)]))
            done = best == NO_RANK
            if done.any():
                gone = done[group]
                np.add.at(total, seq[gone], self.cost[sym[gone]])
                sym, seq, rank, made = (x[~gone] for x in (sym, seq, rank, made))
                continue
            at = np.flatnonzero(rank == best[group])
            # of places that overlap, every second from the left; of a merge that
            # is not safe, the leftmost of its sequence
            run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            leftmost = np.r_[True, seq[at[1:]] != seq[at[:-1]]]
            at = at[np.where(self.single[rank[at]], leftmost, place % 2 == 0)]
            sym[at] = made[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            moved = at - np.arange(len(at))  # the merged symbols' places after the cut
            sym, seq, rank, made = (x[stay] for x in (sym, seq, rank, made))
            rank[moved] = NO_RANK
            pairs(np.concatenate([moved - 1, moved]))
        return total


def pre_tokens(text: str) -> list[str]:
    """The text as the model reads it, a space put first, cut before each run of spaces."""
    return re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE)) if text else []


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", out: str = "n_tokens",
                 chars_at_once: int = 1_000_000, words_kept: int = 300_000) -> DataFrame:
    """``docs`` with the token count of each whole text in ``out``.

    Counts are those of the library for the same file, without added tokens; a
    null or empty text has 0. A column named like ``out`` is replaced; all other
    columns stay. One narrow map: nothing is shuffled, and a task holds one
    batch, ``words_kept`` remembered pre-tokens, and arrays for
    ``chars_at_once`` characters or for its longest pre-token.
    """
    with open(model_path, "rb") as f:
        model = f.read()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, known = MergeTable(model), {}

        def learn(words: list[str]) -> None:
            start = held = 0
            for i, w in enumerate(words, 1):
                held += len(w)
                if held >= chars_at_once or i == len(words):
                    known.update(zip(words[start:i], table.counts(words[start:i]).tolist(), strict=True))
                    start, held = i, 0

        def flush(group: list[list[str]]) -> list[int]:
            if len(known) > words_kept:
                known.clear()
            learn(list({w for words in group for w in words if w not in known}))
            return [sum(map(known.__getitem__, words)) for words in group]

        for batch in batches:
            counts, group, held = [], [], 0
            for t in batch:
                group.append(pre_tokens(t or ""))
                held += len(t or "")
                if held >= chars_at_once:
                    counts += flush(group)
                    group, held = [], 0
            yield pd.Series(counts + flush(group), dtype="int64")

    return without(docs, [out]).withColumn(out, F.pandas_udf(run, "long")(F.col(text)))
