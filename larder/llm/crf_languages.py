"""Language of text by a linear-chain conditional random field over words.

Every word has features (affixes, character n-grams, its entry in a lexicon) with
a weight for each language; neighbours are tied by transition weights. All
weights are learned together, by gradient ascent on the likelihood of word
labels, from stretches of known language strung together so that languages
switch. Forward-backward then gives every word of a text its label
probabilities; the language of a text is the one with the highest mean.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import fresh, unit_hash

LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters; anything else, superscripts too, ends a word."""
    out: list[str] = []
    for w in LETTERS.findall(text.lower()) if text else ():
        out += [w] if w.isalpha() else "".join([c if c.isalpha() else " " for c in w]).split()
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) pairs of many words; a feature is a 64-bit hash.

    Features are prefixes and suffixes up to four letters, bigrams and trigrams
    with the word's edges, and the word itself as its lexicon entry.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(sizes + 2) - sizes - 2  # where each edged word begins
    c = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), sizes + 2)
    left = np.arange(len(c)) - begin[word]
    right = sizes[word] + 1 - left
    rows, cols = [], []
    chain = np.full(len(c), 7, np.uint64)
    for n in range(1, 5):  # chain: hash of the n characters from each place on
        chain = mixed(chain[:len(c) - n + 1] + c[n - 1:])
        place = np.arange(len(chain))
        for kind, has in ((1, (left[place] == 1) & (right[place] >= n)), (2, (right[place] == n) & (left[place] >= 1)),
                          (3, (right[place] >= n - 1) if n in (2, 3) else None)):
            if has is not None:
                rows.append(word[:len(chain)][has])
                cols.append(mixed(chain[has] + np.uint64(kind)))
    power = mixed(left.astype(np.uint64) + np.uint64(99)) | np.uint64(1)
    rows.append(np.arange(len(words)))
    cols.append(mixed(np.add.reduceat(c * power, begin) + np.uint64(4)) if len(words) else np.empty(0, np.uint64))
    return np.concatenate(rows), np.concatenate(cols)


def forward_backward(emit: Sequence[np.ndarray], start: np.ndarray, move: np.ndarray,
                     pairs: np.ndarray | None = None) -> list[np.ndarray]:
    """Label probabilities of every word; ``emit``: scores (words, labels) of each text, ``move``: transition scores.

    To ``pairs``, if given, the expected numbers of neighbouring labels are added. All texts advance together, a word at a time; shorter ones rest when done.
    """
    order = sorted(range(len(emit)), key=lambda i: -len(emit[i]))
    sizes = np.array([len(emit[i]) for i in order])
    longest = int(sizes[0]) if len(sizes) else 0
    live = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")  # texts with a word at this place
    offset = np.r_[0, np.cumsum(live)]
    flat = np.empty((offset[-1], len(start)))
    place = [offset[np.arange(n)] + r for r, n in enumerate(sizes)]
    for r, i in enumerate(order):
        flat[place[r]] = emit[i]
    flat = np.exp(flat - flat.max(axis=1, keepdims=True))
    step = np.exp(move)
    alpha = np.empty_like(flat)
    for t in range(longest):
        now = slice(offset[t], offset[t + 1])
        a = flat[now] * (np.exp(start) if t == 0 else alpha[offset[t - 1]:offset[t - 1] + live[t]] @ step)
        alpha[now] = a / a.sum(axis=1, keepdims=True)
    beta = np.ones((live[0] if longest else 0, len(start)))
    for t in range(longest - 1, -1, -1):
        n = live[t]
        if t < longest - 1 and live[t + 1]:
            k = live[t + 1]
            after = flat[offset[t + 1]:offset[t + 2]] * beta[:k]
            if pairs is not None:
                both = alpha[offset[t]:offset[t] + k, :, None] * step * after[:, None]
                pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = after @ step.T
            beta[:k] = b / b.sum(axis=1, keepdims=True)
        now = slice(offset[t], offset[t + 1])
        p = alpha[now] * beta[:n]
        alpha[now] = p / p.sum(axis=1, keepdims=True)
    out: list[np.ndarray] = [np.empty((0, len(start)))] * len(emit)
    for r, i in enumerate(order):
        out[i] = alpha[place[r]]
    return out


class LanguageField:
    """The learned field. ``fit`` takes (words, language) pairs."""

    def __init__(self, labels: list[str]):
        self.labels = labels
        self.start, self.move = np.zeros(len(labels)), np.zeros((len(labels), len(labels)))
        self.known = np.zeros(0, np.uint64)  # sorted features, one row of weights each
        self.weight = np.zeros((0, len(labels)))

    @classmethod
    def fit(cls, samples: Sequence[tuple[list[str], str]], rounds: int = 40, stretch: int = 40, sequence: int = 200,
            rate: float = 0.3, shrink: float = 1e-5, seed: int = 5) -> LanguageField:
        self = cls(sorted({lang for _, lang in samples}))
        k = len(self.labels)
        rng = np.random.default_rng(seed)
        runs = []  # stretches of one language, about `stretch` words long
        for words, lang in samples:
            at = 0
            while at < len(words):
                n = int(rng.integers(stretch // 2, stretch * 2))
                runs.append((words[at:at + n], self.labels.index(lang)))
                at += n
        words, labels = [], []
        for i in rng.permutation(len(runs)):
            words += runs[i][0]
            labels += [runs[i][1]] * len(runs[i][0])
        if not words:
            return self
        seen = Counter(words)
        entry = {w: i for i, w in enumerate(seen)}
        row, found = features(list(seen))
        every, col = np.unique(found, return_inverse=True)
        times = np.bincount(col, weights=np.fromiter(seen.values(), float, len(seen))[row])
        self.known = every[times >= 3]
        row, col = self.look_up(row, found)
        x = np.array([entry[w] for w in words])
        y = np.array(labels)
        spans = [slice(a, min(a + sequence, len(x))) for a in range(0, len(x), sequence)]

        theta = [np.zeros((len(self.known), k)), np.zeros(k), np.zeros((k, k))]
        first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
        gold_move, gold_start = np.zeros((k, k)), np.zeros(k)
        for s in spans:
            np.add.at(gold_move, (y[s][:-1], y[s][1:]), 1)
            gold_start[y[s][0]] += 1
        gold = np.zeros((len(entry), k))
        np.add.at(gold, (x, y), 1)
        for it in range(1, rounds + 1):
            score = np.stack([np.bincount(row, weights=theta[0][col, j], minlength=len(entry)) for j in range(k)], axis=1)
            emit = [score[x[s]] for s in spans]
            moves = np.zeros((k, k))
            p = forward_backward(emit, theta[1], theta[2], moves)
            expect = np.zeros((len(entry), k))
            flat = np.concatenate(p)
            for j in range(k):
                expect[:, j] = np.bincount(x, weights=flat[:, j], minlength=len(entry))
            diff = gold - expect
            grad_w = np.stack([np.bincount(col, weights=diff[row, j], minlength=len(self.known)) for j in range(k)], axis=1)
            grads = [grad_w / len(x) - shrink * theta[0], (gold_start - sum(q[0] for q in p)) / len(spans),
                     (gold_move - moves) / len(x) - shrink * theta[2]]
            for t, g, a, b in zip(theta, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                t += rate * (a / (1 - 0.9**it)) / (np.sqrt(b / (1 - 0.999**it)) + 1e-8)
        self.weight, self.start, self.move = theta
        return self

    def look_up(self, row: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of (word, feature) pairs those with a weight, and its row."""
        at = np.minimum(np.searchsorted(self.known, found), max(len(self.known) - 1, 0))
        hit = self.known[at] == found if len(self.known) else np.zeros(len(found), bool)
        return row[hit], at[hit]

    def scores(self, words: Sequence[str]) -> np.ndarray:
        """Label scores of each word: the weights of its features, summed."""
        row, col = self.look_up(*features(words))
        return np.stack([np.bincount(row, weights=self.weight[col, j], minlength=len(words)) for j in range(len(self.labels))], axis=1)

    def read(self, texts: Sequence[str], memory: Memory) -> list[np.ndarray]:
        """Label probabilities of the words of each text."""
        cut = [words_of(t) for t in texts]
        known = memory.known
        new = list({w for words in cut for w in words if w not in known})
        for k in range(0, len(new), 20_000):
            memory.add(new[k:k + 20_000], self.scores(new[k:k + 20_000]))
        return forward_backward([memory.table[[known[w] for w in words]] for words in cut], self.start, self.move)


class Memory:
    """Scores of the words met so far."""

    def __init__(self, labels: int):
        self.known: dict[str, int] = {}
        self.table = np.zeros((1024, labels))

    def add(self, words: list[str], scores: np.ndarray) -> None:
        n = len(self.known)
        while n + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[n:n + len(words)] = scores
        self.known.update(zip(words, range(n, n + len(words)), strict=True))


def held_out(key: Column) -> Column:
    """Whether a row is not learned from: crc32 of its key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows_per_language: int = 250,
          most_chars: int = 20_000, sample_chars: int = 40_000_000) -> LanguageField:
    """A field learned from labelled rows that are not held out, with every label they have.

    The sample is bounded: ``rows_per_language`` rows of each language by the
    hash of their key, and of each row a stretch of ``most_chars`` that begins
    where that hash falls; with very many languages the stretches are shorter,
    so that all together hold no more than ``sample_chars``.
    """
    usable = docs.where(~held_out(F.col(key)) & F.col(lang).isNotNull() & (F.length(text) > 0))
    counts = usable.groupBy(lang).count().collect()  # a row a label, as the model itself has
    stretch = max(200, min(most_chars, sample_chars // (max(len(counts), 1) * (2 * rows_per_language))))
    draw = unit_hash(F.coalesce(F.col(key).cast("string"), F.lit("")), "crf")
    # a share that gives somewhat more than the wished rows of each language; the smallest hashes are taken
    share = {r[0]: min(1.0, (1.5 * rows_per_language + 50) / r[1]) for r in counts}
    rows = []
    if share:
        wanted = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col(lang)]
        begin = (draw / wanted * F.greatest(F.length(text) - stretch, F.lit(0))).cast("int") + 1
        sample = usable.where(draw < wanted).select(
            F.substring(F.col(text), begin, F.lit(stretch)).alias("text"), lang, draw.alias("draw"), F.col(key).alias("key"))
        rows = sorted(sample.collect(), key=lambda r: (r[1], r[2], str(r[3])))
    taken, samples = Counter(), []
    for r in rows:
        if taken[r[1]] < rows_per_language and (words := words_of(r[0])):
            taken[r[1]] += 1
            samples.append((words, r[1]))
    return LanguageField.fit(samples)


def identify(docs: DataFrame, field: LanguageField, text: str = "text", out: str = "lang_pred", score: str = "score",
             words_kept: int = 150_000, chars_at_once: int = 4_000_000) -> DataFrame:
    """``docs`` with the language of each whole text in ``out`` and its mean probability over the words in ``score``.

    Texts that are null or have no letter get ``und`` and 0; so do all texts
    where nothing could be learned. Of equal means the language first in the
    alphabet wins. Columns of these names are replaced. One narrow map; memory
    follows ``chars_at_once`` or the longest text.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory = Memory(len(field.labels))
        for batch in batches:
            group: list[str] = []
            held = 0
            for i, t in enumerate(batch, 1):
                group.append(t or "")
                held += len(group[-1])
                if held >= chars_at_once or i == len(batch):
                    if len(memory.known) > words_kept:
                        memory = Memory(len(field.labels))
                    read = field.read(group, memory) if field.labels else [()] * len(group)
                    means = [p.mean(axis=0) if len(p) else None for p in read]
                    yield pd.DataFrame({
                        "lang": ["und" if m is None else field.labels[int(m.argmax())] for m in means],
                        "score": [0.0 if m is None else float(min(m.max(), 1.0)) for m in means]})
                    group, held = [], 0

    names = {out.lower(), score.lower()}
    keep = [c for c in docs.columns if c.lower() not in names]
    name = fresh(docs, "_told")
    told = docs.withColumn(name, F.pandas_udf(run, "struct<lang:string,score:double>")(F.col(text)))
    return told.select(*[F.col(f"`{c}`") for c in keep], F.col(f"{name}.lang").alias(out), F.col(f"{name}.score").alias(score))
