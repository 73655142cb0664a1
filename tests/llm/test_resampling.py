"""Importance resampling, centroid clustering and decontamination against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import ns_bounds, prefix_crc, winnowing

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


TEXTS = [
    None, "", "  .,- ", "one", "One TWO", "Ünder the Éclair's ÉCLAIR sky-line", "a  b\tc\nd 東京 タワー K \x7f é", "x" * 300 + " " + "y" * 70,
    "deep\x00zero İstanbul ISTANBUL istanbul", "tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie",
]


def some_texts(n=60, seed=4):
    rng = random.Random(seed)
    vocabulary = [f"wörd{i}" if i % 7 == 0 else f"w{i}" for i in range(40)]
    out = TEXTS + [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    return out + [out[12], out[12]]


# --- importance resampling -------------------------------------------------------------


def plain_features(text, buckets):
    w = words(text)
    return Counter(zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1))


def plain_resample(rows, target, buckets, percent, fewest):
    own, wanted = Counter(), Counter()
    for _, t in rows:
        own += plain_features(t, buckets)
    for t in target:
        wanted += plain_features(t, buckets)
    s, t_all = sum(own.values()), sum(wanted.values())
    out = []
    for i, t in rows:
        f = plain_features(t, buckets)
        weight = sum(c * math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((own[b] + 1) * (t_all + buckets)))) for b, c in f.items())
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, sum(f.values()), weight, score, len(words(t)), None])
    may = sorted((r for r in out if r[4] >= fewest and r[3] is not None), key=lambda r: (-r[3], r[0], r[2]))
    for place, r in enumerate(may[:percent * len(may) // 100], 1):
        r[5] = place
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("buckets", [10_000, 13])
def test_resample(spark, buckets):
    rows = [*enumerate(some_texts()), (None, "w1 " * 30), (5, "w2 w3 " * 20), (5, "w2 w3 " * 20)]
    target = [None, "", "w1 w2 w3 w4 w5", "W1 w2, wörd7!"]
    docs = spark.createDataFrame([(i, t, 1.5, "x") for i, t in rows], "doc_id long, text string, weight double, score string")
    items = spark.createDataFrame([(t,) for t in target], "text string")
    got = prefix_crc.resample(docs, items, percent=40, buckets=buckets).collect()
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r.n_words, r["rank"]) for r in got), key=str) == \
        plain_resample(rows, target, buckets, 40, 20)


def test_resample_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert prefix_crc.resample(docs, docs).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = prefix_crc.resample(one, docs).first()
    assert (r.n_words, r.n_features, r["rank"]) == (2, 3, None)


def test_text_keys(spark):
    docs = spark.createDataFrame([("a", "w " * 25), ("b", "v " * 25)], "doc_id string, text string")
    assert sorted(r["rank"] for r in prefix_crc.resample(docs, docs, percent=100).collect()) == [1, 2]


@pytest.mark.parametrize("size", [1, 7, 50, 10**6])
def test_features_of_stretches(size):
    text = TEXTS[6] + " " + TEXTS[5] + TEXTS[7]
    features = prefix_crc.Features(3, 10_000)
    parts = list(prefix_crc.stretches(text.encode(), 3, size))
    assert sum(len(w) - carried for w, carried in parts) == len(words(text))
    got = Counter(b for bucket, _ in features.of(parts) for b in bucket.tolist())
    assert got == plain_features(text, 10_000)


def test_shift():
    shift, rng = prefix_crc.Shift(), random.Random(2)
    for n in (0, 1, 63, 64, 65, 1000, 123_457):
        a, b = rng.randbytes(9), rng.randbytes(n)
        moved = shift(np.array([zlib.crc32(a)], np.uint32), np.array([n]))[0]
        assert int(moved) ^ zlib.crc32(b) == zlib.crc32(a + b)


# --- clustering ----------------------------------------------------------------------------


def plain_clusters(rows, dim, k, rounds):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, q) for i, q in kept if max(map(abs, q)) <= math.isqrt(2**60 // dim)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [q for _, q in first]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        homes = [near(q)[1] for _, q in kept]
        centres = [[sum(col) // len(col) for col in zip(*own, strict=True)] if (own := [q for (_, q), h in zip(kept, homes, strict=True) if h == j]) else c
                   for j, c in enumerate(centres)]
    found = [(i, *near(q)[::-1]) for i, q in kept]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), marks[j]) for i, j, d in found), key=str)


def vectors(n=300, dim=8, seed=6):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(9, dim))
    rows = [(i, [float(np.float32(x)) for x in base[rng.integers(9)] + rng.normal(size=dim) * 0.2]) for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [1.0] * (dim - 1)), (n + 3, [float("nan")] * dim), (n + 4, [None] * dim),
             (n + 5, [float("inf")] + [0.0] * (dim - 1)), (n + 6, [3e38] * dim), (n + 7, [-3e38] * dim), (n + 8, [0.0] * dim), (n + 9, [-0.001] * dim),
             (7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1])]
    return rows + [(n + 20 + i, [float(i % 2)] * dim) for i in range(20)]  # ties


@pytest.mark.parametrize("k, rounds", [(16, 3), (5, 8), (400, 2), (3, 0)])
def test_clusters(spark, k, rounds):
    rows = vectors()
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, distance int").repartition(3)
    got = ns_bounds.cluster(df, dim=8, k=k, rounds=rounds).collect()
    want = plain_clusters([(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 8, k, rounds)
    assert sorted((tuple(r)[:6] for r in got), key=str) == want


def test_clusters_of_nothing(spark):
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert ns_bounds.cluster(none).collect() == []
    assert ns_bounds.cluster(none).columns[:2] == ["vec_id", "cluster"]


def test_bounds_save_work_and_displacement_norms_save_more():
    rng = np.random.default_rng(1)
    points = np.floor(64 * (rng.normal(size=(6, 16)) * 4)[rng.integers(6, size=2000)] + rng.normal(size=(2000, 16)) * 20).astype(np.int64)
    history = points[:12][None]
    state = ns_bounds.State.scan(points, history[0])
    spent = []
    for _ in range(10):
        new = history[-1].copy()
        for j in set(state.near.tolist()):
            own = points[state.near == j]
            new[j] = own.sum(axis=0) // len(own)
        history = np.concatenate([history, new[None]])
        spent.append(state.advance(points, history).mean())
        exact = ((points[:, None] - new[None]) ** 2).sum(axis=2)
        assert (state.near == exact.argmin(axis=1)).all()
    assert spent[-1] < 2 < 12 and sum(spent) < 10 * 12 / 2
    # the norm of a sum is never above the sum of norms
    drift = np.sqrt((np.diff(history, axis=0) ** 2).sum(axis=2)).sum(axis=0)
    assert (np.sqrt(((history[-1] - history[0]) ** 2).sum(axis=1)) <= drift + 1e-9).all()


# --- decontamination --------------------------------------------------------------------------


def plain_contamination(docs, items, window=10):
    out = []
    wanted = [(i, w) for i, t in items if (w := words(t))]
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, x in wanted:
            size = min(window, len(x))
            grams = {tuple(x[a:a + size]) for a in range(len(x) - size + 1)}
            for a in range(len(w) - size + 1):
                if tuple(w[a:a + size]) in grams:
                    hit |= set(range(a, a + size))
                    if i is not None:
                        found.add(str(i))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_contamination(spark):
    rng = random.Random(3)
    vocabulary = ["wörd", "É", "é", "K", "k", "the", "of", "a", "Zoo", "zoo"]  # few words: many accidental runs
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(rng.randint(10, 25)))) for i in range(12)]
    items += [(12, items[3][1].upper()), (20, "never said"), (21, "one"), (22, "two-word"), (23, None), (24, " . "), (None, items[5][1]), (25, " ".join(["same"] * 30)),
              (26, "nine words are what this item holds in all")]
    docs = [(i, " ".join(prose(rng.randint(0, 60)))) for i in range(60)]
    for i in range(40):
        part = items[i % 12][1].split()
        cut = part[rng.randint(0, 3):len(part) - rng.randint(0, 3)]
        docs.append((100 + i, " ".join(prose(rng.randint(0, 9)) + cut + prose(rng.randint(0, 300)) + cut[:10])))
    docs += [(200 + i, t) for i, t in enumerate(TEXTS)] + [(300, docs[70][1]), (300, docs[70][1]), (301, docs[70][1]), (None, docs[71][1]),
             (302, "Same " * 9), (303, "Same, " * 10), (304, "a Two word; one x"), (305, "so NINE words are what this item holds in all that")]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, t string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in winnowing.contamination(d, b).collect()), key=str)
    assert got == plain_contamination(docs, items)


def test_contamination_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert winnowing.contamination(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    r = winnowing.contamination(docs, items.limit(0)).first()
    assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (3, 0, 0, hashlib.sha256(b"").hexdigest(), False)


def test_every_long_shared_span_shares_a_fingerprint(spark):
    rng = random.Random(8)
    shared = [f"s{rng.randint(0, 4)}" for _ in range(10)]
    rows = [(i, [f"a{rng.randint(0, 9)}" for _ in range(rng.randint(0, 40))] + shared + [f"b{rng.randint(0, 9)}" for _ in range(rng.randint(0, 40))]) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, w array<string>")
    marks = winnowing.fingerprints(df, ["id"], 10, 5, []).groupBy("mark").agg(F.countDistinct("id").alias("n"))
    assert marks.agg(F.max("n")).first()[0] == 50
