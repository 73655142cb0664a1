"""Operators over the corpus: near copies, quality, line dedup, mixing, and the pipeline."""

import math
import os
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm import kneser_ney, line_join, order_minhash, raking

RNG = random.Random(9)
VOCABULARY = [f"w{i}" for i in range(3000)]


def prose(n, rng=RNG):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def changed(words, share, rng=RNG):
    out = []
    for w in words:
        k = rng.random()
        out += [] if k < share / 3 else [w, rng.choice(VOCABULARY)] if k < 2 * share / 3 else [rng.choice(VOCABULARY)] if k < share else [w]
    return out


# --- near copies ---------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment_by_dynamic_programming():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randint(0, rng.choice([2, 8, 40])) for _ in range(rng.randint(1, 40))]
        b = a[:]
        for _ in range(rng.randint(0, 12)):
            i = rng.randrange(len(b)) if b else 0
            b[i:i + rng.randint(0, 1)] = [rng.randint(0, 40)] * rng.randint(0, 1)
        if not b:
            continue
        d = distance(a, b)
        for similarity in (0.5, 0.8, 0.95):
            assert order_minhash.alike(a, b, similarity) == (d <= math.floor((1 - similarity) * max(len(a), len(b)) + 1e-9))


def test_near_copies(spark):
    texts = [prose(RNG.choice([30, 80, 200])) for _ in range(40)]
    family = defaultdict(list)
    rows = []

    def put(words, of):
        family[of].append(len(rows))
        rows.append((len(rows), words if words is None or isinstance(words, str) else " ".join(words)))

    for k, t in enumerate(texts):
        put(t, k)
    for k in range(0, 40, 4):
        for _ in range(6):
            put(changed(texts[k], 0.03), k)
        put(" ".join(texts[k]).upper(), k)  # a copy but for case
    passage = prose(60)
    for k in range(30):  # a shared passage does not make a copy
        put(prose(70) + passage + prose(70), 1000 + k)
    for odd in (None, "", "  \n "):
        put(odd, object()), put(odd, object())
    put("two words", "short"), put("two  words", "short"), put("two others", "other")
    put(prose(20000), "long"), put("x" * 100_000, "one")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("group_id", F.lit("old"))
    got = {r.doc_id: (r.group_id, r.kept) for r in order_minhash.near_duplicates(docs).collect()}
    assert got == {i: (min(ids), i == min(ids)) for ids in family.values() for i in ids}
    assert order_minhash.near_duplicates(docs.limit(0)).count() == 0


def test_texts_without_words_as_one_group(spark):
    rows = [(3, None), (1, ""), (2, " \n"), (5, "a word"), (None, ""), (7, "A  word")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.group_id, r.kept) for r in order_minhash.near_duplicates(docs, wordless_alike=True).collect()}
    assert got == {(3, 1, False), (1, 1, True), (2, 1, False), (5, 5, True), (7, 5, False), (None, None, True)}


def test_recall_where_copies_are_least_alike(spark):
    rng = random.Random(12)
    rows = []
    for k in range(120):  # similarities from 0.80 to 0.88, changes spread evenly: hardly a 5-mer is left
        words = prose([6, 12, 38, 45, 60, 100, 400][k % 7], rng)
        every = rng.choice([5, 6, 7, 8])
        other = [rng.choice(VOCABULARY) + "'" if i % every == every // 2 else w for i, w in enumerate(words)]
        while not order_minhash.alike(words, other, 0.8):
            other[next(i for i, w in enumerate(other) if w != words[i])] = words[next(i for i, w in enumerate(other) if w != words[i])]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in order_minhash.near_duplicates(docs).collect()}
    assert sum(got[2 * k + 1] == 2 * k for k in range(120)) >= 118
    assert len(set(got.values())) >= 120  # and nothing else


def test_a_common_passage_costs_no_alignment_of_every_pair(spark, monkeypatch):
    rng = random.Random(8)
    passage = prose(50, rng)
    texts = [prose(20, rng) + passage + [f"{rng.choice(VOCABULARY)}{rng.randint(0, 10**6)}" for _ in range(40)] for _ in range(400)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    rows += [(1000 + k, " ".join(texts[k][:100] + ["other"] * 10)) for k in range(0, 400, 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keep, counted = order_minhash.Stages.keep, Counter()

    def counting(self, df, name):
        out = keep(self, df, name)
        counted[name] += out.count() if name in ("pairs", "cut") else 0
        return out

    monkeypatch.setattr(order_minhash.Stages, "keep", counting)
    got = {r.doc_id: r.group_id for r in order_minhash.near_duplicates(docs).collect()}
    assert got == {k: k - 1000 if k >= 1000 else k for k, _ in rows}
    assert counted["cut"] and counted["pairs"] < 25_000  # of 83,028


def test_texts_that_are_alike_share_one_of_their_rarest_words():
    rng, known = random.Random(9), {}
    for _ in range(400):
        a = [f"w{rng.randint(0, rng.choice([3, 30, 300]))}" for _ in range(rng.randint(5, 60))]
        b = a[:]
        for _ in range(rng.randint(0, len(a) // 4)):
            i = rng.randrange(len(b)) if b else 0
            b[i:i + rng.randint(0, 1)] = [f"w{rng.randint(0, 300)}"] * rng.randint(0, 1)
        counts = np.random.default_rng(rng.randint(0, 99)).integers(0, 9, order_minhash.PLACES).astype(np.uint32)  # any order will do
        if len(b) >= 5 and order_minhash.alike(a, b, 0.8):
            one, two = (set(order_minhash.rarest(order_minhash.word_hashes(x, known), counts, 0.8).tolist()) for x in (a, b))
            assert one & two and len(one) == math.floor(0.2 * len(a) + 1e-9) + 1


def test_a_word_has_one_hash_wherever_it_stands():
    words = ["a", "b", "\u00e9" * 256, "x" * 300, "\ud800", "y" * 100_000, "ab", "ba"]
    first = order_minhash.word_hashes(words, {})
    assert len(set(first.tolist())) == len(words)
    assert (order_minhash.word_hashes(words[::-1] * 300, {}, 7).reshape(300, -1) == first[::-1]).all()


def test_order_of_words_counts():
    words = np.arange(400, dtype=np.uint64) * np.uint64(977)
    turned = np.r_[words[200:], words[:200]]  # nearly the same 5-mers, halves swapped
    a, b = (order_minhash.sketch(order_minhash.mixed(x), 64, 2, 5) for x in (words, turned))
    assert 0.2 < (a == b).mean() < 0.8 and (a == order_minhash.sketch(order_minhash.mixed(words), 64, 2, 5)).all()


# --- quality -----------------------------------------------------------------------------


def brute_model(train):
    """Log-probability of a text under the same model, from plain dictionaries."""
    words = kneser_ney.Words()
    pairs = Counter()
    for t in train:
        ids = [0, *words.of(t).tolist()]
        pairs.update(zip(ids, ids[1:], strict=False))
    d2 = kneser_ney.discounts(np.array([sum(n == k for n in pairs.values()) for k in (1, 2, 3, 4)]))
    before = Counter(w for _, w in pairs)
    d1 = kneser_ney.discounts(np.array([sum(n == k for n in before.values()) for k in (1, 2, 3, 4)]))
    total = sum(before.values())
    left = sum(d1[min(n, 3)] for n in before.values())
    context, kinds = Counter(), defaultdict(float)
    for (v, _), n in pairs.items():
        context[v] += n
        kinds[v] += d2[min(n, 3)]

    def log_ppl(text):
        ids = [0, *words.of(text).tolist()]
        out = 0.0
        for v, w in zip(ids, ids[1:], strict=False):
            low = (before[w] - d1[min(before[w], 3)] if before[w] else 0) / total + left / total / kneser_ney.WORDS
            n = pairs[v, w]
            p = (n - d2[min(n, 3)] if n else 0) / context[v] + kinds[v] / context[v] * low if context[v] else low
            out += math.log(p)
        return -out / (len(ids) - 1)

    return log_ppl


@pytest.mark.parametrize("hot", [0, 64, 1 << 18])
def test_perplexities_by_brute_force(spark, hot):
    rng = random.Random(3)
    common = [f"c{min(int(rng.expovariate(0.05)), 400)}" for _ in range(5000)]
    texts = [" ".join(common[i * 50:i * 50 + 50]) for i in range(100)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(100, None, "en"), (101, " ", None), (102, "new words here", "fr"), (None, texts[0], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    train = docs.where("doc_id < 80")
    out = kneser_ney.perplexities(docs, train, bytes_in_shard=300, hot_pairs=hot, tokens_at_once=400).collect()
    want = brute_model(texts[:80])
    assert sorted(str(r.id) for r in out) == sorted(str(r[0]) for r in rows)
    for r in out:
        text = dict((x[0], x[1]) for x in rows)[r.id]
        if not (text or "").strip():
            assert r.log_ppl is None and r.n_words == 0
        else:
            assert r.log_ppl == pytest.approx(want(text), abs=2e-3)


@pytest.mark.parametrize("frequent", [0, 100])
def test_rare_words_by_brute_force(spark, frequent):
    rng = random.Random(4)
    texts = [" ".join(f"c{int(rng.paretovariate(0.4)) % 5000}" for _ in range(50)) for _ in range(100)] + ["one", "new words here"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    out = kneser_ney.perplexities(docs, docs.where("doc_id < 80"), bytes_in_shard=300, tokens_at_once=400, hot_words=frequent).collect()
    want = brute_model(texts[:80])
    assert len(out) == len(texts) and all(r.log_ppl == pytest.approx(want(texts[r.id]), abs=2e-3) for r in out)


def test_only_scores_are_left_of_a_model(spark):
    """Tables of counts go when they are read, and the shards' side gets no bit tables."""
    import glob
    import pickle

    from larder.session import shared_dir

    docs = spark.createDataFrame([(i, f"a b c{i % 7} d", "en") for i in range(40)], "doc_id long, text string, lang string")
    before = set(glob.glob(f"{shared_dir(spark)}/kneser-ney-*"))
    out = kneser_ney.perplexities(docs, docs.where("doc_id < 30"))
    base, = set(glob.glob(f"{shared_dir(spark)}/kneser-ney-*")) - before
    assert [os.path.basename(p).split("-")[0] for p in glob.glob(f"{base}/*")] == ["scores"] and out.count() == 40
    model = kneser_ney.Model(np.zeros(1, np.uint64), [], [], [], [], [], [], [])
    assert len(pickle.dumps(model)) > 20_000_000 and len(pickle.dumps(model.for_shards())) < 10_000


def test_unseen_words_share_no_counts(spark):
    import xxhash

    met = {}  # words whose hashes are equal modulo 2**20 - 1
    one, two = next((met[k], w) for w in (f"u{i}" for i in range(100_000)) if met.setdefault(k := xxhash.xxh64_intdigest(w) % ((1 << 20) - 1), w) != w)
    docs = spark.createDataFrame([(0, f"a {one} b " * 20, "en"), (1, f"a {one} b", "en"), (2, f"a {two} b", "en")], "doc_id long, text string, lang string")
    got = {r.id: r.log_ppl for r in kneser_ney.perplexities(docs, docs.where("doc_id = 0")).collect()}
    assert got[2] > got[1] + 1


def test_quality_rejects_noise_and_keeps_prose(spark):
    rng = random.Random(5)
    usual = VOCABULARY[:200]
    rows = [(i, " ".join(rng.choices(usual, k=80)), "en" if i % 2 else "de") for i in range(600)]
    rows += [(600 + i, " ".join(f"{w}%%{rng.random()}" for w in rng.choices(usual, k=80)), "en") for i in range(20)]
    rows += [(700, None, None), (701, "", "en"), (None, rows[0][1], "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("kept", F.lit("old"))
    labels = spark.createDataFrame([(i, 1 if i < 400 else 0, 0) for i in [*range(400), *range(600, 610)]] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kneser_ney.judge(docs, labels).collect()}
    assert len(got) == len(rows) and not any(got[600 + i].kept for i in range(20))
    assert sum(got[i].kept for i in range(600)) >= 590 and got[700].kept and got[701].kept and got[None].kept
    none = kneser_ney.judge(docs.limit(5), labels.limit(0)).collect()
    assert len(none) == 5 and all(r.kept for r in none)
    assert kneser_ney.judge(docs.limit(0), labels).count() == 0


def test_rare_languages_have_limits_of_their_own(spark):
    rng = random.Random(8)
    usual, other = VOCABULARY[:100], VOCABULARY[1000:1100]
    rows = [(i, " ".join(rng.choices(usual, k=80)), "en") for i in range(400)]
    rows += [(1000 + i, " ".join(rng.choices(other, k=80)), "is") for i in range(80)]  # trusted: 40
    rows += [(2000 + i, " ".join(rng.choices(other, k=40) + [f"x{i}y{k}" for k in range(40)]), lang) for i, lang in enumerate(["fo", None, "en", "is"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in [*range(400), *range(1000, 1040)]], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kneser_ney.judge(docs, labels).collect()}
    assert all(got[i].kept for i in range(1000, 1080)) and got[1000].limit > got[0].limit + 0.5
    assert [got[2000 + i].kept for i in range(4)] == [True, True, False, False]  # no trusted text: kept
    assert got[2000].limit is None and got[2001].limit is None


# --- lines --------------------------------------------------------------------------------


def brute_lines(rows, threshold=0.8):
    import re

    seen, out = [], {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[key] = (None, 0, 0)
            continue
        kept = []
        for line in text.split("\n"):
            words = {w for w in re.split(r"[\W_]+", line.lower()) if w}
            if words and any(len(words & s) >= threshold * len(words | s) - 1e-9 for s in seen):
                seen.append(words)
                continue
            if words:
                seen.append(words)
            kept.append(line)
        out[key] = ("\n".join(kept), len(text.split("\n")), len(text.split("\n")) - len(kept))
    return out


def test_lines_by_brute_force(spark):
    rng = random.Random(6)
    base = [prose(rng.choice([1, 3, 4, 5, 9, 20, 40]), rng) for _ in range(25)]
    rows = []
    for i in range(120):
        lines = [" ".join(changed(rng.choice(base), rng.choice([0, 0, 0.05, 0.2, 0.4]), rng)) for _ in range(rng.randint(0, 6))]
        rows.append((i, "\n".join([*lines, rng.choice(["", "...", "All rights reserved."])])))
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "Ünïcode Wörter\nünïcode wörter"), (504, "a " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("old")).withColumn("id", F.lit(1))
    out = line_join.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "id", "n_lines", "n_removed"]
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in out.collect()} == brute_lines(rows)
    assert line_join.dedup_lines(docs.limit(0)).count() == 0


def test_long_lines_of_common_words_are_told_apart_without_their_words(spark, monkeypatch):
    rng, made = random.Random(17), []
    words = [f"w{i}" for i in range(600)]
    lines = [rng.sample(words, 150) for _ in range(300)]
    lines += [changed(lines[i], 0.05, rng) for i in range(20)]
    rows = [(i, " ".join(line)) for i, line in enumerate(lines)]
    keep = line_join.Stages.keep
    monkeypatch.setattr(line_join.Stages, "keep", lambda self, df, name: made.append((name, keep(self, df, name))) or made[-1][1])
    monkeypatch.setattr(line_join.Stages, "drop", lambda self, *tables: None)
    out = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_join.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == brute_lines(rows) and sum(n for _, _, n in out.values()) == 20
    assert sum(df.count() for name, df in made if name == "pairs") < 100  # of 51,040


def test_lines_of_null_keys(spark):
    docs = spark.createDataFrame([(None, "one two three\nfour"), (1, "one two three\nfive")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_join.dedup_lines(docs).collect()} == {None: "one two three\nfour", 1: "five"}


# --- mixing -------------------------------------------------------------------------------


def mixed(spark, n=600):
    rng = random.Random(7)
    rows = [(i, " ".join(["word"] * rng.randint(1, 60)) + rng.choice(["", " x@y", " License"]), rng.choice(["en", "en", "en", "de", None]),
             rng.choice(["hot"] * 6 + ["a", "b", None])) for i in range(n)]
    return spark.createDataFrame(rows + [(n, None, "en", "hot"), (None, "word", None, None), (n + 1, "", "zz", "zz")],
                                 "doc_id long, text string, lang string, source string").withColumn("weight", F.lit("old"))


def test_weights_meet_their_targets(spark):
    out = raking.mix(mixed(spark), rounds=12).toPandas()
    assert len(out) == 603 and out["probability"].between(0, 1).all()
    out["mass"] = out["n_tokens"] * out["weight"]
    for margin in ("source", "lang", "topic"):
        tokens = out.fillna({margin: "(none)"}).groupby(margin)[["n_tokens", "mass"]].sum()
        tokens = tokens[tokens["n_tokens"] > 0]
        goal = (tokens["n_tokens"] / tokens["n_tokens"].sum()) ** 0.5
        assert np.allclose(tokens["mass"] / tokens["mass"].sum(), goal / goal.sum(), atol=1e-4)
    kept = out[out["sampled"]]["n_tokens"].sum() / (out["n_tokens"] * out["probability"]).sum()
    assert 0.85 < kept < 1.15


def test_given_targets(spark):
    goal = spark.createDataFrame([("en", 0.5), ("de", 0.5)], "value string, target double")
    out = raking.mix(mixed(spark), targets={"lang": goal}, rounds=12).toPandas()
    out["mass"] = out["n_tokens"] * out["weight"]
    mass = out[out["n_tokens"] > 0].fillna({"lang": "(none)"}).groupby("lang")["mass"].sum()
    assert mass["de"] == pytest.approx(mass["en"], rel=1e-3) and mass["(none)"] == 0
    assert raking.mix(mixed(spark).limit(0)).count() == 0


def test_columns_named_like_internal_ones_stay(spark):
    own = ["_cut", "_of", "id", "_source", "_lang", "_topic", "_weight", "_n"]
    docs = spark.createDataFrame([(1, "one two three\nfour", "en", "s"), (2, "one two three", "en", "s")],
                                 "doc_id long, text string, lang string, source string").select("*", *[F.lit(5).alias(c) for c in own])
    cut = {r.doc_id: r for r in line_join.dedup_lines(docs).collect()}
    assert cut[2].text == "" and cut[1].text == "one two three\nfour"
    mixed_in = raking.mix(docs).collect()
    assert all(r[c] == 5 for r in [*cut.values(), *mixed_in] for c in own) and len(mixed_in) == 2


def test_quality_of_text_keys(spark):
    rows = [(f"k{i}", " ".join(prose(30)), "en") for i in range(30)]
    docs = spark.createDataFrame([*rows, (None, "some words", None), ("e", "", "en")], "doc_id string, text string, lang string")
    labels = spark.createDataFrame([(f"k{i}", 1) for i in range(20)], "doc_id string, quality int")
    out = kneser_ney.judge(docs, labels)
    assert out.schema["doc_id"].dataType.simpleString() == "string"
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == sorted(map(str, [*(k for k, _, _ in rows), None, "e"]))


# --- the pipeline -----------------------------------------------------------------------------

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")
def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    con = duckdb.connect()
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.toPandas()
        out = stage(spark, docs, DIR)
        docs = spark.createDataFrame(out.toPandas(), out.schema)
        after = kept[name] = docs.toPandas()
        assert set(after["doc_id"]) <= set(before["doc_id"]) and len(after) > 0
        con.register("stage_in", before)
        if name != "encoding":
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "quality":
            judged = {r.doc_id: r.kept for r in kneser_ney.judge(spark.createDataFrame(before), spark.read.parquet(f"{DIR}/labels.parquet")).collect()}
            assert set(after["doc_id"]) == {i for i, k in judged.items() if k}
        if name == "line_dedup":
            want = con.execute(f"WITH {line_join.dedup_lines_sql('stage_in')} SELECT doc_id, text FROM deduped").fetchall()
            assert dict(want) == dict(zip(after["doc_id"], after["text"], strict=True))
        if name == "near_dedup":
            words = {i: order_minhash.words_of(t) for i, t in zip(before["doc_id"], before["text"], strict=True)}
            stay = set(after["doc_id"])
            near = [(a, b) for a in words for b in words if a < b
                    and (words[a] == words[b] or min(len(words[a]), len(words[b])) >= 5 and order_minhash.alike(words[a], words[b], 0.8))]
            assert not any(a in stay and b in stay for a, b in near)
            assert set(words) - stay <= {b for _, b in near}
        if name == "mixing":
            want = con.execute(f"WITH {raking.mix_sql('stage_in')} SELECT doc_id FROM mixed WHERE sampled").fetchall()
            assert {x[0] for x in want} == set(after["doc_id"])
        if name == "encoding":
            assert after["round_trip"].all() and len(after) == len(before)


def test_stages_on_odd_rows(spark, tmp_path):
    text = " ".join(prose(60))
    other = " ".join(prose(60))
    rows = [(1, text, "en", "s"), (2, text, "en", "s"), (2, text, "en", "s"), (3, other, None, None), (4, None, "en", "s"),
            (5, "", "en", "s"), (6, " \n ", None, "s"), (None, other + " end", "en", "s"), (7, "x" * 200_000, "en", "s"),
            (8, " ".join(prose(40_000)), "en", "t")]
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(rows, schema).withColumn("n_chars", F.length("text").cast("long"))
    odd = docs.select("*", *[F.lit("own").alias(c) for c in ("id", "kept", "group_id", "_cut", "topic", "ids", "weight")])
    spark.createDataFrame([(3, 1), (None, 1), (8, None)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    want = {"quality": 10, "line_dedup": 10, "mixing": None, "encoding": 10}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, str(tmp_path)).collect()
        if name != "encoding":
            assert list(out[0].asDict()) == corpus_pipeline.COLUMNS
        if want.get(name):
            assert len(out) == want[name]
        if name == "line_dedup":
            assert sorted(r.text or "" for r in out if r.doc_id == 1) == [text] and {r.text for r in out if r.doc_id == 4} == {None}
        if name == "near_dedup":  # copies, rows of one key apart; texts without words as one; a null key stays
            assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 1), (False, 3), (False, 4), (False, 7), (False, 8), (True, 0)]
        if name == "mixing":
            assert {r.doc_id for r in out} <= {r[0] for r in rows}
        if name == "encoding":
            assert all(r.round_trip and (r.n_ids == 0) == (r.doc_id in (4, 5)) for r in out)
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_bit_tables_hold_every_key():
    rng = np.random.default_rng(5)
    for bits, parts in ((34, 16), (64, 16), (64, 37), (34, 1)):
        keys = np.unique(np.r_[rng.integers(0, 1 << min(bits, 62), 5000).astype(np.uint64) << np.uint64(max(bits - 62, 0)),
                               np.array([0, (1 << bits) - 1], np.uint64)])
        cut = kneser_ney.by_shard(keys, parts, bits)
        slices = [kneser_ney.sieve_slice(keys[a:b], k, parts, bits) for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False))]
        table = kneser_ney.sieve_of(slices)
        assert kneser_ney.may_hold(table, keys, bits).all()
        others = np.setdiff1d(rng.integers(0, 1 << min(bits, 62), 5000).astype(np.uint64) << np.uint64(max(bits - 62, 0)), keys)
        assert kneser_ney.may_hold(table, others, bits).mean() < 0.01
    assert not kneser_ney.may_hold(kneser_ney.sieve_of([]), np.array([0, 7], np.uint64)).any()
