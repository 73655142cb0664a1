"""Similar titles, components, the ingredient index, heavy keys and medians against plain versions."""

import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from larder.operators import insights, joins
from larder.operators.graph import components
from larder.operators.normalize import conversion_table
from larder.operators.search import IngredientIndex
from larder.operators.similar import clusters, similar_pairs
from larder.plans import views
from larder.session import stage_path


def plain_components(links):
    home = {x: x for pair in links for x in pair}

    def root(x):
        while home[x] != x:
            x = home[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        home[b] = a
    return {x: root(x) for x in home if root(x) != x}


def test_components(spark):
    rng = random.Random(5)
    links = [(f"n{rng.randrange(80):02}", f"n{rng.randrange(80):02}") for _ in range(60)]
    links += [(f"p{i:02}", f"p{i + 1:02}") for i in range(40)] + [("hub", f"h{i}") for i in range(50)] + [("x", "x"), ("p00", "p01")]
    got = components(spark.createDataFrame(links, "a string, b string"))
    assert {r.node: r.component for r in got.collect()} == plain_components(links)
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("block", [4, 128])
def test_similar_pairs(spark, block):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    sets = {frozenset(rng.sample(words, rng.randint(1, 9))) for _ in range(80)}
    for s in list(sets)[:40]:
        sets.add(s | {rng.choice(words)})
    common = frozenset(["the", "best", "cake", "of", "all", "in", "town"])  # a bucket nearly all of these fall in
    sets |= {common | {f"x{i}"} for i in range(60)}
    sets = {" ".join(sorted(s)): s for s in sets}
    df = spark.createDataFrame([(k, list(s)) for k, s in sets.items()], "title string, words array<string>")
    got = [(r.a, r.b) for r in similar_pairs(df, "title", "words", 0.75, block=block).collect()]
    want = {(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.75}
    assert len(got) == len(set(got)) and set(got) <= want
    assert len(got) >= 0.999 * len(want)  # at 0.75 a pair is missed with a probability of 0.0001
    found = {r.title: r.cluster for r in clusters(df, "title", "words", 0.8).collect()}
    linked = [(a, b) for a, b in want if jaccard(sets[a], sets[b]) >= 0.8]
    assert found == {k: k for k in sets} | plain_components(linked)


def test_title_clusters(spark):
    titles = ["Best chocolate cake for two", "For two: the best Chocolate Cake!", "best chocolate cake for two", "Lemon cake for two", None, "!!", "?", "", "Éclair"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(titles)] + [(50 + i, titles[0], "y") for i in range(40)], "id int, title string, cluster string")
    got = {r.id: r.cluster for r in insights.title_clusters(df, ["id"]).collect()}
    assert got[0] == got[1] == got[2] == got[60] != got[3] and 4 not in got
    assert got[5] == got[6] == got[7] == "" and got[8] == "éclair" and len(got) == 48


def test_averaged_over_similar_titles(spark):
    lines = spark.createDataFrame([(1, "flour", 100.0), (1, "sugar", 100.0), (2, "flour", 50.0), (3, "rice", 10.0)], "id int, cleaned string, weight double")
    titles = spark.createDataFrame([(1, "very best plain white bread"), (2, "Best plain white bread"), (3, "rice")], "id int, title string")
    got = {(r.cleaned, r.recipes): r.mean_share for r in insights.averaged_recipes(lines, titles, ["id"]).collect()}
    assert got == {("flour", 2): 0.75, ("sugar", 2): 0.25, ("rice", 1): 1.0}


def test_index_reads_wanted_folders_only(spark):
    rng = random.Random(1)
    recipes = {i: set(rng.sample([f"f{k}" for k in range(12)], rng.randint(1, 5))) for i in range(60)}
    index = IngredientIndex(spark, stage_path(spark, "index"), ["id"], buckets=16)
    for part in (range(0, 40), range(20, 60)):  # the second append repeats recipes
        rows = [(i, f) for i in part for f in recipes[i]] + [(i, None) for i in part]
        index.append(spark.createDataFrame(rows, "id int, cleaned string"))
    for all_of, none_of in ((["f1"], []), (["f1", "f2"], ["f3"]), ([], ["f3", "f4"]), (["f1", "f1"], ["nothing"]), (["nothing"], []), ([], [])):
        want = sorted(i for i, s in recipes.items() if s >= set(all_of) and not s & set(none_of))
        assert sorted(r.id for r in index.search(all_of, none_of).collect()) == want
    plan = index.search(["f1", "f2"], ["f3"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(bucket") + plan.count("PartitionFilters: [(bucket") + plan.count("PartitionFilters: [bucket") >= 3
    files = [f for f in index.with_any(["f1"]).inputFiles() if "bucket=" in f]
    assert files  # the index holds folders by bucket


def test_heavy_keys_are_found_and_split(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"k{i}", i) for i in range(1000)]
    big = spark.createDataFrame(rows, "key string, n int")
    heavy = joins.heavy_keys(big, ["key"])
    hot = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    assert heavy == {hot: 3}  # three of four partitions' share
    names = spark.createDataFrame([("hot", "a"), ("k5", "b"), ("none", "c")], "key string, name string")
    out = joins.spread_join(big, names, ["key"], ["n"])
    assert out.count() == 4000 and out.where("name = 'a'").count() == 3000 and out.where("name = 'b'").count() == 1
    assert out.columns == ["key", "n", "name"]
    assert joins.heavy_keys(spark.createDataFrame([(f"k{i}", i) for i in range(1000)], "key string, n int"), ["key"]) == {}
    assert joins.spread_join(big, names, ["key"], ["n"], "left_semi").count() == 3001
    assert joins.heavy_keys(big.limit(0), ["key"]) == {}


def test_conversion_table_is_the_median_of_all_portions(spark):
    rng = random.Random(2)
    rows = [("flour", rng.choice(["1 cup", "1/2 cup", "2 cups"]), float(rng.randint(50, 300))) for _ in range(101)]
    rows += [("egg", "1 medium", 44.0), ("egg", "1 large", 60.0), ("egg", "1 cup", 240.0), ("air", "some", 1.0)]
    got = {r.ingredient: (r.per_cup, r.per_count) for r in conversion_table(spark.createDataFrame(rows, "ingredient string, measure string, grams double")).collect()}
    cups = {"1 cup": 1, "1/2 cup": 0.5, "2 cups": 2}
    assert got["flour"] == (pytest.approx(statistics.median(g / cups[m] for i, m, g in rows if i == "flour")), None)
    assert got["egg"][0] == 240 and "air" not in got


def test_titles_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = spark.range(300).select("id", F.concat(F.lit("pie "), (F.col("id") % 7).cast("string")).alias("title"))
    titles = rows.mapInArrow(counted, rows.schema)
    assert insights.title_clusters(titles, ["id"]).count() == 300
    assert read.value == 300


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_titles_need_no_lists_of_lines(spark):
    d = "/root/testdata/sf0.001"
    titled = views.titled_orders(spark, d)
    assert "collect_list" not in titled._jdf.queryExecution().optimizedPlan().toString()
    full = views.recipes(spark, d).select("path", "title")
    assert titled.count() == full.count() > 0
    assert titled.select("path", "title").exceptAll(full).isEmpty()
