"""Stored tables, the incremental job, ranking and the split join."""

import json
import os
import random

from pyspark.sql import functions as F

from larder.operators import analytics as an
from larder.operators import insights as ins
from larder.operators.joins import spread_join
from larder.operators.ranking import with_running
from larder.sources import pages as pg
from larder.sources import recipes as rs
from larder.streaming.incremental import page_stream, start_scrape


def write(folder, name, html):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(html)


def test_scan_saved_pages(spark, tmp_path):
    folder = str(tmp_path / "pages")
    write(folder, "recipes%2Ffood%3Fa.html", "<h1>one\n</h1>")
    write(folder, "home+now%2B1.html", "<h1>two</h1>")
    write(folder, "errors.jsonl", "{}")
    got = {r.path: (r.domain, r.html) for r in pg.read_saved_pages(spark, folder, "d").collect()}
    assert got == {"recipes/food?a": ("d", "<h1>one\n</h1>"), "home now+1": ("d", "<h1>two</h1>")}


def test_pages_are_saved_and_read_by_many_tasks(spark, tmp_path, monkeypatch):
    rows = [(f"{k % 3:03}", f"/p/{k}", f"\ufeff<p>\u00e9 {k}\r\n") for k in range(60)]
    one = spark.createDataFrame(rows, "domain string, path string, html string").coalesce(1)  # as a table of one row group is read
    parts, run = [], type(one).mapInArrow
    monkeypatch.setattr(type(one), "mapInArrow", lambda self, *a: parts.append(self.rdd.getNumPartitions()) or run(self, *a))
    assert pg.save_pages(one, str(tmp_path / "saved")) == 60 and parts == [4]
    (tmp_path / "saved" / "domain=000" / "odd.html").write_bytes(b"\xff<p>")
    read = pg.read_saved_pages(spark, str(tmp_path / "saved"))
    got = {(r.domain, r.path, bytes(r.html)) for r in read.withColumn("html", F.col("html").cast("binary")).collect()}
    assert got == {(d, p.lstrip("/"), h.encode()) for d, p, h in rows} | {("000", "odd", b"\xff<p>")}
    assert "binaryFile" in read._jdf.queryExecution().toString()  # the text source takes three times as long for each file


def test_image_manifest(spark, tmp_path):
    write(str(tmp_path), "home.png", "x")
    write(str(tmp_path), "r%2F1+2.png", "x")
    assert {r.file_name for r in pg.image_manifest(spark, str(tmp_path)).collect()} == {"home.png", "r%2F1+2.png"}


def test_errors_keep_optional_note(spark, tmp_path):
    rows = spark.createDataFrame([("/a",), ("/b",)], "path string")
    target = str(tmp_path / "log")
    rs.append_errors(rs.error_rows(rows, "E", F.lit("m"), "crawl"), target)
    rs.append_errors(rs.error_rows(rows.limit(1), "F", F.lit("m"), "crawl", F.lit("image")), target)
    assert {tuple(r) for r in rs.error_counts(rs.read_errors(spark, target)).collect()} == {("E", 2), ("F", 1)}
    raw = [json.loads(r.value) for r in spark.read.text(target).collect()]
    assert all("note" not in r for r in raw if r["error_type"] == "E")
    assert [r["note"] for r in raw if r["error_type"] == "F"] == ["image"]


def test_null_and_empty_parts_survive_storage(spark, tmp_path, capsys):
    rows = spark.createDataFrame(
        [("d", "1", "t", None, [], None), ("d", "2", None, [("g", ["l"])], None, None)],
        f"domain string, path string, title string, ingredients {rs.PARTS_TYPE}, instructions {rs.PARTS_TYPE}, misc {rs.MISC_TYPE}")
    target = str(tmp_path / "recipes")
    rs.append_recipes(rows, target)
    got = {r.path: r for r in rs.read_recipes(spark, target, "d").collect()}
    assert got["1"].ingredients is None and got["1"].instructions == []
    assert got["2"].ingredients[0].lines == ["l"] and got["2"].title is None
    rs.read_recipes(spark, target, "d").explain()
    assert "PartitionFilters: [isnotnull(domain" in capsys.readouterr().out


def test_key_rule(spark):
    rows = spark.createDataFrame([("d", "a", 2), ("d", "a", 1), ("d", "b", 1), ("e", "a", 1)] + [("d", "hot", i) for i in range(99)],
                                 "domain string, path string, seq int")
    ok, bad = rs.enforce_key(rows, ["seq"], spark.createDataFrame([("d", "b")], "domain string, path string"))
    assert {tuple(r) for r in ok.collect()} == {("d", "a", 1), ("e", "a", 1), ("d", "hot", 0)}
    assert bad.count() == 100
    assert rs.duplicate_errors(bad).where("path = 'b'").first().error_type == "UniqueViolation"


def test_incremental_scrape_restarts_without_duplicates(spark, tmp_path):
    folder, target, errors, state = (str(tmp_path / x) for x in ("in", "recipes", "errors", "state"))
    write(folder, "a.html", "<h1>A</h1>")
    write(folder, "b.html", "<h1>B</h1>")
    for _ in range(2):
        start_scrape(page_stream(spark, folder, "d"), target, errors, state).awaitTermination()
    assert {r.title for r in rs.read_recipes(spark, target).collect()} == {"A", "B"}
    write(folder, "c.html", "<h1>C</h1>")
    start_scrape(page_stream(spark, folder, "d"), target, errors, state).awaitTermination()
    # the state is lost: all pages come again, and none is stored twice
    start_scrape(page_stream(spark, folder, "d"), target, errors, state + "2").awaitTermination()
    assert sorted(r.title for r in rs.read_recipes(spark, target).collect()) == ["A", "B", "C"]


def test_incremental_scrape_logs_each_repeat(spark, tmp_path):
    from larder.sources.pages import write_corpus
    from larder.streaming.incremental import corpus_stream

    corpus, target, errors, state = (str(tmp_path / x) for x in ("corpus", "recipes", "errors", "state"))
    batches = [[("/a", "<h1>A2</h1>"), ("/a", "<h1>A1</h1>"), ("/b", None)], [("/a", "<h1>A0</h1>")] * 3 + [("/c", "<h1>C</h1>")], [("/b", "<h1>B</h1>")]]
    for rows in batches:
        write_corpus(spark.createDataFrame(rows, "path string, html string").repartition(2), corpus)
        start_scrape(corpus_stream(spark, corpus, "d"), target, errors, state).awaitTermination()
    assert sorted((r.path, r.title) for r in rs.read_recipes(spark, target).collect()) == [("a", "A1"), ("b", None), ("c", "C")]
    assert sorted(r.path for r in rs.read_errors(spark, errors).collect()) == ["a"] * 4 + ["b"]


def test_incremental_scrape_keeps_only_keys_in_state(spark, tmp_path):
    """Pages are told apart by Spark's own deduplication; no function runs once for every page."""
    from larder.sources.pages import write_corpus
    from larder.streaming.incremental import corpus_stream, first_seen

    corpus, out = str(tmp_path / "corpus"), []
    for rows in ([("/a", "x"), ("/a", "w"), ("/b", None)], [("/a", "v"), ("/c", "y")]):
        write_corpus(spark.createDataFrame(rows, "path string, html string"), corpus)
        query = first_seen(corpus_stream(spark, corpus, "d")).writeStream.foreachBatch(lambda b, n: out.append(b.collect()))
        run = query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        run.awaitTermination()
        (state,) = run.lastProgress["stateOperators"]
        assert state["operatorName"] == "dedupe"
    assert [sorted((r.path, r.html or "") for r in batch if not r.is_new) for batch in out] == [
        [("a", "w"), ("a", "x"), ("b", "")], [("a", "v"), ("c", "y")]]
    assert [sorted(r.path for r in batch if r.is_new) for batch in out] == [["a", "b"], ["c"]]


def test_running_totals_equal_a_plain_loop(spark):
    rnd = random.Random(3)
    rows = [(f"k{i:04d}", rnd.randrange(9)) for i in range(500)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x int")
    got = sorted(with_running(df, [F.desc("x"), F.col("k")], {"total": "x"}).collect(), key=lambda r: r.position)
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    total = 0
    for i, (w, g) in enumerate(zip(want, got, strict=True), 1):
        total += w[1]
        assert (g.k, g.position, g.total) == (w[0], i, total)


def test_spread_join_is_a_plain_join(spark):
    big = spark.range(300).select("id", F.when(F.col("id") < 200, 1).otherwise(F.col("id") % 7).alias("k"))
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "k long, name string")
    got = {(r.id, r.name) for r in spread_join(big, dim, ["k"], ["id"]).collect()}
    assert got == {(r.id, r.name) for r in big.join(dim, "k", "left").collect()} and len(got) == 300


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 1, 10)] + [(None,)], "x double")
    rows = an.histogram(df, "x", 10).orderBy("bin").collect()
    assert [r.n for r in rows] == [1, 2, 0, 0, 0, 0, 0, 0, 0, 1]
    assert abs(sum(r.density * 1.0 for r in rows) - 1.0) < 1e-9
    same = an.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r.n for r in same] == [0, 0, 2, 0]


def test_value_counts_and_reindex(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "t string")
    assert [tuple(r) for r in an.value_counts(df, "t").collect()] == [("b", 2), ("a", 1)]
    ids = spark.range(20).select(F.format_string("%03d", 19 - F.col("id")).alias("k"))
    assert [(r.k, r.row_index) for r in an.reindex(ids, ["k"]).orderBy("k").collect()] == [(f"{i:03d}", i) for i in range(20)]


def test_site_url_strips_characters(spark):
    df = spark.createDataFrame([("w.e", "recipes/ham.html")], "d string, p string")
    assert df.select(an.site_url("d", "p")).first()[0] == "https://w.e/recipes/ha"


def test_averages_count_absent_ingredients(spark):
    lines = spark.createDataFrame([("1", "flour", 50.0), ("1", "egg", 50.0), ("2", "flour", 10.0), ("3", "rice", 1.0)],
                                  "path string, cleaned string, weight double")
    titles = spark.createDataFrame([("1", "Pie Big"), ("2", "big pie"), ("3", None)], "path string, title string")
    got = {(r.cluster, r.cleaned): (r.recipes, r.mean_share) for r in ins.averaged_recipes(lines, titles, ["path"]).collect()}
    assert got == {("big pie", "flour"): (2, 0.75), ("big pie", "egg"): (2, 0.25)}
    assert {r.path for r in ins.search(lines, ["path"], ["flour"], ["egg"]).collect()} == {"2"}
    assert {r.path for r in ins.search(lines, ["path"], ["flour", "egg"]).collect()} == {"1"}
    assert {r.path for r in ins.search(lines, ["path"], [], ["egg"]).collect()} == {"2", "3"}
    assert [r.cleaned for r in ins.coverage(lines, 0.5).collect()] == ["flour"]
