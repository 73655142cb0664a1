"""Scraping while pages still arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larder.functions.urls import file_name_to_path
from larder.operators.extract import DEFAULT_LAYOUT, SiteLayout, scrape, scrape_errors
from larder.session import discard, materialize, path_exists
from larder.sources import recipes as store
from larder.sources.pages import with_path
from larder.sources.recipes import KEY

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def page_stream(spark: SparkSession, folder: str, domain: str) -> DataFrame:
    """New ``*.html`` files of a folder, as (domain, path, html)."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", "*.html")
        .load(folder)
    )
    return with_path(files, F.lit(domain))


def corpus_stream(spark: SparkSession, source: str, domain: str) -> DataFrame:
    """New files of a corpus table, as (domain, path, html)."""
    stored = spark.readStream.schema("file_name string, html string").parquet(source)
    return stored.select(F.lit(domain).alias("domain"), file_name_to_path("file_name").alias("path"), "html")


def keys_of(pages: DataFrame) -> DataFrame:
    """The keys of pages, one a page and Arrow batch, so that a page saved very often shuffles little."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from pa.Table.from_batches([batch]).group_by(KEY).aggregate([]).to_batches()

    return pages.select(*KEY).mapInArrow(run, "domain string, path string")


def first_seen(pages: DataFrame) -> DataFrame:
    """(domain, path, html, is_new): every page of a batch, and beside them a row ``is_new`` for each key that never came before.

    Only keys pass through Spark's own deduplication, whose state knows every
    (domain, path) that has come so far and is looked up for the keys of the batch
    alone, so the cost of a batch does not grow with what is stored. The sources
    go past it as they are; :func:`judged` brings both together.
    """
    new = keys_of(pages).dropDuplicates(KEY)
    return pages.select(*KEY, "html", F.lit(False).alias("is_new")).unionByName(
        new.select(*KEY, F.lit(None).cast("string").alias("html"), F.lit(True).alias("is_new")))


def judged(marked: DataFrame) -> DataFrame:
    """(domain, path, html, is_new, repeats): a row for each page of a stored batch of :func:`first_seen`.

    ``html`` is the smallest of several copies in the batch, the same when the
    batch runs again; where the page is new the other copies are ``repeats``, else
    all are.
    """
    found = marked.groupBy(*KEY).agg(F.min("html").alias("html"), F.max("is_new").alias("is_new"), F.count_if(~F.col("is_new")).alias("copies"))
    return found.select(*KEY, F.when(F.col("is_new"), F.col("html")).alias("html"), "is_new", (F.col("copies") - F.col("is_new").cast("long")).alias("repeats"))


def scrape_batch(
    seen: DataFrame, target: str, errors: str, name: str, layout: SiteLayout = DEFAULT_LAYOUT, known: DataFrame | None = None
) -> None:
    """Write one batch of :func:`first_seen`: recipes of new pages, and errors.

    A batch writes below ``batch={name}`` in overwrite mode: when it is run again
    after a failure, with the same state, it replaces what it wrote. Pages in
    ``known(domain, path)`` were stored before the state began.
    """
    arrived = materialize(seen, "arrived")
    marked = materialize(judged(arrived), "batch")
    new, again = marked.where("is_new").select(*KEY, "html"), marked.select(*KEY, "repeats")
    if known is not None:
        again = again.unionByName(new.join(known, KEY, "left_semi").select(*KEY, F.lit(1).cast("long").alias("repeats")))
        new = new.join(known, KEY, "left_anti")
    rows = materialize(scrape(new, layout), "scraped")
    store.to_stored(rows).write.mode("overwrite").parquet(f"{target}/batch={name}")
    copies = again.where("repeats > 0").select(*KEY, F.explode(F.sequence(F.lit(1).cast("long"), "repeats")).alias("copy"))
    bad = store.duplicate_errors(copies).unionByName(scrape_errors(rows))
    bad.write.mode("overwrite").json(f"{errors}/batch={name}")
    discard(arrived, marked, rows)


def start_scrape(
    pages: DataFrame, target: str, errors: str, checkpoint: str, layout: SiteLayout = DEFAULT_LAYOUT
) -> StreamingQuery:
    """Process everything that has arrived, then stop; a restart goes on from there.

    Each (domain, path) is stored once; later copies are logged. The keys seen
    live in the state below ``checkpoint``, on disk in RocksDB unless the session
    names another store. Where the checkpoint is new but recipes are stored, their
    keys are copied beside it once, and no page among them is stored again.
    """
    spark, conf = pages.sparkSession, pages.sparkSession.conf
    before = f"{checkpoint.rstrip('/')}-known"
    if not path_exists(spark, checkpoint) and path_exists(spark, target):
        spark.read.schema(store.STORED_SCHEMA).parquet(target).select(*KEY).distinct().write.mode("overwrite").parquet(before)
    known = spark.read.schema("domain string, path string").parquet(before) if path_exists(spark, before) else None

    def run(batch: DataFrame, number: int) -> None:
        # batch numbers begin again with a new checkpoint, the query's id does not
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        scrape_batch(batch, target, errors, f"{query}-{number}", layout, known)

    if "HDFSBacked" in conf.get(STATE_STORE, "HDFSBacked"):
        conf.set(STATE_STORE, ROCKS)
    return (
        first_seen(pages).writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
