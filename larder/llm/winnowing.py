"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every ``window`` - ``gram`` + 1 consecutive k-grams of a text the one with
the smallest hash is kept as a fingerprint. Two texts that share ``window``
consecutive words share all k-grams of that stretch, hence its smallest, so the
join of fingerprints misses no shared window, while only about two in seven
places of a text take part in it. Each hit is extended to the full windows
around it, which are compared as text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Stages
from larder.operators.normalize import join_hot_apart

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: what separates words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    """What lies between separators, A-Z or not; null has no words."""
    return F.coalesce(F.array_remove(F.split(text, BETWEEN), ""), F.array().cast("array<string>"))


def words(text: Column) -> Column:
    """The words of a text, A-Z as a-z, all characters beyond ASCII being part of words; null has none."""
    plain = F.octet_length(text) == F.length(text)
    return split_words(F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)))


def folded_words(text: Column) -> Column:
    """The same words, letters beyond ASCII in lower case, too: faster, and equal wherever ``words`` is equal.

    No letter becomes a separator, so places are the same.
    """
    return split_words(F.lower(text))


def text_key(text: Column, row: Column) -> Column:
    """Identity of a text: equal texts share it. A null gets one by its row, so that nulls do not meet in one task."""
    return F.when(text.isNull(), F.concat(F.lit("null "), F.xxhash64(row).cast("string"))).otherwise(F.md5(text))


def gram_hashes(words: Column, size: int) -> Column:
    """Hash of the ``size`` words from each place on."""
    def one(at: Column) -> Column:
        return F.xxhash64(*[F.get(words, at + i) for i in range(size)])

    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), one))


def fingerprints(texts: DataFrame, keep: list[str], window: int, gram: int, short: list[int]) -> DataFrame:
    """(keep, place, size, mark): the fingerprints of texts given as words ``w``.

    With ``size`` = ``window``: the smallest k-gram of the windows from ``place``
    on. One is given where it changes, and where the k-gram it came from has left
    the window, so it stands for at most ``window`` - ``gram`` + 1 windows. With a
    size in ``short``: the hash of every run of so many words, since texts of that
    size are windows as a whole.
    """
    wide, n = window - gram + 1, F.size("w")
    grams = [F.struct(F.lit(window).alias("size"), F.when(n >= window, gram_hashes(F.col("w"), gram)).alias("g"))]
    grams += [F.struct(F.lit(m).alias("size"), gram_hashes(F.col("w"), m).alias("g")) for m in short]
    # generators, so that what they give is worked out once and not again in each test on it
    sized = texts.select(*keep, F.inline(F.array(*grams)))
    full = F.col("size") == window
    last = F.size("g") - F.when(full, wide).otherwise(1)
    placed = sized.where("g IS NOT NULL").select(*keep, "size", "g", F.explode(F.sequence(F.lit(0), last)).alias("place"))
    around = F.struct(*[F.get("g", F.col("place") + i - 1).alias(f"g{i}") for i in range(wide + 1)])
    seen = placed.select(*keep, "size", "place", F.inline(F.array(around)))
    first = F.least(*[f"g{i}" for i in range(1, wide + 1)])
    before = F.least(*[f"g{i}" for i in range(wide)])
    new = (F.col("place") == 0) | (first != before) | (F.col("g0") == before)
    return seen.where(~full | new).select(*keep, "place", "size", F.when(full, first).otherwise(F.col("g1")).alias("mark"))


def sieve(marks: DataFrame, bits_a_mark: int = 64, most_bits: int = 27) -> tuple[Column, int]:
    """A bit table of ``marks`` as one array of longs, and the binary logarithm of its bits.

    It has 2**16 to 2**``most_bits`` bits (16 MB), so its size is bounded; with more
    marks it lets more of what is none through, and never stops a mark.
    """
    bits = min(max(math.ceil(math.log2(max(marks.count(), 1) * bits_a_mark)), 16), most_bits)
    place = F.shiftrightunsigned("mark", 64 - bits)
    filled = marks.groupBy(F.shiftright(place, 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))).alias("v"))
    rows = marks.sparkSession.range(1 << (bits - 6)).select(F.col("id").alias("at")).join(filled, "at", "left")
    table = rows.agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("v", F.lit(0).cast("long")).alias("v")))).alias("t"))
    return table.select(F.col("t.v")).scalar(), bits


def passes(mark: str, table: Column, bits: int) -> Column:
    place = F.shiftrightunsigned(mark, 64 - bits)
    word = F.get(table, F.shiftright(place, 6).cast("int"))
    return F.call_function("shiftright", word, place.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1


def covered(spans: Column) -> Column:
    """Words inside at least one of the (place, size) ``spans``, which are sorted."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))

    def add(so_far: Column, span: Column) -> Column:
        end = span["place"] + span["size"]
        fresh = F.greatest(end - F.greatest(span["place"], so_far["reach"]), F.lit(0))
        return F.struct((so_far["n"] + fresh).alias("n"), F.greatest(so_far["reach"], end).alias("reach"))

    return F.aggregate(spans, start, add, lambda end: end["n"])


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = 10, gram: int = 5) -> DataFrame:
    """Which words of ``docs`` lie inside a window of ``window`` words that an item holds, too.

    An item of fewer words, but not none, is one window. Returns one row per row
    of ``docs``: the key, n_words, n_hit (words inside an occurrence), n_items,
    items_sha256 (of the item keys, sorted as strings, joined by commas;
    of the empty string without any) and contaminated (n_hit > 0).

    Null and empty texts have no words. Rows that share a key are rows of their
    own; rows with equal texts are worked out once. Items with equal texts all
    count; an item with a null key marks words but is not listed. Only key and
    text of both tables are read, so other columns cannot clash.

    Texts are read twice, and never shuffled: a fingerprint that passes a bit
    table of the items' fingerprints, whose size is bounded, takes the words of
    its windows along. Joins are planned by the sizes of stored tables; only the
    results of texts that each hold over a thousandth of all hit rows are
    broadcast, fewer than a thousand rows.
    """
    stages = Stages(docs.sparkSession, "winnowing")
    asked = items.select(F.col(item).cast("string").alias("item"), words(F.col(item_text)).alias("w")).where(F.size("w") > 0)
    asked = stages.keep(asked, "items")
    # item lengths below a window: at most window - 1 numbers
    short = sorted(r.n for r in asked.where(F.size("w") < window).select(F.size("w").alias("n")).distinct().collect())
    sized = F.least(F.size("w"), F.lit(window))
    windows = asked.select("item", "w", sized.alias("size"), F.explode(F.sequence(F.lit(0), F.size("w") - sized)).alias("place"))
    windows = stages.keep(
        windows.select("item", F.array_join(F.slice("w", F.col("place") + 1, F.col("size")), " ").alias("words")).distinct(), "windows")
    whole = F.size("w") < window
    coarse = asked.select(F.transform("w", lambda x: F.lower(x)).alias("w"))
    marks = fingerprints(coarse.where(~whole), [], window, gram, []).select("size", "mark")
    for m in short:  # fewer than window
        marks = marks.unionByName(fingerprints(coarse.where(F.size("w") == m), [], window, gram, [m]).select("size", "mark"))
    marks = stages.keep(marks.distinct(), "marks")

    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("t")).select(
        "id", "t", text_key(F.col("t"), F.col("id")).alias("text"))
    cut = rows.where("t IS NOT NULL").select("text", folded_words(F.col("t")).alias("w"), split_words(F.col("t")).alias("raw"))
    table, bits = sieve(marks)
    found = fingerprints(cut, ["text", "raw"], window, gram, short).where(passes("mark", table, bits))
    # the words of all windows a fingerprint stands for travel with the few that pass
    reach = F.col("size") + F.when(F.col("size") == window, window - gram).otherwise(0)
    around = F.transform(F.slice("raw", F.col("place") + 1, reach), lambda w: F.translate(w, UPPER, LOWER))
    hits = found.select("text", "place", "size", "mark", around.alias("w")).join(marks, ["size", "mark"], "left_semi")
    tries = hits.select("text", "place", "size", "w", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("size"))).alias("i"))
    spans = tries.select("text", (F.col("place") + F.col("i")).alias("place"), "size",
                         F.array_join(F.slice("w", F.col("i") + 1, F.col("size")), " ").alias("words"))
    # copies of one text in a task become one before the shuffle
    spans = stages.keep(spans.join(windows, "words", "left_semi").distinct(), "spans")
    words_hit = spans.groupBy("text").agg(covered(F.sort_array(F.collect_set(F.struct("place", "size")))).alias("n_hit"))
    items_hit = (
        spans.select("text", "words").distinct().join(windows.where("item IS NOT NULL"), "words")
        .groupBy("text").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    counted = stages.keep(rows.select("id", "text", F.size(split_words(F.col("t"))).cast("long").alias("n_words")), "counted")
    copies = counted.groupBy("text").agg(F.count(F.lit(1)).alias("_rows"))
    result = stages.keep(words_hit.join(items_hit, "text", "left").join(copies, "text").select(
        "text", F.col("n_hit").cast("long"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("digest"), "_rows"), "result")
    # a text that many rows share is not one task: texts above a thousandth of the hit rows are looked up apart
    joined = join_hot_apart(stages.again(counted), result, "text", ["n_hit", "n_items", "digest"], ["id"])
    n_hit, n_items = (F.coalesce(c, F.lit(0).cast("long")) for c in ("n_hit", "n_items"))
    return joined.select(
        F.col("id").alias(key), "n_words", n_hit.alias("n_hit"), n_items.alias("n_items"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def contamination_sql(docs: str, items: str) -> str:
    """The same result by comparing every window, as CTEs that end in ``contaminated``."""
    def cut(column: str) -> str:
        low = f"translate({column}, '{UPPER}', '{LOWER}')"
        return f"coalesce(regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"

    return f"""
asked AS (SELECT CAST(item_id AS VARCHAR) AS item, {cut("text")} AS w FROM {items}),
spots AS (SELECT item, w, least(len(w), 10) AS size, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS place FROM asked WHERE len(w) > 0),
windows AS MATERIALIZED (SELECT DISTINCT item, size, array_to_string(w[place + 1:place + size], ' ') AS words FROM spots),
sizes AS (SELECT DISTINCT size FROM windows),
numbered AS MATERIALIZED (SELECT row_number() OVER () AS no, doc_id, {cut("text")} AS w FROM {docs}),
tries AS (SELECT no, size, w, unnest(range(0, len(w) - size + 1)) AS place FROM numbered, sizes WHERE len(w) >= size),
found AS MATERIALIZED (
  SELECT t.no, t.place, t.size, x.item FROM
    (SELECT no, place, size, array_to_string(w[place + 1:place + size], ' ') AS words FROM tries) t JOIN windows x ON x.size = t.size AND x.words = t.words),
hit AS (SELECT no, count(DISTINCT spot) AS n FROM (SELECT no, unnest(range(place, place + size)) AS spot FROM found) GROUP BY no),
listed AS (SELECT no, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT no, item FROM found WHERE item IS NOT NULL) GROUP BY no),
contaminated AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(l.n, 0)::BIGINT AS n_items,
         coalesce(l.digest, sha256('')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
  FROM numbered d LEFT JOIN hit h ON h.no = d.no LEFT JOIN listed l ON l.no = d.no)"""
