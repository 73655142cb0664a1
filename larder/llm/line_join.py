"""Line deduplication by an exact set-similarity join.

Lines are sets of words. The words of a line are ordered by rarity; two sets
with Jaccard similarity t must share one of their first n - ceil(t n) + 1 words,
their sizes must be close, and the place of the shared word bounds what they can
still have in common. Pairs that pass are verified, and a line is removed if any
earlier line, in the order of (key, line number), has similarity t or more.
Columns and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Stages, fresh, without

CUT = r"[^\p{L}\p{N}]+"
WORD = r"[\p{L}\p{N}]"
SLOTS = 1 << 20  # word counts are kept by hash slot
SLOT_BLOCK = 1 << 12
PASSES = 4  # shared words are looked for in so many turns, so that only a part of the entries is on disk at once


def words_of(line: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(line), CUT), "")


def slot(h: Column) -> Column:
    return h.bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def rarity(docs: DataFrame, text: str, stages: Stages) -> DataFrame:
    """One row, one array: for each hash slot, twice the binary logarithm of how often its words occur, in the high eight bits."""
    counts = docs.select(F.explode(words_of(F.col(text))).alias("w")).groupBy(slot(F.xxhash64("w")).alias("slot")).count()
    every = docs.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("slot")).join(counts, "slot", "left")
    level = F.shiftleft(F.floor(2 * F.log2(F.coalesce("count", F.lit(1)).cast("double"))).cast("long"), 56)
    part = every.groupBy((F.col("slot") / SLOT_BLOCK).cast("int").alias("block")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("slot", level.alias("level")))), lambda x: x["level"]).alias("levels"))
    return stages.keep(part.agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "levels"))), lambda x: x["levels"])).alias("levels")), "rarity")


def coded(line: Column, levels: Column) -> Column:
    """The words of a line as sorted numbers: rarity in the high bits, so rarest first, and 56 bits of hash."""
    hashes = F.array_distinct(F.transform(words_of(line), lambda w: F.xxhash64(w).bitwiseAND(F.lit((1 << 56) - 1))))
    return F.sort_array(F.transform(hashes, lambda h: F.get(levels, slot(h)).bitwiseOR(h)))


def with_codes(lines: DataFrame, keep: list[str], levels: Column) -> DataFrame:
    """``keep`` and ``codes`` of the lines that have words. ``levels``, a scalar, is set beside the
    line first: higher-order functions take no subquery before the optimizer has moved it there."""
    worded = lines.where(F.col("line").rlike(WORD))  # on the text: as a test of the codes it would make them twice
    return worded.select(*keep, "line", levels.alias("levels")).select(*keep, coded(F.col("line"), F.col("levels")).alias("codes"))


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("id"), F.posexplode(F.split(F.col(text), "\n")).alias("no", "line"))


def similar_to_earlier(docs: DataFrame, key: str, text: str, threshold: float, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """(lines, sets): every line with its set, and for every set its first line and whether an earlier set is similar."""
    # one row of a fixed size; as a scalar it is not copied into the row of every line
    levels = rarity(docs, text, stages).scalar()
    codes = with_codes(lines_of(docs, key, text), ["id", "no"], levels)
    # how many of n words an equal-or-better set must share, and how far two sets may differ
    need = F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int")
    # of each word one bit of 128, so that sets of many words, too, differ in more bits than similar ones can
    lines = stages.keep(codes.select(
        "id", "no", F.xxhash64("codes").alias("h1"), F.xxhash64(F.lit(1), "codes").alias("h2"), F.size("codes").alias("n"),
        F.expr("aggregate(codes, 0L, (a, c) -> a ^ shiftleft(~shiftright(c, 6) & 1L, cast(c & 63 AS int)))").alias("low"),
        F.expr("aggregate(codes, 0L, (a, c) -> a ^ shiftleft(shiftright(c, 6) & 1L, cast(c & 63 AS int)))").alias("high"), "codes").select(
        "id", "no", "h1", "h2", "n", "low", "high",
        F.transform(F.slice("codes", 1, F.col("n") - need + 1), lambda c: c.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")).alias("prefix")), "lines")
    sets = stages.keep(lines.groupBy("h1", "h2").agg(
        F.min(F.struct("id", "no")).alias("at"), *[F.any_value(c).alias(c) for c in ("n", "low", "high", "prefix")]), "sets")
    # from here on a line is known by its set only
    full, lines = lines, stages.keep(lines.select("id", "no", "h1", "h2"), "lines")
    stages.drop(full)
    stages.release()
    told = ["at", "n", "low", "high", "place"]
    entries = sets.select(*told[:-1], F.posexplode("prefix").alias("place", "word"))

    def close(a: str, b: str) -> Column:
        """Length, positional and bit filters; ``place`` is where the shared word stands."""
        n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
        share = F.ceil(threshold / (1 + threshold) * (n + m) - 1e-9)
        rest = 1 + F.least(n - F.col(f"{a}.place"), m - F.col(f"{b}.place")) - 1
        differ = sum(F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in ("low", "high"))  # at most the words not shared
        return ((F.least(n, m) >= F.ceil(F.lit(threshold) * F.greatest(n, m) - 1e-9))
                & (F.least(F.col(f"{a}.place"), F.col(f"{b}.place")) + rest >= share) & (differ <= n + m - 2 * share))

    def verified(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) of first lines, the ``a`` that are similar to a ``b``."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("at")).distinct()
        # a sieve of at most 2**20 hash values drops most documents before their lines move
        sieve = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 20))
        some = docs.withColumn("_sieve", sieve(F.col(key))).join(
            F.broadcast(ids.select(sieve(F.col("at.id")).alias("_sieve")).distinct()), "_sieve", "left_semi")
        wanted = ids.select(F.col("at.id").alias("id"), F.col("at.no").alias("no"), "at")
        sources = lines_of(some, key, text).withColumn("_line", F.struct("id", "no"))
        found = sources.join(wanted, sources["id"].eqNullSafe(wanted["id"]) & (sources["no"] == wanted["no"])).select("at", "line")
        found = with_codes(found, ["at"], levels).groupBy("at").agg(F.any_value("codes").alias("codes"))
        found = stages.keep(found, "words")
        both = pairs.join(found.select(F.col("at").alias("a"), F.col("codes").alias("x")), "a").join(
            stages.again(found).select(F.col("at").alias("b"), F.col("codes").alias("y")), "b")
        shared = F.size(F.array_intersect("x", "y"))
        out = stages.keep(both.where(shared >= F.ceil(threshold / (1 + threshold) * (F.size("x") + F.size("y")) - 1e-9))
                          .select(F.col("a").alias("at")).distinct(), "similar")
        stages.drop(pairs, found)
        stages.release()
        return out

    # First the earliest line of each rare word only: it settles most near copies at one comparison each
    first = entries.where("place < 4").select("word", *told)
    leaders = first.groupBy("word").agg(F.min(F.struct(*told)).alias("l"), F.count("*").alias("k")).where("k > 1")
    near = first.alias("a").join(leaders.select("word", "l.*").alias("b"), "word").where((F.col("b.at") < F.col("a.at")) & close("a", "b"))
    settled = verified(stages.keep(near.select(F.col("a.at").alias("a"), F.col("b.at").alias("b")).distinct(), "pairs"))
    # then whatever is left against all earlier lines
    open_ = stages.keep(sets.join(settled.withColumn("settled", F.lit(True)), "at", "left").select(
        "h1", "h2", "at", "n", "low", "high", "prefix", F.col("settled").isNull().alias("open")), "open")
    stages.drop(sets)
    stages.release()
    sets, found = open_, []
    entries = sets.select("open", *told[:-1], F.posexplode("prefix").alias("place", "word"))
    # a test of one side alone would be made below the shuffle, and the sides could not share one
    asks = F.col("a.open") | (F.col("b.open") & (F.col("a.at") == F.col("b.at")))
    for turn in range(PASSES):
        some = entries.where(F.pmod("word", F.lit(PASSES)) == turn)
        near = some.alias("a").join(some.alias("b"), F.col("a.word") == F.col("b.word")).where(
            (F.col("b.at") < F.col("a.at")) & asks & close("a", "b"))
        found.append(stages.keep(near.select(F.col("a.at").alias("a"), F.col("b.at").alias("b")).distinct(), "near"))
        stages.release()
    near = found[0]
    for more in found[1:]:
        near = near.unionByName(more)
    near = stages.keep(near.distinct(), "pairs")
    stages.drop(*found)
    rest = verified(near)
    similar = settled.unionByName(rest).withColumn("similar", F.lit(True))
    judged = stages.keep(sets.select("h1", "h2", "at").join(similar, "at", "left").select(
        "h1", "h2", "at", F.coalesce("similar", F.lit(False)).alias("similar")), "judged")
    stages.drop(sets)
    stages.release()
    return lines, judged


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """``docs`` without the lines that match an earlier line, and with ``n_lines`` and ``n_removed``.

    Lines are cut at "\\n" and match if the Jaccard similarity of their word sets
    is at least ``threshold``, in the same document or across documents; whether
    the earlier line is itself removed plays no part. Lines without words stay.
    A null text stays null, with 0 lines. Keys should be unique; lines of rows that
    share a key and a line number count as one line. Columns named ``n_lines``
    and ``n_removed`` are replaced. Words are compared by 56 bits of their hash.
    """
    stages = Stages(docs.sparkSession, "line-join")
    lines, sets = similar_to_earlier(docs.select(key, text), key, text, threshold, stages)
    out = lines.select("id", "no", "h1", "h2").join(sets, ["h1", "h2"]).where(
        F.col("similar") | (F.col("at.id").isNotNull() & ~F.col("at.id").eqNullSafe(F.col("id"))) | (F.col("at.no") != F.col("no"))
        | (F.col("at.id").isNull() & F.col("id").isNotNull()))
    # the lines of one document: as many as its own text holds
    rest = without(docs, ["n_lines", "n_removed"])
    of, name = fresh(rest, "_of"), fresh(rest, "_cut")
    cut = out.groupBy(F.col("id").alias(of)).agg(F.collect_set("no").alias(name))
    told = rest.join(cut, rest[key].eqNullSafe(cut[of]), "left")
    parts = F.split(F.col(text), "\n")
    gone = F.coalesce(name, F.array().cast("array<int>"))
    kept = F.filter(parts, lambda x, i: ~F.array_contains(gone, i))
    columns = [F.when(F.col(text).isNotNull(), F.array_join(kept, "\n")).alias(text) if c == text else F.col(f"`{c}`") for c in rest.columns]
    return told.select(*columns, F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
                       F.size(gone).cast("long").alias("n_removed"))


def dedup_lines_sql(table: str, threshold: float = 0.8, order: str = "doc_id") -> str:
    """CTEs over ``table`` ending in ``deduped`` (its columns with text rewritten, n_lines, n_removed)."""
    return f"""doc_lines AS MATERIALIZED (
  SELECT {order} AS id, i - 1 AS no, parts[i] AS line FROM (SELECT {order}, string_split(text, chr(10)) AS parts FROM {table}),
    unnest(range(1, len(parts) + 1)) AS r(i)),
line_words AS MATERIALIZED (
  SELECT id, no, list_sort(list_distinct([w for w in string_split_regex(lower(line), '[^\\p{{L}}\\p{{N}}]+') if w <> ''])) AS ws FROM doc_lines),
line_sets AS MATERIALIZED (
  SELECT ws, min(row(id, no)) AS first_at, row_number() OVER () AS k FROM line_words WHERE len(ws) > 0 GROUP BY ws),
word_counts AS MATERIALIZED (SELECT w, count(*) AS df FROM (SELECT unnest(ws) AS w FROM line_sets) GROUP BY w),
set_words AS MATERIALIZED (SELECT k, w, df, row_number() OVER (PARTITION BY k ORDER BY df, w) AS place
  FROM (SELECT k, len(ws) AS n, unnest(ws) AS w FROM line_sets) JOIN word_counts USING (w)),
heads AS MATERIALIZED (SELECT k, w FROM set_words JOIN line_sets USING (k) WHERE place <= len(ws) - ceil({threshold} * len(ws) - 1e-9) + 1),
near_sets AS (
  SELECT DISTINCT a.k AS a, b.k AS b FROM heads a JOIN heads b ON a.w = b.w AND a.k <> b.k),
similar_sets AS MATERIALIZED (
  SELECT DISTINCT x.k FROM near_sets JOIN line_sets x ON near_sets.a = x.k JOIN line_sets y ON near_sets.b = y.k
  WHERE y.first_at < x.first_at AND least(len(x.ws), len(y.ws)) >= {threshold} * greatest(len(x.ws), len(y.ws)) - 1e-9
    AND len(list_intersect(x.ws, y.ws)) >= {threshold} / (1 + {threshold}) * (len(x.ws) + len(y.ws)) - 1e-9),
cut_lines AS MATERIALIZED (
  SELECT id, no FROM line_words JOIN line_sets USING (ws) WHERE first_at <> row(id, no) OR k IN (SELECT k FROM similar_sets)),
kept_lines AS (SELECT id, string_agg(line, chr(10) ORDER BY no) AS kept FROM doc_lines ANTI JOIN cut_lines USING (id, no) GROUP BY id),
line_counts AS (SELECT id, count(*) AS cut FROM cut_lines GROUP BY id),
deduped AS (
  SELECT {table}.* REPLACE (CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text),
    coalesce(len(string_split(text, chr(10))), 0) AS n_lines, coalesce(cut, 0) AS n_removed
  FROM {table} LEFT JOIN kept_lines ON kept_lines.id = {table}.{order} LEFT JOIN line_counts ON line_counts.id = {table}.{order})"""
