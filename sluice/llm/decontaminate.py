"""Benchmark decontamination by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of a benchmark item, or a shorter item as a whole. A document that holds a window
holds all its words, so in any order of the words the first one is a necessary prefix, and with the rarest first it is
the best to join on. The steps, all of DataFrame functions:

1. The documents' words meet those of the benchmark; how often each occurs over all documents is its rarity. A window with
   a word that no document has is done with.
2. The rarest word of each window, with its place in the window, is the join key. Documents are cut into blocks of words
   with an overlap, so that no row is longer for a longer text, and their words meet the keys. What is found must lie so
   that the whole window fits into the text (length and position), and is compared word for word with the words around
   it, which the block carries along.
3. Hits of a document are merged to the words that they cover, and windows to the items that have them.

The benchmark's tables go to all tasks when they have at most ``BROADCAST_BYTES``; beyond that words meet them by a shuffle
of word hashes and places alone, and only what meets is joined with its block. Texts are not shuffled otherwise, only hits
are, by document; and the same passage in a third of all documents spreads as these do.

Edge cases: a null or empty text has no words and no hits, and an item without words has no window. An empty benchmark
leaves everything clean. Rows that repeat an id are judged by their own texts, equal ones alike. Items that repeat an id
are one item with the windows of all. A null item id is an empty text. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.session import scratch_folder, through_table

WINDOW = 13
BLOCK = 1024
BROADCAST_BYTES = 64 << 20
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What is between words: ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text as they stand; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")


def folded(words: Column) -> Column:
    """Words as one text with A-Z as small letters; equal texts are equal words, as none holds a space."""
    return F.translate(F.array_join(words, " "), CAPITALS, SMALL)


def _key(word: Column) -> Column:
    """What words are joined by: a hash in small letters, whatever the letter. It may bring together too much, never too
    little; words are compared as they stand later."""
    return F.xxhash64(F.lower(word))


def _sized(df: DataFrame, label: str) -> tuple[DataFrame, bool]:
    """The stored table, for broadcast where it is small enough, and whether it is."""
    stored = through_table(df, scratch_folder(df.sparkSession, label))
    width = sum((F.octet_length(c) if kind == "string" else F.lit(16) for c, kind in stored.dtypes), F.lit(32))
    small = (stored.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES
    return (F.broadcast(stored) if small else stored), small


def windows(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item`` and ``words`` of every different window of every item."""
    folded_text = F.translate(F.col(text), CAPITALS, SMALL)
    words = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words_of(folded_text).alias("all"))
    size = F.size("all")
    starts = F.sequence(F.lit(0), F.greatest(size - WINDOW, F.lit(0)), F.lit(BLOCK))
    blocks = words.where(size > 0).select("item", F.explode(F.transform(starts, lambda s: F.slice("all", s + 1, BLOCK + WINDOW - 1))).alias("block"))
    places = F.sequence(F.lit(1), F.greatest(F.size("block") - WINDOW + 1, F.lit(1)))
    return blocks.select("item", F.explode(F.transform(places, lambda p: F.slice("block", p, WINDOW))).alias("words")).distinct()


def _blocks(rows: DataFrame) -> DataFrame:
    """``row``, ``number`` and ``block`` (words as they stand), ``before`` (words in it that are the end of the block before
    it) and ``begin`` (place in the text of its first word)."""
    # Empty words, which only a text's ends can have, are in no window.
    whole = rows.select("row", F.split(F.coalesce("text", F.lit("")), BETWEEN).alias("words"))
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(BLOCK))

    def cut(own: Column) -> Column:
        before = F.least(own, F.lit(WINDOW - 1))
        return F.struct(before.alias("before"), (own - before).alias("begin"), F.slice("words", own - before + 1, before + BLOCK + WINDOW - 1).alias("block"))

    return whole.select("row", F.posexplode(F.transform(starts, cut)).alias("number", "b")).select("row", "number", "b.before", "b.begin", "b.block")


def _row(key: str, text: str) -> Column:
    """Rows with the same id and text have the same result, so these two are what a row is known by."""
    return F.struct(F.col(key).alias("id"), F.xxhash64(text).alias("of"))


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id") -> DataFrame:
    """One row per document: key, ``n_words``, ``n_hit`` (words inside a window), ``items`` (sorted ids)."""
    return _judged(docs, items, key, text, item_key).drop("judged_row")


def _judged(docs: DataFrame, items: DataFrame, key: str, text: str, item_key: str) -> DataFrame:
    """As ``contaminated``, with the row that it holds for as ``judged_row``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), _row(key, text).alias("row"), F.col(text).alias("text"))

    every = windows(items, item_key).groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    listed = through_table(every.select(F.xxhash64("words").alias("window"), "words", "items"), scratch_folder(spark, "windows"))
    parts = through_table(listed.select("window", F.posexplode("words").alias("inside", "word")).withColumn("word", _key(F.col("word"))), scratch_folder(spark, "parts"))
    wanted, _ = _sized(parts.select("word").distinct(), "wanted")
    met = rows.select(F.explode(F.split(F.col("text"), BETWEEN)).alias("word")).select(_key(F.col("word")).alias("word"))
    counted = met.join(wanted, "word").groupBy("word").agg(F.count("*").alias("times"))
    rarest = (
        parts.join(counted, "word", "left")
        .groupBy("window")
        .agg(F.min_by(F.struct("inside", "word"), F.struct("times", "inside")).alias("p"), F.count_if(F.col("times").isNull()).alias("missing"))
        .where("missing = 0")
        .join(listed.select("window", folded(F.col("words")).alias("wanted"), F.size("words").alias("length")), "window")
        .select("window", "p.*", "wanted", "length")
    )
    prefixes, small = _sized(rarest, "prefixes")

    blocks = _blocks(rows)
    spread = blocks.select("row", "number", "before", "begin", "block", F.posexplode("block").alias("at", "found"))
    own = (F.col("at") >= F.col("before")) & (F.col("at") < F.col("before") + BLOCK)
    spread = spread.where(own).withColumn("word", _key(F.col("found")))
    if small:
        candidates = spread.join(prefixes, "word")
    else:
        met = spread.select("row", "number", "at", "word").join(prefixes, "word").withColumnsRenamed({"row": "met_row", "number": "met_number"})
        candidates = met.join(blocks, F.col("row").eqNullSafe(F.col("met_row")) & (F.col("number") == F.col("met_number")))
    place = F.col("at") - F.col("inside")
    fits = (place >= 0) & (place + F.col("length") <= F.size("block"))
    same = F.when(fits, folded(F.slice("block", place + 1, F.col("length"))) == F.col("wanted"))
    first = F.col("begin") + place
    hits = candidates.where(same).select("row", first.alias("first"), (first + F.col("length")).alias("end"), "window").distinct()
    hits = through_table(hits, scratch_folder(spark, "hits"))

    before = Window.partitionBy("row").orderBy("first", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.coalesce(F.max("end").over(before), F.lit(0)), F.col("first"))
    covered = hits.select("row", F.greatest(F.col("end") - reached, F.lit(0)).alias("more")).groupBy("row").agg(F.sum("more").alias("n_hit"))
    holders, _ = _sized(listed.select("window", F.explode("items").alias("item")), "holders")
    found = hits.select("row", "window").distinct().join(holders, "window").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    result = covered.join(found, covered["row"].eqNullSafe(found["row"])).select(covered["row"].alias("hit_row"), "n_hit", "items")
    sized = rows.select("key", "row", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    return sized.join(result, F.col("row").eqNullSafe(F.col("hit_row")), "left").select(
        F.col("row").alias("judged_row"), F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def is_contaminated() -> Column:
    """A twentieth of the words."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def keep(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns. Rows that share an id, or have none, are kept or go
    each by its own text."""
    judged = _judged(docs, items, "doc_id", "text", "item_id").where(is_contaminated()).select("judged_row").distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    return rows.join(judged, _row("doc.doc_id", "doc.text").eqNullSafe(F.col("judged_row")), "left_anti").select("doc.*")


def contract(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The registered query: hits, items and verdict of every document."""
    return contaminated(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
    SELECT DISTINCT item, array_to_string(w[p : p + 12], ' ') AS win, least(len(w), 13) AS n
    FROM b, generate_series(1, greatest(len(w) - 12, 1)) g(p) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
    SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS win FROM d, sizes, generate_series(1, len(w) - n + 1) g(p)
), hit AS (
    SELECT DISTINCT dw.doc_id, dw.p, dw.n, bw.item FROM dw JOIN bw USING (n, win)
), covered AS (
    SELECT doc_id, count(DISTINCT p + k) AS n_hit FROM hit, generate_series(0, n - 1) g(k) GROUP BY doc_id
), held AS (
    SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN held USING (doc_id)
"""
