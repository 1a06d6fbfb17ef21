"""Secret scans: three fixed patterns, and sliding-window Shannon entropy over candidate strings.

A candidate is a run of at least ``WINDOW`` characters of the base64 alphabets. Over it slides a window of ``WINDOW``
characters. The state of a step holds the count of every character, as one text with a character for each count, and the
sum of n·log2(n) over the counts n; a step changes the count of the character that comes and of the one that goes, and the
sum by their differences. The entropy is log2(WINDOW) less that sum over WINDOW. A candidate is a secret when a window
reaches the threshold of its character class. Placeholder words of the allow-list are taken out of the candidate first, so
they silence themselves and not what stands beside them; ids, slugs and names that it allows as a whole are none.

Positions come from the lengths of matches and of what lies between them, added up in order by a window function over
the matches alone. So a text with a million matches is as many short rows, and texts are never shuffled to find spans.
Long candidates are cut into overlapping parts. All is DataFrame functions.

Edge cases: a null or empty text has no spans. Rows that repeat an id are judged by their own texts. Spans are in code
points; those of one kind never overlap. Other columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS = 12
# A greedy run that is long enough; shorter ones could not end elsewhere, so leaving them out skips nothing.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
PART = 200
#: Least entropy, in bits a character, that makes a secret of a candidate: by character class. Chosen by what random keys
#: reach and compounds and names do not; the README has the shares.
THRESHOLDS = {"hex": 3.05, "one_case": 3.68, "letters": 3.75, "mixed": 3.65}
#: Placeholder words, which count for nothing.
PLACEHOLDER = r"(?i)(example|placeholder|xxxxxx|000000|abcdefghij|0123456789)"
#: Candidates that are known to be something else: dashed ids, and paths and slugs, which are letters between separators
#: without a run of ``LONG_WORD``. Names of words that begin with a capital have no two capitals in a row. No pattern
#: repeats a group, so a very long candidate neither deepens the matcher's stack nor makes it go back over the text.
DASHED_ID = r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
SLUG = r"^[A-Za-z/_=-]+$"
LETTER = r"[A-Za-z]"
LONG_WORD = r"[A-Za-z]{20}"
TWO_CAPITALS = r"[A-Z]{2}"
MASK = "[SECRET]"

MATCH = "array<struct<kind:int,k:int,gap:int,size:int,value:string>>"


def _matches(text: Column, kind: int, pattern: str) -> Column:
    """Every match with its number and the length of what lies before it. Arrays are put side by side once and then gone
    through, so that the work grows with the text and not with the text for each match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == 0 else found
    sized = F.zip_with(found, gaps, lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("size")))
    # What follows the last match is a gap without one.
    sized = F.filter(sized, lambda s: s["size"].isNotNull())
    valued = F.zip_with(sized, values, lambda s, v: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), (v if kind in (0, 3) else F.lit(None).cast("string")).alias("value")))
    numbered = F.transform(valued, lambda s, k: F.struct(F.lit(kind).alias("kind"), k.alias("k"), s["gap"].alias("gap"), s["size"].alias("size"), s["value"].alias("value")))
    there = text.rlike(pattern) if kind != 1 else text.contains("AKIA") & text.rlike(pattern)
    return F.when(there, numbered).otherwise(F.array().cast(MATCH))


#: Counts are held as characters from ``ZERO`` on, those of the characters from ``LOWEST`` to ``HIGHEST``.
ZERO, LOWEST, HIGHEST = 32, ord("+"), ord("z")


def entropy(part: Column) -> Column:
    """The largest entropy of a window of a text of a candidate's characters, ``WINDOW`` of them at least."""
    table = F.array(*(F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 2)))

    def f(n: Column) -> Column:
        return F.get(table, n)

    def place(at: Column) -> Column:
        return F.ascii(F.substring(part, at, F.lit(1))) - (LOWEST - 1)

    def held(counts: Column, place: Column) -> Column:
        return F.ascii(F.substring(counts, place, F.lit(1))) - ZERO

    def changed(counts: Column, place: Column, by: int) -> Column:
        return F.overlay(counts, F.char(held(counts, place) + (ZERO + by)), place, F.lit(1))

    def step(state: Column, at: Column) -> Column:
        # First one goes, out of the window before; then one comes to the rest.
        goes, comes, slides = place(at - WINDOW), place(at), at > WINDOW
        before = held(state["counts"], goes)
        rest = F.when(slides, changed(state["counts"], goes, -1)).otherwise(state["counts"])
        more = held(state["counts"], comes) - F.when(slides & (goes == comes), 1).otherwise(0)
        total = state["total"] + F.when(slides, f(before - 1) - f(before)).otherwise(0.0) + f(more + 1) - f(more)
        least = F.when(at >= WINDOW, F.least(state["least"], total)).otherwise(state["least"])
        return F.struct(changed(rest, comes, 1).alias("counts"), total.alias("total"), least.alias("least"))

    nothing = F.lit(chr(ZERO) * (HIGHEST - LOWEST + 1))
    start = F.struct(nothing.alias("counts"), F.lit(0.0).alias("total"), F.lit(1e9).alias("least"))
    ended = F.aggregate(F.sequence(F.lit(1), F.length(part)), start, step)
    return F.lit(math.log2(WINDOW)) - ended["least"] / WINDOW


def class_of(value: Column) -> Column:
    one_case = value.rlike(r"[a-z]") != value.rlike(r"[A-Z]")
    named = F.when(value.rlike(r"^[0-9A-Fa-f]+$"), "hex").when(value.rlike(r"[0-9]") & value.rlike(LETTER), "mixed")
    return named.when(one_case, "one_case").otherwise("letters")


def is_secret(value: Column) -> Column:
    """Whether a window's entropy reaches the threshold of the value's class and the allow-list is silent."""
    own = F.regexp_replace(value, PLACEHOLDER, "")
    kind = class_of(own)
    least = F.coalesce(*(F.when(kind == k, v) for k, v in THRESHOLDS.items()))
    slug = own.rlike(SLUG) & own.rlike(LETTER) & ~own.rlike(LONG_WORD)
    allowed = value.rlike(DASHED_ID) | slug | ((kind == "letters") & own.rlike(LETTER) & ~own.rlike(TWO_CAPITALS))
    starts = F.sequence(F.lit(1), F.length(own) - WINDOW + 1, F.lit(PART))
    parts = F.transform(starts, lambda s: F.substring(own, s, F.lit(PART + WINDOW - 1)))
    return F.when((F.length(own) >= WINDOW) & ~allowed, F.array_max(F.transform(parts, entropy)) >= least).otherwise(False)


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (a struct of id and hash of the text), ``kind`` (number in ``KINDS``), ``first`` and ``end`` of every span."""
    row = F.struct(F.col(key).alias("id"), F.xxhash64(text).alias("of"))
    patterns = (ASSIGN, ACCESS, HEX, CANDIDATE)
    every = F.concat(*(_matches(F.coalesce(F.col(text), F.lit("")), k, p) for k, p in enumerate(patterns)))
    # Rows that are there several times give their matches once.
    rows = docs.select(row.alias("row"), F.explode(every).alias("m")).select("row", "m.*").distinct()
    before = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.select("row", "kind", "size", "value", (F.sum(F.col("gap") + F.col("size")).over(before) - F.col("size")).cast("int").alias("first"))
    placed = placed.select("row", "kind", "value", "first", (F.col("first") + F.col("size")).alias("end"))
    good = F.when(F.col("kind") == 0, F.length("value") >= ASSIGN_CHARS)
    good = good.when(F.col("kind") == 3, is_secret(F.col("value"))).otherwise(True)
    return placed.where(good).select("row", "kind", "first", "end")


def per_document(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` and ``spans``, in order of start and kind, of every text that has some."""
    return spans(docs, key, text).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "kind", "end"))).alias("spans"))


def stretches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row``, ``first`` and ``end`` of every stretch that spans cover together, and ``next``, where the next one begins."""
    order = Window.partitionBy("row").orderBy("first", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached >= F.col("first"), 0).otherwise(1)
    numbered = spans(docs, key, text).select("row", "first", "end", opens.alias("opens"))
    numbered = numbered.withColumn("stretch", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy("row", "stretch").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    return joined.select("row", "first", "end", F.lead("first").over(Window.partitionBy("row").orderBy("first")).alias("next"))


def mask(docs: DataFrame, key: str = "doc_id", text: str = "text", mask: str = MASK, chars: str = "n_chars") -> DataFrame:
    """All documents with their own columns; each stretch of a text that spans cover is replaced by ``mask``."""
    found = stretches(docs, key, text).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "end", "next"))).alias("spans"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    own = F.col(f"doc.`{text}`")
    joined = rows.join(found, F.struct(F.col(f"doc.`{key}`").alias("id"), F.xxhash64(own).alias("of")).eqNullSafe(F.col("row")), "left")

    # Each piece is the mask and what follows it up to the next stretch; the text's begin comes before them.
    pieces = F.transform("spans", lambda s: F.concat(F.lit(mask), F.substring(own, s["end"] + 1, F.coalesce(s["next"], F.length(own)) - s["end"])))
    pieces = F.concat(F.array(F.substring(own, F.lit(1), F.get("spans", F.lit(0))["first"])), pieces)
    hidden = F.when(F.col("spans").isNotNull(), F.array_join(pieces, "")).otherwise(own)
    out = joined.select(*(hidden.alias(text) if c == text else F.col(f"doc.`{c}`") for c in docs.columns))
    return out.withColumn(chars, F.when(F.col(chars).isNotNull(), F.length(text).cast(out.schema[chars].dataType))) if chars in docs.columns else out


def contract(docs: DataFrame) -> DataFrame:
    """The registered query: counts of the three patterns, a checksum of their spans, and all spans."""
    found = per_document(docs)
    names = F.array(*map(F.lit, KINDS))
    row = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("of"))
    every = docs.select("doc_id", row.alias("doc_row")).join(found, F.col("doc_row").eqNullSafe(F.col("row")), "left")
    own = F.coalesce("spans", F.array().cast("array<struct<first:int,kind:int,end:int>>"))

    def joined(which: Column) -> Column:
        return F.array_join(F.transform(which, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["first"], s["end"])), ",")

    def number(kind: int) -> Column:
        return F.size(F.filter(own, lambda s: s["kind"] == kind)).cast("long")

    return every.select(
        "doc_id", *(number(k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(joined(F.filter(own, lambda s: s["kind"] < 3)), 256).alias("base_sha256"), joined(own).alias("spans"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (
    SELECT doc_id, 0 AS kind, string_split_regex(t, $p$((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$p$) AS gaps,
        regexp_extract_all(t, $p$((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$p$, 0) AS found,
        regexp_extract_all(t, $p$((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$p$, 2) AS vals FROM d
    UNION ALL SELECT doc_id, 1, string_split_regex(t, 'AKIA[A-Z0-9]{14,}'), regexp_extract_all(t, 'AKIA[A-Z0-9]{14,}'), regexp_extract_all(t, 'AKIA[A-Z0-9]{14,}') FROM d
    UNION ALL SELECT doc_id, 2, string_split_regex(t, '[0-9a-f]{16,}'), regexp_extract_all(t, '[0-9a-f]{16,}'), regexp_extract_all(t, '[0-9a-f]{16,}') FROM d
    UNION ALL SELECT doc_id, 3, string_split_regex(t, '[A-Za-z0-9+/_=-]{20,}'), regexp_extract_all(t, '[A-Za-z0-9+/_=-]{20,}'), regexp_extract_all(t, '[A-Za-z0-9+/_=-]{20,}') FROM d
), one AS (
    SELECT doc_id, kind, k, vals[k] AS value, length(found[k]) AS size,
        sum(length(gaps[k]) + length(found[k])) OVER (PARTITION BY doc_id, kind ORDER BY k) - length(found[k]) AS first
    FROM m, generate_series(1, len(found)) g(k)
), own AS (
    SELECT doc_id, first, size, value, regexp_replace(value, '(?i)(example|placeholder|xxxxxx|000000|abcdefghij|0123456789)', '', 'g') AS o FROM one WHERE kind = 3
), classed AS (
    SELECT *, CASE WHEN regexp_matches(o, '^[0-9A-Fa-f]+$') THEN 'hex' WHEN regexp_matches(o, '[0-9]') AND regexp_matches(o, '[A-Za-z]') THEN 'mixed'
        WHEN regexp_matches(o, '[a-z]') <> regexp_matches(o, '[A-Z]') THEN 'one_case' ELSE 'letters' END AS class
    FROM own
    WHERE length(o) >= 20 AND NOT regexp_matches(value, '^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$')
        AND NOT (regexp_matches(o, '^[A-Za-z/_=-]+$') AND regexp_matches(o, '[A-Za-z]') AND NOT regexp_matches(o, '[A-Za-z]{20}'))
), high AS (
    SELECT doc_id, first, size FROM classed
    WHERE NOT (class = 'letters' AND regexp_matches(o, '[A-Za-z]') AND NOT regexp_matches(o, '[A-Z]{2}'))
        AND list_max(list_transform(generate_series(1, length(o) - 19), lambda p: list_aggregate(string_split(substr(o, p, 20), ''), 'entropy')))
            >= CASE class WHEN 'hex' THEN 3.05 WHEN 'one_case' THEN 3.68 WHEN 'letters' THEN 3.75 ELSE 3.65 END
), spans AS (
    SELECT doc_id, kind, first, first + size AS last FROM one WHERE kind IN (1, 2) OR (kind = 0 AND length(value) >= 12)
    UNION ALL SELECT doc_id, 3, first, first + size FROM high
), named AS (
    SELECT *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || CAST(first AS BIGINT) || ':' || CAST(last AS BIGINT) AS name FROM spans
), per AS (
    SELECT doc_id, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS c, count(*) FILTER (kind = 2) AS h,
        string_agg(name, ',' ORDER BY first, kind) FILTER (kind < 3) AS base, string_agg(name, ',' ORDER BY first, kind) AS every
    FROM named GROUP BY doc_id
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN per USING (doc_id)
"""
