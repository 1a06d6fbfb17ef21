"""URL filters by a temporal list join.

A list is a log: on a date, an entry for a host (with its subdomains) or for a host and the first part of a path is set to
``block`` or ``allow``, or removed. Each entry holds from its date until the next of the same pattern. Every capture of
a page is judged by the entries that hold at its fetch time; the most specific pattern decides, and what no entry covers
is allowed.

Intervals are cut at month borders, so that the join's key is pattern and month and its range condition looks at few
intervals, however many a pattern has had. The list goes to all tasks when its stored rows number ``BROADCAST_ROWS`` at
most; a longer one is joined by a shuffle, where a host with a third of all captures is split by the adaptive skew join.
All is DataFrame code.

Edge cases: a capture without a URL, host or time matches nothing and is allowed. Entries without a pattern, date or
action are left out. Of entries of one pattern at the same instant, ``remove`` wins over ``block`` over ``allow``.
Repeated captures are judged each. An empty list allows everything. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.session import scratch_folder, through_table

BROADCAST_ROWS = 1_000_000
# Actions in the order in which they win at the same instant.
REMOVE, BLOCK, ALLOW = "remove", "block", "allow"


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and a final dot; null where there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+?)\.?(?::[0-9]*)?(?:[/?#]|$)", 1)
    return F.when(host != "", host)


def patterns_of(url: Column) -> Column:
    """What an entry may say to match: host with first part of the path, host, and each parent domain; best first."""
    host = host_of(url)
    first = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]+)", 1)
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    return F.when(host.isNotNull(), F.concat(F.when(first != "", F.array(F.concat(host, first))).otherwise(F.array().cast("array<string>")), parents))


def _month(t: Column) -> Column:
    return F.year(t) * 12 + F.month(t)


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern``, ``action``, ``since`` and ``until`` (null: still holds) of a log of ``pattern``, ``action``, ``listed_at``."""
    rank = F.when(F.col("action") == REMOVE, 2).when(F.col("action") == BLOCK, 1).otherwise(0)
    whole = entries.select("pattern", "action", "listed_at").dropna()
    last = whole.groupBy("pattern", "listed_at").agg(F.max_by("action", rank).alias("action"))
    following = Window.partitionBy("pattern").orderBy("listed_at")
    held = last.select("pattern", "action", F.col("listed_at").alias("since"), F.lead("listed_at").over(following).alias("until"))
    return held.where(F.col("action") != REMOVE)


def judge(captures: DataFrame, entries: DataFrame, row: list[str], url: str = "url", at: str = "fetched_at") -> DataFrame:
    """Columns ``row`` of every capture, with ``matched`` pattern, ``action`` and ``kept``. ``row`` identifies captures
    that are to be judged alike."""
    spark = captures.sparkSession
    own = captures.select(*(F.col(c).alias(f"row_{c}") for c in row), F.col(url).alias("url"), F.col(at).alias("at"))
    keys = [f"row_{c}" for c in row]
    last = own.agg(F.max("at").alias("at")).first()["at"]
    held = intervals(entries)
    if last is None:
        held, last = held.where(F.lit(False)), "1970-01-01"
    end = F.least(F.coalesce(F.col("until"), F.lit(last).cast("timestamp_ntz")), F.lit(last).cast("timestamp_ntz"))
    by_month = held.where(F.col("since") <= end).select("pattern", "action", "since", "until", F.explode(F.sequence(_month(F.col("since")), _month(end))).alias("month"))
    stored = through_table(by_month, scratch_folder(spark, "list"))
    if stored.count() <= BROADCAST_ROWS:
        stored = F.broadcast(stored)
    counted = own.groupBy(*keys, "url", "at").agg(F.count("*").alias("times"))
    matching = (
        counted.select("*", F.posexplode_outer(patterns_of(F.col("url"))).alias("place", "wanted"), _month(F.col("at")).alias("in_month"))
        .join(
            stored,
            (F.col("wanted") == F.col("pattern")) & (F.col("in_month") == F.col("month")) & (F.col("since") <= F.col("at")) & (F.col("until").isNull() | (F.col("at") < F.col("until"))),
            "left",
        )
        .groupBy(*keys, "url", "at", "times")
        .agg(F.min_by(F.struct("pattern", "action"), F.when(F.col("pattern").isNotNull(), F.col("place"))).alias("best"))
    )
    return matching.select(
        *(F.col(k).alias(c) for k, c in zip(keys, row, strict=True)), "times",
        F.col("best.pattern").alias("matched"), F.col("best.action").alias("action"), F.coalesce(F.col("best.action") != BLOCK, F.lit(True)).alias("kept"),
    ).select(*row, "matched", "action", "kept", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).drop("copy")


def example_log(pages: DataFrame) -> DataFrame:
    """A dated list made from the hosts of the captures, since the tables have none: every third host is listed at a
    time near its first capture, its parent domain at times, and entries are removed again later."""
    hosts = pages.select("page_id", host_of(F.col("url")).alias("host")).where("host is not null").groupBy("host").agg(F.min("page_id").alias("first"))
    listed = hosts.select("host", "first", (F.length("host") + F.col("first")).alias("turn"))
    kinds = (
        listed.where(F.col("turn") % 3 == 0).select(F.col("host").alias("pattern"), F.lit(BLOCK).alias("action"), capture_time(F.col("first") + 2).alias("listed_at"))
        .unionByName(listed.where(F.col("turn") % 6 == 0).select(F.col("host").alias("pattern"), F.lit(REMOVE).alias("action"), capture_time(F.col("first") * 2 + 40).alias("listed_at")))
        .unionByName(
            listed.where((F.col("turn") % 4 == 1) & F.col("host").contains(".")).select(
                F.substring_index("host", ".", -2).alias("pattern"), F.when(F.col("turn") % 8 == 1, BLOCK).otherwise(ALLOW).alias("action"), capture_time(F.col("first") * 3 + 7).alias("listed_at")
            )
        )
    )
    return kinds


def capture_time(page_id: Column) -> Column:
    """Fetch times for captures, since the table has none: five hours apart in the order of their ids, over three years."""
    return F.expr("timestamp_ntz'2023-01-01 00:00:00'") + F.make_dt_interval(hours=(page_id * 5 % 26280).cast("int"))


def contract(pages: DataFrame) -> DataFrame:
    """The registered query: every capture against the list that its hosts give."""
    captures = pages.select("page_id", "url", capture_time(F.col("page_id")).alias("fetched_at"))
    return judge(captures, example_log(pages), ["page_id", "url", "fetched_at"])


ORACLE = r"""
WITH captures AS (
    SELECT page_id, url, TIMESTAMP '2023-01-01' + INTERVAL 1 HOUR * (page_id * 5 % 26280) AS fetched_at,
        nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+?)\.?(?::[0-9]*)?(?:[/?#]|$)', 1), '') AS host,
        regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]+)', 1) AS part
    FROM pages
), hosts AS (
    SELECT host, first, length(host) + first AS turn FROM (SELECT host, min(page_id) AS first FROM captures WHERE host IS NOT NULL GROUP BY host)
), log AS (
    SELECT host AS pattern, 'block' AS action, (first + 2) AS n FROM hosts WHERE turn % 3 = 0
    UNION ALL SELECT host, 'remove', first * 2 + 40 FROM hosts WHERE turn % 6 = 0
    UNION ALL SELECT array_to_string(list_slice(string_split(host, '.'), greatest(len(string_split(host, '.')) - 1, 1), len(string_split(host, '.'))), '.'), CASE WHEN turn % 8 = 1 THEN 'block' ELSE 'allow' END, first * 3 + 7
        FROM hosts WHERE turn % 4 = 1 AND contains(host, '.')
), dated AS (
    SELECT pattern, action, TIMESTAMP '2023-01-01' + INTERVAL 1 HOUR * (n * 5 % 26280) AS since FROM log
), once AS (
    SELECT pattern, since, CASE max(CASE action WHEN 'remove' THEN 2 WHEN 'block' THEN 1 ELSE 0 END) WHEN 2 THEN 'remove' WHEN 1 THEN 'block' ELSE 'allow' END AS action
    FROM dated GROUP BY pattern, since
), held AS (
    SELECT *, lead(since) OVER (PARTITION BY pattern ORDER BY since) AS until FROM once
), wanted AS (
    SELECT page_id, url, fetched_at, 0 AS place, host || part AS pattern FROM captures WHERE host IS NOT NULL AND part <> ''
    UNION ALL
    SELECT page_id, url, fetched_at, k, array_to_string(list_slice(string_split(host, '.'), k, len(string_split(host, '.'))), '.')
    FROM captures, generate_series(1, len(string_split(host, '.'))) g(k) WHERE host IS NOT NULL
), best AS (
    SELECT w.page_id, min_by(h.pattern, w.place) AS matched, min_by(h.action, w.place) AS action
    FROM wanted w JOIN held h ON w.pattern = h.pattern AND h.action <> 'remove' AND h.since <= w.fetched_at AND (h.until IS NULL OR w.fetched_at < h.until)
    GROUP BY w.page_id
)
SELECT c.page_id, c.url, c.fetched_at, b.matched, b.action, coalesce(b.action <> 'block', true) AS kept
FROM captures c LEFT JOIN best b USING (page_id)
"""
