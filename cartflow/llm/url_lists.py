"""URL filters: a temporal join of captures with dated list entries, in built-in expressions only.

Dated additions and removals of list entries become intervals in which an entry is valid. Each capture is judged by the
entries that were valid on the day it was fetched. An entry names a host (and everything below it) or a host with a
first path segment; the longest matching entry decides, and of equally long ones an allowing entry.

Captures are judged once for each host, segment and day. Intervals and captures meet by key and by block of
days, so captures of one hot host spread over the blocks, and each task looks only at intervals near its days.

NULL and malformed URLs have no host and match nothing; a capture without a day matches nothing; entries without key
or day are ignored; of several events of an entry on one day, an addition wins; repeated events and
captures do no harm. An empty list matches nothing. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartflow.llm.common import table

#: Days in a block of the join.
BLOCK_DAYS = 64
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)"


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)), F.lit("."))


def url_segment(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SEGMENT, 1)


def entry_keys(host: Column, segment: Column) -> Column:
    """Keys that would list a capture: the host, the domains above it, and the host with its first segment."""
    labels = F.split(host, r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    paths = F.when(segment != "", F.array(F.concat(host, F.lit("/"), segment))).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.concat(above, paths)).otherwise(F.array().cast("array<string>"))


def validity(events: DataFrame) -> DataFrame:
    """``(list, key, allows, from_day, to_day)`` of events ``(list, key, allows, adds, day)``; ``to_day`` is exclusive or NULL.

    Adjacent intervals of an entry touch and never overlap.
    """
    daily = (
        events.filter("key IS NOT NULL AND day IS NOT NULL")
        .groupBy("list", "key", "day")
        .agg(F.max("adds").alias("adds"), F.max("allows").alias("allows"))
    )
    following = F.lead("day").over(Window.partitionBy("list", "key").orderBy("day"))
    return (
        daily.withColumn("to_day", following)
        .filter("adds")
        .select("list", "key", "allows", F.col("day").alias("from_day"), "to_day")
    )


def judged(captures: DataFrame, intervals: DataFrame, block_days: int = BLOCK_DAYS) -> DataFrame:
    """``captures`` (with ``host``, ``segment``, ``day``) and ``n_block``, ``n_allow``, ``entry_length``, ``verdict``."""
    block = F.floor(F.col("day") / F.lit(block_days))
    probes = captures.select("host", "segment", "day").filter("host <> '' AND day IS NOT NULL").distinct()
    # Open intervals end with the last day of any capture.
    first_day, last_day = probes.agg(F.min("day"), F.max("day")).first()
    first_day, last_day = F.lit(first_day).cast("int"), F.lit(last_day).cast("int")
    bounded = (
        intervals.withColumn("a", F.when(F.col("from_day") < first_day, first_day).otherwise(F.col("from_day")))
        .withColumn("b", F.when(F.col("to_day") <= last_day, F.col("to_day") - 1).otherwise(last_day))
        .filter("a <= b")
    )
    spread = bounded.select(
        "key",
        "allows",
        "from_day",
        "to_day",
        F.explode(F.sequence(F.floor(F.col("a") / F.lit(block_days)), F.floor(F.col("b") / F.lit(block_days)))).alias("block"),
    )
    asked = probes.select("*", block.alias("block"), F.explode(entry_keys(F.col("host"), F.col("segment"))).alias("key"))
    met = asked.join(spread, ["key", "block"]).filter("from_day <= day AND (to_day IS NULL OR day < to_day)")
    # Longer keys first, then allowing entries, in one number.
    rank = F.length("key") * 2 + F.col("allows").cast("int")
    verdicts = met.groupBy("host", "segment", "day").agg(
        F.count_if(~F.col("allows")).alias("n_block"), F.count_if("allows").alias("n_allow"), F.max(rank).alias("rank")
    )
    return captures.join(verdicts, ["host", "segment", "day"], "left").select(
        *[captures[c] for c in captures.columns],
        F.coalesce("n_block", F.lit(0)).alias("n_block"),
        F.coalesce("n_allow", F.lit(0)).alias("n_allow"),
        F.floor(F.coalesce("rank", F.lit(0)) / 2).cast("bigint").alias("entry_length"),
        F.when(F.col("rank").isNull(), "unlisted").when(F.col("rank") % 2 == 1, "allow").otherwise("block").alias("verdict"),
    )


# --- the query: fetch days and list events are derived from the pages ---

DAYS = 730
#: Name, allows, modulus: an entry is on a list if its number is divisible by the modulus.
LISTS = (("threats", False, 3), ("adult", False, 4), ("trusted", True, 5))


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages with host, segment and a fetch day that follows from the page id."""
    return pages.select(
        "page_id",
        url_host(F.col("url")).alias("host"),
        url_segment(F.col("url")).alias("segment"),
        F.pmod(F.col("page_id") * 7919, F.lit(DAYS)).cast("int").alias("day"),
    )


def derived_events(captures: DataFrame) -> DataFrame:
    """Events of entries made of all hosts, the domains above them and their segments.

    An entry's number is taken from the digest of its key. It is added on a day, removed later, and added
    again if the number is even.
    """
    keys = captures.select("host", "segment").distinct()
    keys = keys.select(F.explode(entry_keys(F.col("host"), F.col("segment"))).alias("key")).distinct()
    number = F.conv(F.substring(F.md5(F.col("key").cast("binary")), 1, 6), 16, 10).cast("int")
    day = F.col("n") % 400
    gone = day + 60 + F.col("n") % 97
    again = gone + 30 + F.col("n") % 61
    events = F.array(
        F.struct(F.lit(True).alias("adds"), day.alias("day")),
        F.struct(F.lit(False).alias("adds"), gone.alias("day")),
        F.struct((F.col("n") % 2 == 0).alias("adds"), again.alias("day")),
    )
    lists = F.array(
        *[
            F.struct(F.lit(name).alias("list"), F.lit(allows).alias("allows"), F.lit(modulus).alias("m"))
            for name, allows, modulus in LISTS
        ]
    )
    listed = keys.withColumn("n", number).select("key", "n", F.inline(lists)).filter("n % m = 0")
    return listed.select("list", "key", "allows", F.inline(events))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page by the entries valid on its fetch day."""
    captures = page_captures(table(spark, sf_dir, "pages"))
    found = judged(captures, validity(derived_events(captures)))
    return found.select("page_id", "host", "day", "n_block", "n_allow", "entry_length", "verdict")


def oracle_sql() -> str:
    lists = ", ".join(f"('{name}', {str(allows).lower()}, {m})" for name, allows, m in LISTS)
    return rf"""
WITH capture AS MATERIALIZED (
  SELECT row_number() OVER () AS r, page_id,
         rtrim(lower(regexp_extract(coalesce(url, ''), '{_HOST}', 1)), '.') AS host,
         regexp_extract(coalesce(url, ''), '{_SEGMENT}', 1) AS segment,
         ((page_id * 7919 % {DAYS} + {DAYS}) % {DAYS})::INT AS day
  FROM pages),
keyed AS MATERIALIZED (
  SELECT r, day, unnest(list_concat(
    list_transform(range(1, len(string_split(host, '.')) + 1),
                   lambda i: array_to_string(string_split(host, '.')[i:], '.')),
    CASE WHEN segment <> '' THEN [host || '/' || segment] ELSE [] END)) AS key
  FROM capture WHERE host <> ''),
listed AS (
  SELECT list, key, allows, n
  FROM (SELECT key, ('0x' || substr(md5(key), 1, 6))::INT AS n FROM (SELECT DISTINCT key FROM keyed)),
       (VALUES {lists}) AS l(list, allows, m)
  WHERE n % m = 0),
event AS (
  SELECT list, key, allows, n % 400 AS day, true AS adds FROM listed
  UNION ALL SELECT list, key, allows, n % 400 + 60 + n % 97, false FROM listed
  UNION ALL SELECT list, key, allows, n % 400 + 60 + n % 97 + 30 + n % 61, n % 2 = 0 FROM listed),
met AS (
  SELECT r, k.key, allows
  FROM keyed AS k JOIN event AS e ON e.key = k.key AND e.adds AND e.day <= k.day
  WHERE NOT EXISTS (
    SELECT 1 FROM event AS later
    WHERE later.key = e.key AND later.list = e.list AND later.day > e.day AND later.day <= k.day)),
verdicts AS (
  SELECT r, count(*) FILTER (NOT allows) AS n_block, count(*) FILTER (allows) AS n_allow,
         max(length(key) * 2 + allows::INT) AS rank
  FROM met GROUP BY r)
SELECT page_id, host, day, coalesce(n_block, 0) AS n_block, coalesce(n_allow, 0) AS n_allow,
       coalesce(rank // 2, 0) AS entry_length,
       CASE WHEN rank IS NULL THEN 'unlisted' WHEN rank % 2 = 1 THEN 'allow' ELSE 'block' END AS verdict
FROM capture LEFT JOIN verdicts USING (r)
"""
