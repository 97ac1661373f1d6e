"""URL filter against dated lists: a temporal as-of join with built-in functions only.

List edits become validity intervals; each capture is judged by the intervals that
hold at its fetch time, for its host and every parent domain. Time is cut into
spans, so that a key with a third of all rows is many window groups: a group is one
key in one span, and only one row per key and span meets in a group of its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import query, table

SPAN_SECONDS = 3600
# Fixed value: scheme, optional user part, host.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The lower-case host of a URL; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def domains_of(host: Column) -> Column:
    """The host and its parent domains of two labels or more (the host itself if it has one label)."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    starts = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, n), "."))


def _span(at: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(at) / F.lit(seconds * 1_000_000)).cast("long")


def validity_intervals(edits: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """``key, valid_from, valid_to`` from edits ``key, at, listed``.

    Of edits of one key at one instant a listing wins. An edit that leaves the state
    as it is opens no interval; an open interval has a null ``valid_to``. Edits with a
    null key, instant or state count for nothing.
    """
    clean = edits.filter("key IS NOT NULL AND at IS NOT NULL AND listed IS NOT NULL")
    one = (clean.groupBy("key", "at").agg(F.max("listed").alias("listed"))
           .withColumn("span", _span(F.col("at"), span_seconds)))
    per_span = one.groupBy("key", "span").agg(F.max_by("listed", "at").alias("last"))
    by_key = Window.partitionBy("key").orderBy("span")
    carried = per_span.select("key", "span", F.lag("last").over(by_key).alias("before"))
    inside = Window.partitionBy("key", "span").orderBy("at")
    was = F.coalesce(F.lag("listed").over(inside), F.col("before"), F.lit(False))
    turns = (one.join(carried, ["key", "span"]).withColumn("was", was)
             .filter("listed != was").select("key", "span", "at", "listed"))
    # The next turn of a listing is its end: within the span, or the first turn of a later one.
    first = turns.groupBy("key", "span").agg(F.min("at").alias("first"))
    later = first.select("key", "span", F.lead("first").over(by_key).alias("later"))
    to = F.coalesce(F.lead("at").over(inside), F.col("later"))
    return (turns.join(later, ["key", "span"]).withColumn("valid_to", to).filter("listed")
            .select("key", F.col("at").alias("valid_from"), "valid_to"))


def active_at(points: DataFrame, intervals: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """``key, at, valid_from`` of the interval that holds at each distinct point ``key, at``;
    points in no interval give no row. As-of join: the last interval opened by then."""
    opened = intervals.select(
        "key", F.col("valid_from").alias("at"), F.lit(False).alias("asked"),
        F.struct("valid_from", "valid_to").alias("interval"))
    asked = points.select("key", "at").distinct().select(
        "key", "at", F.lit(True).alias("asked"), F.lit(None).cast(opened.schema["interval"].dataType).alias("interval"))
    both = opened.unionByName(asked).withColumn("span", _span(F.col("at"), span_seconds))
    spans = both.groupBy("key", "span").agg(F.max("interval").alias("last"))
    past = Window.partitionBy("key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("key", "span", F.last("last", ignorenulls=True).over(past).alias("before"))
    upto = Window.partitionBy("key", "span").orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, 0)
    held = (both.join(carried, ["key", "span"])
            .withColumn("held", F.coalesce(F.last("interval", ignorenulls=True).over(upto), F.col("before"))))
    return held.filter(
        F.col("asked") & F.col("held").isNotNull()
        & (F.col("held.valid_to").isNull() | (F.col("at") < F.col("held.valid_to")))
    ).select("key", "at", F.col("held.valid_from").alias("valid_from"))


def judge_captures(captures: DataFrame, edits: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """``page_id, url, host, fetched_at, n_entries, entry, listed_since, blocked``, a row per capture.

    ``captures`` has ``page_id, url, fetched_at``, ``edits`` has ``key`` (a domain, compared
    in lower case), ``at`` and ``listed``; further columns are not read. ``n_entries`` counts
    the entries that hold at the fetch time for the host or a parent domain, ``entry`` is the
    most specific. Captures without host or fetch time match nothing and are not blocked;
    repeated captures are judged alike; an empty list blocks nothing.
    """
    rows = captures.select("page_id", "url", host_of(F.col("url")).alias("host"), "fetched_at")
    moments = rows.filter("host IS NOT NULL AND fetched_at IS NOT NULL").select("host", "fetched_at").distinct()
    wanted = moments.select("host", F.col("fetched_at").alias("at"), F.explode(domains_of(F.col("host"))).alias("key"))
    intervals = validity_intervals(
        edits.select(F.lower("key").alias("key"), "at", "listed"), span_seconds)
    active = active_at(wanted, intervals, span_seconds)
    found = (wanted.join(active, ["key", "at"])
             .groupBy("host", "at").agg(
                 F.count("*").alias("n_entries"),
                 F.max_by(F.struct("key", "valid_from"), F.length("key")).alias("best")))
    return (rows.join(found.withColumnRenamed("host", "_host"),
                      (F.col("host") == F.col("_host")) & (F.col("fetched_at") == F.col("at")), "left")
            .select("page_id", "url", "host", "fetched_at",
                    F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
                    F.col("best.key").alias("entry"), F.col("best.valid_from").alias("listed_since"),
                    F.col("n_entries").isNotNull().alias("blocked")))


# The pages carry no fetch time and there is no dated list among the tables. Both are
# derived: a page is fetched at a second of 60 days that its id gives, and an event edits
# the list, at its time, for the host, or its parent domain, of the page with its user id.
FETCH_SECONDS = 60 * 86_400
FIRST_DAY = "2024-01-01 00:00:00"
LISTING = ("error", "signup")


def derived_captures(pages: DataFrame) -> DataFrame:
    seconds = F.pmod(F.col("page_id") * 7919, F.lit(FETCH_SECONDS))
    at = F.timestamp_micros(F.unix_micros(F.lit(FIRST_DAY).cast("timestamp")) + seconds * 1_000_000)
    return pages.select("page_id", "url", at.alias("fetched_at"))


def derived_edits(pages: DataFrame, events: DataFrame) -> DataFrame:
    hosts = pages.select("page_id", host_of(F.col("url")).alias("host"))
    parent = F.regexp_replace("host", r"^[^.]*\.", "")
    key = F.when(F.pmod("event_id", F.lit(5)) == 0, parent).otherwise(F.col("host"))
    return (events.select("event_id", "ts", "user_id", "event_type")
            .join(hosts, F.col("user_id") == F.col("page_id"))
            .select(key.alias("key"), F.col("ts").cast("timestamp").alias("at"),
                    F.col("event_type").isin(*LISTING).alias("listed")))


ORACLE = rf"""
WITH hosts AS (
  SELECT page_id, url, nullif(lower(regexp_extract(url, '{HOST}', 1)), '') AS host,
         TIMESTAMP '{FIRST_DAY}' + to_seconds(((page_id * 7919) % {FETCH_SECONDS})::BIGINT) AS fetched_at
  FROM pages),
edits AS (
  SELECT lower(CASE WHEN event_id % 5 = 0 THEN regexp_replace(host, '^[^.]*\.', '') ELSE host END) AS key,
         ts::TIMESTAMP AS stamp, max((event_type IN {LISTING})::INT) AS listed
  FROM events JOIN hosts ON user_id = page_id
  WHERE host IS NOT NULL GROUP BY 1, 2),
turns AS (
  SELECT * FROM (SELECT *, lag(listed, 1, 0) OVER (PARTITION BY key ORDER BY stamp) AS was FROM edits)
  WHERE listed <> was),
intervals AS (
  SELECT * FROM (SELECT key, stamp AS valid_from, lead(stamp) OVER (PARTITION BY key ORDER BY stamp) AS valid_to, listed
                 FROM turns) WHERE listed = 1),
wanted AS (
  SELECT page_id, fetched_at, unnest(list_transform(range(1, greatest(len(l) - 1, 1) + 1), lambda i: array_to_string(l[i:], '.'))) AS key
  FROM (SELECT *, string_split(host, '.') AS l FROM hosts WHERE host IS NOT NULL)),
found AS (
  SELECT page_id, count(*) AS n_entries, arg_max(key, length(key)) AS entry,
         arg_max(valid_from, length(key)) AS listed_since
  FROM wanted JOIN intervals USING (key)
  WHERE valid_from <= fetched_at AND (valid_to IS NULL OR fetched_at < valid_to) GROUP BY page_id)
SELECT page_id, url, host, fetched_at, coalesce(n_entries, 0) AS n_entries, entry, listed_since,
       n_entries IS NOT NULL AS blocked
FROM hosts LEFT JOIN found USING (page_id)
"""


@query("op8_url_lists", ORACLE)
def op8_url_lists(spark, sf):
    pages, events = table(spark, sf, "pages"), table(spark, sf, "events")
    return judge_captures(derived_captures(pages), derived_edits(pages, events))
