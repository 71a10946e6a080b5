"""URL filters as a temporal list join, in DataFrame operations only.

A list is a feed of dated changes, each adding or removing an entry: a host, which covers its subdomains, or a URL
without scheme, query and fragment, which covers what lies below it. Changes become validity intervals [from, until).
A capture with a fetch timestamp is blocked when an entry that covers it is active at that instant; of one that has
only a date, the last change of the day counts. Its host suffixes and path prefixes ask for the state of equal keys as
of that time. Equal questions fold into one; questions and changes are merged in order of time, each stretch of time of
a key apart, with the state carried over from one stretch to the next, so a hot host is split over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from topicloom.llm.shared import key_filter, key_hash, lookup, materialize, maybe_in

FOREVER = "9999-12-31"
_HEAD = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"


def host_of(url: Column) -> Column:
    """Lower case, without user, port and trailing dot; empty if there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), _HEAD + r"([^/?#]*)", 1)
    return F.lower(F.regexp_replace(authority, r"^.*@|:[0-9]*$|\.$", ""))


def segments_of(url: Column) -> Column:
    """The path's parts that aren't empty."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), _HEAD + r"[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda x: x != "")


def _bucket(at: Column, exact: bool) -> Column:
    """The stretch of time that one task sees of a key: an hour of instants, or a month of days."""
    return F.date_trunc("hour" if exact else "month", at)


def _flips(changes: DataFrame, exact: bool) -> DataFrame:
    """(kind, key, bucket, turn, listed): where the state of a key changes. Each stretch of a key is sorted by itself and
    begins with the state carried over from the stretch before, so no task sees all changes of a hot key."""
    turn = F.col("at") if exact else F.to_date("at")
    turns = (
        changes.where("key <> '' and at is not null and listed is not null")
        .groupBy("kind", "key", turn.alias("turn"))
        .agg(F.max(F.struct("at", "listed")).getField("listed").alias("listed"))
        .withColumn("bucket", _bucket(F.col("turn"), exact))
    )
    ends = turns.groupBy("kind", "key", "bucket").agg(F.max_by("listed", "turn").alias("carried"))
    ends = ends.withColumn("carried", F.lag("carried").over(Window.partitionBy("kind", "key").orderBy("bucket")))
    within = Window.partitionBy("kind", "key", "bucket").orderBy("turn")
    carried = turns.join(ends, ["kind", "key", "bucket"])
    before = F.when(F.row_number().over(within) == 1, F.col("carried")).otherwise(F.lag("listed").over(within))
    return carried.withColumn("before", before).where("not (listed <=> before)").select("kind", "key", "bucket", "turn", "listed")


def intervals(changes: DataFrame, exact: bool = False) -> DataFrame:
    """(kind, key, valid_from, valid_until) from (kind, key, at timestamp, listed boolean).

    Changes without key, time or direction are left out; of changes at one instant adding wins. Intervals are of days,
    of which the last change counts, or with `exact` of instants. A key's last interval has no end in sight.
    """
    flips = _flips(changes, exact)
    firsts = flips.groupBy("kind", "key", "bucket").agg(F.min("turn").alias("next"))
    firsts = firsts.withColumn("next", F.lead("next").over(Window.partitionBy("kind", "key").orderBy("bucket")))
    within = Window.partitionBy("kind", "key", "bucket").orderBy("turn")
    spans = flips.join(firsts, ["kind", "key", "bucket"]).withColumn("valid_until", F.coalesce(F.lead("turn").over(within), "next", F.lit(FOREVER).cast(flips.schema["turn"].dataType)))
    return spans.where("listed").select("kind", "key", F.col("turn").alias("valid_from"), "valid_until")


def as_of(asked: DataFrame, changes: DataFrame, exact: bool) -> DataFrame:
    """The rows (kind, key, fetched, n) of `asked` whose key is listed at that time, with valid_from.

    A merge: questions and flips of a stretch of time are sorted together and each question takes the last flip before
    it, or the one carried over from earlier stretches of its key.
    """
    flips = materialize(_flips(changes, exact), "flips")
    state = F.struct("turn", "listed")
    marks = flips.select("kind", "key", "bucket", F.col("turn").alias("at"), F.lit(0).alias("question"), state.alias("state"), F.lit(None).cast("long").alias("n"))
    marks = marks.unionByName(
        asked.select("kind", "key", _bucket(F.col("fetched"), exact).alias("bucket"), F.col("fetched").alias("at"), F.lit(1).alias("question"), F.lit(None).cast(marks.schema["state"].dataType).alias("state"), "n")
    )
    marks = materialize(marks, "marks")
    ends = marks.groupBy("kind", "key", "bucket").agg(F.max("state").alias("carried"))
    earlier = Window.partitionBy("kind", "key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("carried", F.last("carried", ignorenulls=True).over(earlier))
    within = Window.partitionBy("kind", "key", "bucket").orderBy("at", "question")
    last = F.coalesce(F.last("state", ignorenulls=True).over(within), "carried")
    answered = marks.join(ends, ["kind", "key", "bucket"]).withColumn("last", last).where("question = 1 and last.listed")
    return answered.select("kind", "key", F.col("at").alias("fetched"), F.col("last.turn").alias("valid_from"), "n")


def filter_urls(captures: DataFrame, changes: DataFrame, id_col: str = "page_id", url_col: str = "url", date_col: str = "fetch_date") -> DataFrame:
    """Per row of `captures`: id_col, url_col, date_col, n_entries (active entries that cover it), first_entry (the
    least of them as kind:key), since (the earliest valid_from among them), blocked. If date_col is a timestamp, entries
    count as they stand at that instant, else as they stand at the end of that day.

    A URL that is null or has no host, and a capture without date, is covered by nothing; URLs are taken whole, however
    long. Repeated rows are answered each, other columns of `captures` are left out. Empty captures give an empty
    result, an empty list blocks nothing.
    """
    exact = isinstance(captures.schema[date_col].dataType, (TimestampType, TimestampNTZType))
    fetched = F.col(f"`{date_col}`") if exact else F.col(f"`{date_col}`").cast("date")
    if exact:
        changes = changes.withColumn("at", F.col("at").cast(captures.schema[date_col].dataType))
    base = captures.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), fetched.alias("fetched"))
    # Rows are numbered once, in a table: numbers that are drawn again would differ.
    base = materialize(base.withColumn("row", F.monotonically_increasing_id()), "captures")
    parts = base.where("fetched is not null").select("row", "fetched", host_of(F.col("url")).alias("host"), segments_of(F.col("url")).alias("segments"))
    keys = F.expr(
        """concat(
             transform(sequence(1, size(split(host, '[.]'))), i -> struct('host' as kind, substring_index(host, '.', i - 1 - size(split(host, '[.]'))) as key)),
             transform(sequence(0, size(segments)), i -> struct('url' as kind, array_join(concat(array(host), slice(segments, 1, i)), '/') as key)))"""
    )
    probes = parts.where("host <> ''").select("row", "fetched", F.explode(keys).alias("k")).select("row", "fetched", "k.kind", "k.key")
    changes = materialize(changes.select("kind", "key", "at", "listed"), "changes")
    listed = key_filter(materialize(changes.where("listed").select("kind", "key").distinct(), "listed-keys"), key_hash("kind", "key"))
    probes = materialize(maybe_in(probes, key_hash("kind", "key"), listed), "probes")
    # Questions fold before they are shuffled: a hot key has one for each time, not one for each capture.
    asked = probes.groupBy("kind", "key", "fetched").agg(F.count(F.lit(1)).alias("n"))
    answers = materialize(as_of(asked, changes, exact), "answers")
    found = (
        lookup(probes, answers, ["kind", "key", "fetched"], "n", probes.count(), "row")
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("n_entries"), F.min(F.concat_ws(":", "kind", "key")).alias("first_entry"), F.min("valid_from").alias("since"))
    )
    return base.join(found, "row", "left").select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        F.col("fetched").alias(date_col),
        F.coalesce("n_entries", F.lit(0)).alias("n_entries"),
        "first_entry",
        "since",
        F.col("n_entries").isNotNull().alias("blocked"),
    )


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture, fetched page_id * 7919 seconds into thirty days, against a feed made of all events.

    An event speaks of the page numbered as its user: error lists the page's host, signup and purchase unlist it,
    view lists the page's URL and click unlists it.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", "user_id", "event_type")
    captures = pages.withColumn("fetched_at", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, pmod(page_id * 7919, 2592000))"))
    feed = events.join(pages, events.user_id == pages.page_id)
    url_key = F.concat_ws("/", F.array(host_of(F.col("url"))), segments_of(F.col("url")))
    of_host = F.col("event_type").isin("error", "signup", "purchase")
    changes = feed.select(
        F.when(of_host, "host").otherwise("url").alias("kind"),
        F.when(of_host, host_of(F.col("url"))).when(host_of(F.col("url")) != "", url_key).otherwise("").alias("key"),
        F.col("ts").cast("timestamp_ntz").alias("at"),
        F.when(F.col("event_type").isin("error", "view"), True).when(F.col("event_type").isin("signup", "purchase", "click"), False).alias("listed"),
    )
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    out = filter_urls(captures, changes, date_col="fetched_at")
    return out.withColumn("since", shown("since")).withColumn("fetched_at", shown("fetched_at"))


OP3_SQL = r"""
WITH p AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_seconds(page_id * 7919 % 2592000) AS fetched,
    lower(regexp_replace(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1), '^.*@|:[0-9]*$|\.$', '', 'g')) AS host,
    list_filter(string_split(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS seg
  FROM pages),
c AS (
  SELECT CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN 'host' ELSE 'url' END AS kind,
         CASE WHEN host = '' THEN '' WHEN event_type IN ('error', 'signup', 'purchase') THEN host
              ELSE array_to_string(list_concat([host], seg), '/') END AS key,
         ts, CASE WHEN event_type IN ('error', 'view') THEN true WHEN event_type IN ('signup', 'purchase', 'click') THEN false END AS listed
  FROM events JOIN p ON user_id = page_id),
d AS (SELECT kind, key, ts, bool_or(listed) AS listed FROM c WHERE key <> '' AND ts IS NOT NULL AND listed IS NOT NULL GROUP BY ALL),
t AS (SELECT *, lag(listed) OVER (PARTITION BY kind, key ORDER BY ts) AS before FROM d),
i AS (
  SELECT kind, key, ts AS valid_from, coalesce(lead(ts) OVER (PARTITION BY kind, key ORDER BY ts), TIMESTAMP '9999-12-31') AS valid_until, listed
  FROM t WHERE listed IS DISTINCT FROM before),
k AS (
  SELECT page_id, fetched, 'host' AS kind, array_to_string((string_split(host, '.'))[n : ], '.') AS key
  FROM (SELECT page_id, fetched, host, unnest(range(1, len(string_split(host, '.')) + 1)) AS n FROM p WHERE host <> '')
  UNION ALL
  SELECT page_id, fetched, 'url', array_to_string(list_concat([host], seg[1 : n]), '/')
  FROM (SELECT page_id, fetched, host, seg, unnest(range(0, len(seg) + 1)) AS n FROM p WHERE host <> '')),
f AS (
  SELECT page_id, count(*) AS n_entries, min(kind || ':' || key) AS first_entry, min(valid_from) AS since
  FROM k JOIN i USING (kind, key) WHERE listed AND valid_from <= fetched AND fetched < valid_until GROUP BY page_id)
SELECT page_id, url, strftime(fetched, '%Y-%m-%d %H:%M:%S.%f') AS fetched_at, coalesce(n_entries, 0) AS n_entries, first_entry,
       strftime(since, '%Y-%m-%d %H:%M:%S.%f') AS since, n_entries IS NOT NULL AS blocked
FROM p LEFT JOIN f USING (page_id)
"""
