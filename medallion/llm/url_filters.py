"""URL filters by a temporal list join. DataFrame functions only.

A list is a table of dated entries (pattern, list, listed_at, action): a host suffix
("example.com" covers its sub-domains) or a host and a path prefix ("example.com/shop"),
put on ("add") or taken off ("remove") at a time. Entries of one pattern and list become validity
intervals [valid_from, valid_to): an add holds until the next entry. Every capture meets, in
an as-of join, the intervals of its own keys that hold its fetch time; the most specific pattern
decides (path before host, longer before shorter; on a tie "allow" wins). No active entry: the capture stays.

A capture has as many keys as its host has labels and its path has segments, and the intervals of
one pattern and list do not overlap, so the join's result is linear in the captures. Both
join sides are plain shuffles of staged rows, so a host with a third of all captures is split by the
skew-join rule. Captures with a null or host-less URL or no fetch time match nothing and stay. Of
entries with the same pattern, list and time, "remove" counts. Repeated captures are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import col, keyed, read_table, stage

URL_HEAD = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; empty if there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), URL_HEAD, 1))
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL_HEAD + r"([^?#]*)", 2)


def keys_of(url: Column) -> Column:
    """All patterns that cover a URL: host suffixes, and the host with each prefix of the path."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(path_of(url), "/"), lambda x: x != "")
    suffixes = F.transform(labels, lambda x, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    prefixes = F.transform(segments, lambda x, i: F.concat_ws("/", host, F.array_join(F.slice(segments, F.lit(1), i + 1), "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.concat(suffixes, prefixes))


def validity(entries: DataFrame) -> DataFrame:
    """pattern, list, valid_from, valid_to (null: open) of dated entries."""
    at_once = entries.groupBy("pattern", "list", "listed_at").agg(F.min((F.col("action") == "add").cast("int")).alias("on"))
    following = Window.partitionBy("pattern", "list").orderBy("listed_at")
    rows = at_once.filter(F.col("listed_at").isNotNull()).withColumn("valid_to", F.lead("listed_at").over(following))
    return rows.filter("on = 1").select("pattern", "list", F.col("listed_at").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, entries: DataFrame, url: str, fetched_at: str, rid: str) -> DataFrame:
    """rid, n_active, pattern, list, valid_from of the deciding entry; only captures with an active entry."""
    held = stage(validity(entries), "validity").withColumnRenamed("pattern", "key")
    rows = captures.select(col(rid).alias("rid"), col(fetched_at).alias("at"), F.explode(keys_of(col(url))).alias("key"))
    active = rows.join(held, "key").filter((F.col("valid_from") <= F.col("at")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to"))))
    rank = F.struct(F.col("key").contains("/").alias("a"), F.length("key").alias("b"), (F.col("list") == "allow").alias("c"), F.col("key"), F.col("list"), F.col("valid_from"))
    found = active.groupBy("rid").agg(F.count(F.lit(1)).alias("n_active"), F.max(rank).alias("r"))
    return found.select("rid", "n_active", F.col("r.key").alias("pattern"), F.col("r.list").alias("list"), F.col("r.valid_from").alias("valid_from"))


def filter_captures(captures: DataFrame, entries: DataFrame, url: str, fetched_at: str) -> DataFrame:
    """The captures that stay, all columns. ``captures`` must be a file scan (see ``keyed``)."""
    rows, rid = keyed(captures)
    gone = judge(rows, entries, url, fetched_at, rid).filter("list = 'block'").select(F.col("rid").alias(rid))
    return rows.join(gone, rid, "left_anti").select(*[col(c) for c in captures.columns])


def _number(pattern: Column) -> Column:
    return F.conv(F.substring(F.md5(pattern.cast("binary")), 1, 4), 16, 10).cast("int")


def sample_entries(pages: DataFrame) -> DataFrame:
    """The test tables hold no list, so a dated one is derived from the pages' hosts, domains and first path segments."""
    url = F.col("url")
    host = host_of(url)
    labels = F.split(host, r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
    first = F.regexp_extract(path_of(url), "^/+([^/]+)", 1)
    patterns = pages.filter(host != "").select(F.explode(F.array(domain, host, F.when(first != "", F.concat_ws("/", host, first)))).alias("pattern")).filter("pattern is not null").distinct()
    rows = patterns.withColumn("n", _number(F.col("pattern"))).filter("n % 3 = 0")
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(n % 300)")
    stop = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(n % 300 + 1 + n % 90)")
    again = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(n % 300 + 31 + n % 90)")
    acts = F.array(
        F.struct(start.alias("listed_at"), F.lit("add").alias("action")),
        F.struct(stop.alias("listed_at"), F.lit("remove").alias("action")),
        F.struct(F.when(F.col("n") % 2 == 0, again).alias("listed_at"), F.lit("add").alias("action")),
    )
    return rows.select("pattern", F.when(F.col("n") % 5 == 0, "allow").otherwise("block").alias("list"), F.inline(acts)).filter("listed_at is not null")


def op6_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(pmod(page_id * 7919, 525600) as int))")
    captures, rid = keyed(pages.withColumn("fetched_at", fetched))
    found = judge(captures, sample_entries(pages), "url", "fetched_at", rid).withColumnRenamed("rid", "frid")
    rows = captures.join(found, captures[rid] == found["frid"], "left")
    return rows.select(
        "page_id", "url", "fetched_at", F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"), "pattern", "list", "valid_from",
        (F.coalesce("list", F.lit("allow")) != "block").alias("kept"),
    )


OP6_SQL = r"""
WITH p AS (
  SELECT page_id, url, row_number() OVER () AS rid,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((page_id * 7919) % 525600 AS BIGINT)) AS fetched_at,
         regexp_replace(regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), '^.*@', ''), ':[0-9]*$', '') AS host,
         regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), q AS (
  SELECT *, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda x: x <> '') AS segs FROM p
), pat AS (
  SELECT DISTINCT unnest([array_to_string(labels[greatest(len(labels) - 1, 1):], '.'), host,
                          CASE WHEN len(segs) > 0 THEN host || '/' || segs[1] END]) AS pattern
  FROM q WHERE host <> ''
), num AS (
  SELECT pattern, CAST('0x' || substr(md5(pattern), 1, 4) AS INTEGER) AS n FROM pat WHERE pattern IS NOT NULL
), listed AS (
  SELECT pattern, n, CASE WHEN n % 5 = 0 THEN 'allow' ELSE 'block' END AS list FROM num WHERE n % 3 = 0
), held AS (
  SELECT pattern, list, TIMESTAMP '2024-01-01' + to_days(n % 300) AS valid_from, TIMESTAMP '2024-01-01' + to_days(n % 300 + 1 + n % 90) AS valid_to FROM listed
  UNION ALL
  SELECT pattern, list, TIMESTAMP '2024-01-01' + to_days(n % 300 + 31 + n % 90), NULL FROM listed WHERE n % 2 = 0
), k AS (
  SELECT rid, fetched_at, unnest(list_concat(
           list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')),
           list_transform(range(1, len(segs) + 1), lambda i: host || '/' || array_to_string(segs[1:i], '/')))) AS pattern
  FROM q WHERE host <> ''
), r AS (
  SELECT rid, count(*) OVER (PARTITION BY rid) AS n_active, h.pattern, h.list, h.valid_from,
         row_number() OVER (PARTITION BY rid ORDER BY contains(h.pattern, '/') DESC, length(h.pattern) DESC, h.list = 'allow' DESC, h.pattern DESC, h.list DESC, h.valid_from DESC) AS nth
  FROM k JOIN held h ON k.pattern = h.pattern AND h.valid_from <= k.fetched_at AND (h.valid_to IS NULL OR k.fetched_at < h.valid_to)
)
SELECT page_id, url, fetched_at, coalesce(n_active, 0) AS n_active, pattern, list, valid_from, coalesce(list, 'allow') <> 'block' AS kept
FROM q LEFT JOIN (SELECT * FROM r WHERE nth = 1) USING (rid)
"""
