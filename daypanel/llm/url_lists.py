"""URL filter: captures against dated list entries, as of the fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a time bucket; an interval is repeated for each bucket that it touches.
BUCKET_DAYS = 32


def url_keys(url: Column) -> Column:
    """What list entries can name of a URL, as array: the host, its parent domains down to two labels, and host plus each path prefix.

    Scheme, user, port, query, fragment, a leading ``www.`` and a final dot or slash don't count; hosts are in lower
    case. Null, and texts without a host, give an empty array.
    """
    rest = F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    rest = F.regexp_replace(F.regexp_replace(rest, r"^//", ""), r"[?#].*$", "")
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.substring_index(rest, "/", 1)), r"^.*@", ""), r":\d*$", ""), r"\.$", ""), r"^www\.", "")
    path = F.filter(F.split(F.regexp_extract(rest, r"^[^/]*/(.*)$", 1), "/"), lambda x: x != "")
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda k: F.array_join(F.slice(labels, k, 255), "."))
    prefixes = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(path)), lambda k: k > 0), lambda k: F.concat(host, F.lit("/"), F.array_join(F.slice(path, F.lit(1), k), "/"))
    )
    return F.when(host.isNull() | (host == ""), F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(parents, prefixes)))


def validity(entries: DataFrame) -> DataFrame:
    """Dated entries as validity intervals: ``key``, ``action``, ``valid_from`` (included), ``valid_to`` (excluded; null: still valid).

    An entry holds from its date to the next of its key. ``action`` is ``block`` or ``allow``; ``remove`` ends the entry before and makes no
    interval. Of several entries of one key and date the last by action counts (remove over block over allow). Entries with a null key, date or action are
    ignored. Keys are cut to lower case without a leading ``www.`` and a final slash.
    """
    rows = entries.select(F.regexp_replace(F.regexp_replace(F.lower(F.trim("key")), r"^www\.", ""), r"/+$", "").alias("key"), F.col("action").cast("string").alias("action"), F.col("since").cast("date").alias("since"))
    rows = rows.where("key is not null and key <> '' and since is not null and action in ('block', 'allow', 'remove')").groupBy("key", "since").agg(F.max("action").alias("action"))
    rows = rows.withColumn("valid_to", F.lead("since").over(Window.partitionBy("key").orderBy("since")))
    return rows.where("action <> 'remove'").select("key", "action", F.col("since").alias("valid_from"), "valid_to")


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Evaluates every capture against the entries valid at its fetch time.

    ``captures`` has ``page_id``, ``url`` and ``fetched`` (date), ``entries`` ``key``, ``action`` and ``since``. Returns per row
    ``page_id``, ``fetched``, ``matched`` (the most specific key valid then, null if none), ``n_active`` and ``blocked``: the longest matching
    key decides. Intervals are repeated per time bucket, so that the as-of join is an equality on key and bucket and a bound on the
    date: a host with a third of all captures is dealt out by time, and Spark splits what is still large.

    Null URLs and dates match nothing and aren't blocked; repeated captures come back as often; no entries
    block nothing; extra columns are ignored.
    """
    rows = captures.select("page_id", F.col("url").cast("string").alias("url"), F.col("fetched").cast("date").alias("fetched")).groupBy("page_id", "url", "fetched").count()
    bucket = lambda day: F.floor(F.unix_date(day) / BUCKET_DAYS)
    keyed = rows.select("page_id", "url", "fetched", F.explode(url_keys(F.col("url"))).alias("key")).where("fetched is not null").withColumn("bucket", bucket(F.col("fetched")))
    last = captures.agg(F.max(F.col("fetched").cast("date")).alias("last")).first()["last"]
    spans = validity(entries).where(F.col("valid_from") <= F.lit(last))
    end = F.least(F.date_sub(F.coalesce("valid_to", F.date_add(F.lit(last), 1)), 1), F.lit(last))
    spans = spans.withColumn("bucket", F.explode(F.sequence(bucket(F.col("valid_from")), bucket(end))))
    active = keyed.join(spans, ["key", "bucket"]).where("fetched >= valid_from and (valid_to is null or fetched < valid_to)")
    best = active.groupBy("page_id", "url", "fetched").agg(F.count("*").alias("n_active"), F.max(F.struct(F.length("key"), "key", "action")).alias("best"))
    same = F.lit(True)
    left, right = rows.alias("r"), best.alias("b")
    for c in ("page_id", "url", "fetched"):
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}"))
    out = left.join(right, same, "left").withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))))
    return out.select(
        "r.page_id", "r.fetched", F.col("best.key").alias("matched"), F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked")
    )


#: The query's derived data: captures over two years, and a list whose entries come and go.
FIRST_DAY, DAYS = "2023-01-01", 730


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a fetch date derived from the id: any of ``DAYS`` days."""
    return pages.select("page_id", "url", F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(DAYS)).cast("int")).alias("fetched"))


def list_of(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts and the first path parts of the pages.

    A host is blocked, removed and blocked again at days drawn from a digest of its name; the first path part of every host is allowed for a while, and blocked
    again.
    """
    host = F.lower(F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1))
    part = F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([^/?#]+)", 1)
    keys = pages.select(host.alias("host"), part.alias("part")).where("host <> ''").distinct()
    keys = keys.select("host").distinct().select(F.col("host").alias("key"), F.lit(False).alias("deep")).unionByName(
        keys.where("part <> ''").select(F.concat("host", F.lit("/"), "part").alias("key"), F.lit(True).alias("deep")).distinct()
    )
    draw = lambda k: F.conv(F.substring(F.md5("key"), k, 4), 16, 10).cast("int") % DAYS
    steps = F.array(*(F.struct(draw(4 * k + 1).alias("day"), F.when(F.col("deep"), F.lit(deep)).otherwise(F.lit(flat)).alias("action")) for k, (flat, deep) in enumerate((("block", "allow"), ("remove", "remove"), ("block", "block")))))
    return keys.select("key", F.explode(steps).alias("x")).select("key", "x.action", F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("x.day")).alias("since"))
