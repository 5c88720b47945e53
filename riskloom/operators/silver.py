"""Silver: versioned tables where the newest row of a key counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import id_or_zero, month_of, truthy

EVENT_KEY, MENTION_KEY = ["GLOBALEVENTID", "ActionGeo_CountryCode"], ["GLOBALEVENTID", "MentionIdentifier"]


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in a total order."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_k = 1").drop("_k")


def latest_events(df: DataFrame) -> DataFrame:
    return latest(df, EVENT_KEY, F.desc("DATEADDED"), F.desc(F.col("NumArticles").try_cast("bigint")), F.desc("SOURCEURL"))


def latest_mentions(df: DataFrame) -> DataFrame:
    return latest(df, MENTION_KEY, F.desc("enriched"), F.desc("MentionTimeDate"), F.desc("article_title"))


def typed_events(df: DataFrame) -> DataFrame:
    """Ids and stamps as numbers (bad ones 0), everything else text, and the month that partitions the table."""
    return df.withColumns({"GLOBALEVENTID": id_or_zero(F.col("GLOBALEVENTID")), "DATEADDED": id_or_zero(F.col("DATEADDED")), "month": month_of(F.col("Day"))})


def typed_mentions(df: DataFrame) -> DataFrame:
    return df.withColumns({"GLOBALEVENTID": id_or_zero(F.col("GLOBALEVENTID")), "enriched": truthy(F.col("enriched")).cast("int"), "month": month_of(F.col("MentionTimeDate"))})


def watermark(events: DataFrame) -> DataFrame:
    """(watermark): newest DATEADDED; null for none or 0."""
    return events.agg(F.nullif(F.max("DATEADDED"), F.lit(0)).alias("watermark"))


def bounds(df: DataFrame, key: str = "GLOBALEVENTID") -> DataFrame:
    return df.agg(F.min(key).alias("low"), F.max(key).alias("high"))


def in_range(df: DataFrame, parts: int, low: int, high: int, key: str = "GLOBALEVENTID") -> Column:
    """Number of the id range, of `parts` equal ones, that a row falls into."""
    width = max(1, -(-(high - low + 1) // parts))
    return F.least(F.floor((F.col(key) - low) / width), F.lit(parts - 1)).cast("int")


def query_events(events: DataFrame, date_from: str, date_to: str, limit: int = 5000) -> DataFrame:
    return events.filter(F.col("Day").between(date_from, date_to)).orderBy(F.desc("DATEADDED"), "GLOBALEVENTID", "ActionGeo_CountryCode").limit(limit)


def query_mentions(mentions: DataFrame, ids: DataFrame, limit: int = 50000) -> DataFrame:
    return mentions.join(ids.select("GLOBALEVENTID").distinct(), "GLOBALEVENTID", "left_semi").orderBy("GLOBALEVENTID", "MentionIdentifier").limit(limit)


def query_legacy(events: DataFrame, country: str | None = None, date_from: str | None = None, date_to: str | None = None, limit: int = 1000) -> DataFrame:
    for test in (country and F.col("ActionGeo_CountryCode") == country, date_from and F.col("Day") >= date_from, date_to and F.col("Day") <= date_to):
        events = events if test is None or isinstance(test, str) else events.filter(test)
    return events.orderBy(F.desc("Day"), "GLOBALEVENTID", "ActionGeo_CountryCode").limit(limit)


def trim_events(events: DataFrame, cutoff: int) -> DataFrame:
    return events.filter(F.col("DATEADDED") <= cutoff)


def trim_mentions(mentions: DataFrame, cutoff: str) -> DataFrame:
    return mentions.filter(F.col("MentionTimeDate") <= cutoff)


def present_ids(events: DataFrame, ids: DataFrame) -> DataFrame:
    return events.join(ids, "GLOBALEVENTID", "left_semi").select("GLOBALEVENTID").distinct()


def enrich(mentions: DataFrame, found: DataFrame) -> DataFrame:
    """Title, keywords and success by URL; URLs that were not fetched get empty ones."""
    f = found.select(F.col("url").alias("MentionIdentifier"), F.col("title").alias("_t"), F.col("words").alias("_w"), F.col("ok").alias("_ok"))
    out = mentions.drop("article_title", "article_keywords", "enriched").join(f, "MentionIdentifier", "left")
    return out.withColumns({"article_title": F.coalesce("_t", F.lit("")), "article_keywords": F.coalesce("_w", F.lit("")), "enriched": F.coalesce(F.col("_ok"), F.lit(False)).cast("int")}).drop("_t", "_w", "_ok")


def expired_ids(events: DataFrame, mentions: DataFrame, cutoff: str) -> DataFrame:
    """(GLOBALEVENTID): last mentioned before the cutoff; for events without a usable mention time, added before it.

    An empty time sorts below every stamp, so it never counts as old.
    """
    newest = mentions.groupBy("GLOBALEVENTID").agg(F.max("MentionTimeDate").alias("newest")).filter("newest <> ''")
    by_mention = newest.filter(F.col("newest") < cutoff).select("GLOBALEVENTID")
    old = events.groupBy("GLOBALEVENTID").agg(F.max(F.col("DATEADDED").cast("string")).alias("added")).filter(F.col("added") < cutoff)
    return by_mention.union(old.select("GLOBALEVENTID").join(newest, "GLOBALEVENTID", "left_anti")).distinct()


def drop_expired(df: DataFrame, expired: DataFrame, key: str = "GLOBALEVENTID") -> DataFrame:
    return df.join(expired.select(F.col("GLOBALEVENTID").alias(key)), key, "left_anti")


def slice_gaps(slices: DataFrame, col: str = "slice") -> DataFrame:
    """(slice, missing, first_missing) for every slice that does not follow the one before it by 15 minutes."""
    t = F.unix_timestamp(F.col(col), "yyyyMMddHHmmss")
    s = slices.select(col).distinct().withColumn("day", F.substring(col, 1, 8)).withColumn("t", t)
    # by day, with the last slice of each day carried over: no window over all slices
    last = s.groupBy("day").agg(F.max("t").alias("last"), F.min("t").alias("head"))
    before = last.select("head", F.lag("last").over(Window.orderBy("day")).alias("carried"))
    own = s.withColumn("prev", F.lag("t").over(Window.partitionBy("day").orderBy("t"))).join(before, F.col("t") == F.col("head"), "left")
    prev = F.coalesce("prev", "carried")
    out = own.select(col, ((F.col("t") - prev) / 900 - 1).cast("int").alias("missing"), F.date_format(F.timestamp_seconds(prev + 900), "yyyyMMddHHmmss").alias("first_missing"))
    return out.filter("missing > 0")
