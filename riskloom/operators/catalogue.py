"""The catalogue: one row per (article, event) pair, typed and labelled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import text as X
from ..schemas import LABEL_SCHEMA
from .silver import latest


def with_labels(df: DataFrame, labels: DataFrame, code: str = "cameo_code") -> DataFrame:
    """cameo_label by code, "Unknown" without one.  One row a code; Spark broadcasts the table while its size allows."""
    dim = labels.groupBy(F.trim("lookup_code").alias(code)).agg(F.min(F.trim("lookup_label")).alias("cameo_label"))
    return df.join(dim, code, "left").withColumn("cameo_label", F.coalesce("cameo_label", F.lit("Unknown")))


def no_labels(spark) -> DataFrame:
    return spark.createDataFrame([], LABEL_SCHEMA)


def join_mentions(events: DataFrame, mentions: DataFrame, since: str | None = None) -> DataFrame:
    """Mentions with a URL, and newer than `since` if given, with their events; the filters reach the scan."""
    m = mentions.filter(F.trim(F.coalesce("MentionIdentifier", F.lit(""))) != "")
    if since is not None:
        m = m.filter(F.col("MentionTimeDate") > since)
    e = events.select("GLOBALEVENTID", "Day", "Actor1Name", "Actor1CountryCode", "Actor2CountryCode", "EventCode", "GoldsteinScale", "Actor1Geo_CountryCode", "Actor2Geo_CountryCode", "ActionGeo_FullName", "ActionGeo_CountryCode", "ActionGeo_Lat", "ActionGeo_Long", "DATEADDED")
    m = m.select("GLOBALEVENTID", "MentionTimeDate", "MentionIdentifier", "InRawText", "Confidence", "MentionDocTone", "article_title", "article_keywords", "enriched")
    return m.join(e, "GLOBALEVENTID")


def build(events: DataFrame, mentions: DataFrame, labels: DataFrame, since: str | None = None) -> DataFrame:
    """Of the rows of a pair the one with the newest event counts (then the greatest country code)."""
    j = join_mentions(events, mentions, since)
    c = F.col
    j = j.select(
        S.doc_id(c("MentionIdentifier")).alias("doc_id"),
        c("GLOBALEVENTID").cast("string").alias("global_event_id"),
        c("MentionIdentifier").alias("url"),
        X.headline(c("article_title"), c("MentionIdentifier")).alias("headline"),
        S.country(c("ActionGeo_FullName"), c("ActionGeo_CountryCode")).alias("country"),
        c("ActionGeo_CountryCode").alias("country_code"),
        S.number(c("ActionGeo_Lat")).alias("latitude"),
        S.number(c("ActionGeo_Long")).alias("longitude"),
        c("EventCode").alias("cameo_code"),
        c("Actor1Name").alias("actor"),
        F.lit("").alias("risk_category"),
        S.number(c("GoldsteinScale")).alias("goldstein"),
        S.day(c("Day")).alias("event_date"),
        S.stamp(c("DATEADDED").cast("string")).alias("date_added"),
        S.whole(c("Confidence")).alias("confidence"),
        S.whole(c("InRawText")).alias("in_raw_text"),
        S.number(c("MentionDocTone")).alias("mention_doc_tone"),
        S.stamp(c("MentionTimeDate")).alias("mention_time"),
        "Actor1CountryCode", "Actor2CountryCode", "Actor1Geo_CountryCode", "Actor2Geo_CountryCode", "article_title", "article_keywords", "DATEADDED",
        X.row_tokens(c("article_title"), c("article_keywords")).alias("row_tokens"),
    )
    pairs = latest(j, ["doc_id", "global_event_id"], F.desc("DATEADDED"), F.desc("country_code")).drop("DATEADDED")
    return with_labels(pairs, labels)
