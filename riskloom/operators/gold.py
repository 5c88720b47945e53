"""Gold tables as keyed merges on immutable DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import STORE_ARTICLE_COLUMNS

PAIR = ["doc_id", "global_event_id"]
PROTECTING = ("requires_action", "monitor")


def upsert(old: DataFrame, new: DataFrame, keys: list[str] = PAIR) -> DataFrame:
    """New rows replace old ones of their key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def replace_users(old: DataFrame, new: DataFrame, users: DataFrame) -> DataFrame:
    """All links of the processed users are replaced, also by none."""
    return old.join(users.select("user_id").distinct(), "user_id", "left_anti").unionByName(new)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return old.unionByName(new.join(old, keys or ["user_id", *PAIR], "left_anti"))


def matched_articles(catalogue: DataFrame, links: DataFrame) -> DataFrame:
    return catalogue.join(links.select(*PAIR).distinct(), PAIR, "left_semi")


def protected_events(tags: DataFrame) -> DataFrame:
    """(global_event_id): tagged by anyone with a tag that protects."""
    rows = tags.select(F.explode("tags").alias("global_event_id", "tag"))
    return rows.filter(F.col("tag").isin(*PROTECTING)).select("global_event_id").distinct()


def orphans(articles: DataFrame, links: DataFrame, protected: DataFrame) -> DataFrame:
    return articles.join(links, PAIR, "left_anti").join(protected, "global_event_id", "left_anti")


def without_orphans(articles: DataFrame, links: DataFrame, protected: DataFrame | None, incremental: bool = False) -> DataFrame:
    """Skipped when tags could not be read, and in incremental runs."""
    if protected is None or incremental:
        return articles
    return articles.join(orphans(articles, links, protected).select(*PAIR), PAIR, "left_anti")


def pipeline_status(old: DataFrame, status: str, now: str, watermark: str | None = None) -> DataFrame:
    """One row; a watermark that is not given is carried forward."""
    carried = old.agg(F.max("silver_watermark").alias("old"))
    return carried.select(F.lit(status).alias("status"), F.lit(now).alias("timestamp_of_last_update"), F.coalesce(F.lit(watermark), "old").alias("silver_watermark"))


def mark_error(old: DataFrame) -> DataFrame:
    return old.withColumn("status", F.lit("ERROR"))


def fingerprint(links: DataFrame, user_col: str = "user_id") -> DataFrame:
    """(user_id, fingerprint): count and an order-independent digest of a user's pairs.

    The digest is the sum of 60 bits of each pair's MD5, so that no user's pairs are gathered and sums are partial first.
    """
    pair = F.md5(F.concat(F.lower(F.hex("doc_id")), F.lit("|"), F.col("global_event_id")).cast("binary"))
    part = F.conv(F.substring(pair, 1, 15), 16, 10).cast("decimal(38,0)")
    return links.groupBy(user_col).agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(part).cast("decimal(38,0)").cast("string")).alias("fingerprint"))


def fingerprint_of(links: DataFrame, user: str) -> DataFrame:
    own = fingerprint(links.filter(F.col("user_id") == user)).agg(F.max("fingerprint").alias("f"))
    return own.select(F.coalesce("f", F.lit("0:")).alias("fingerprint"))


def rebuild_pending(saved: str, current: DataFrame, seconds_since: int, limit: int = 90) -> DataFrame:
    return current.select(((F.col("fingerprint") == saved) & F.lit(seconds_since <= limit)).alias("pending"))


def add_missing_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows under the new schema; nothing of a table with another key, which migrated() builds again."""
    return old.unionByName(new.limit(0), allowMissingColumns=True) if set(PAIR) <= set(old.columns) else new.limit(0)


def migrated(old: DataFrame, new: DataFrame, rebuild: Callable[[], DataFrame]) -> DataFrame:
    """Old rows under the new schema, or all rows built again if the old table has the key of an earlier layout: gold is derived."""
    return add_missing_columns(old, new) if set(PAIR) <= set(old.columns) else rebuild().select(*new.columns)


def article_rows(catalogue: DataFrame, as_of: str) -> DataFrame:
    """The articles as the serving store has them, with their age on `as_of`."""
    named = catalogue.withColumns({"document_identifier": F.col("url"), "mention_identifier": F.col("headline"), "age_days": F.datediff(F.lit(as_of).cast("date"), "event_date")})
    return named.select(*STORE_ARTICLE_COLUMNS)


def link_rows(links: DataFrame) -> DataFrame:
    return links.select("user_id", *PAIR)


def run_mode(watermark: str | None, last: str | None, run: int, every: int = 12, incremental: bool = True) -> str:
    """full without a baseline, without progress, on every twelfth run, or when switched off; else incremental."""
    full = not incremental or last is None or watermark is None or watermark <= last or run % every == 0
    return "full" if full else "incremental"


def drop_tags(tags: DataFrame, expired: DataFrame) -> DataFrame:
    """Tags without those of expired events; users keep their row."""
    rows = tags.select("user_id", F.explode_outer("tags").alias("event", "tag"))
    kept = rows.join(expired.select(F.col("GLOBALEVENTID").cast("string").alias("event")), "event", "left_anti").filter("event is not null")
    maps = kept.groupBy("user_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event", "tag")))).alias("tags"))
    return tags.select("user_id").distinct().join(maps, "user_id", "left").withColumn("tags", F.coalesce("tags", F.create_map().cast("map<string,string>")))


def set_tag(tags: DataFrame, user: str, events: list[str], tag: str | None) -> DataFrame:
    """Put one tag on events of a user; clearing stores a null."""
    new = F.map_from_arrays(F.array(*map(F.lit, events)), F.array_repeat(F.lit(tag).cast("string"), len(events)))
    old = F.map_filter("tags", lambda k, v: ~k.isin(events))
    return tags.withColumn("tags", F.when(F.col("user_id") == user, F.map_concat(old, new)).otherwise(F.col("tags")))


def save_profile(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, ["user_id"])


def first_login(profiles: DataFrame, users: DataFrame) -> DataFrame:
    return users.join(profiles, "user_id", "left_anti")
