"""Event cards: a user's articles grouped by event, ranked and capped; cards with the same headlines merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import NO_TITLE, label_display, title_key
from .gold import PAIR

CAP = 20
CARD = ["user_id", "global_event_id"]


def user_articles(links: DataFrame, articles: DataFrame, as_of: str, max_age_days: int | None = 90) -> DataFrame:
    """The articles of each user with their age on `as_of`, not older than max_age_days."""
    df = links.join(articles, PAIR).withColumn("age_days", F.datediff(F.lit(as_of).cast("date"), "event_date"))
    return df if max_age_days is None else df.filter(F.col("age_days") <= max_age_days)


def prefer_raw_text(df: DataFrame, keys: list[str] = CARD) -> DataFrame:
    """Where a card has articles that name the event in their text, only those stay; `filtered` tells that some went."""
    w = Window.partitionBy(*keys)
    raw = F.coalesce(F.col("in_raw_text") == 1, F.lit(False))
    df = df.withColumn("_any", F.max(raw).over(w)).withColumn("filtered", F.col("_any") & (F.min(raw).over(w) == F.lit(False)))
    return df.filter(~F.col("_any") | raw).drop("_any")


def article_order() -> list[Column]:
    return [F.desc(F.coalesce("confidence", F.lit(-1))), F.asc_nulls_last(F.abs("mention_doc_tone")), F.asc("url")]


def ranked_articles(df: DataFrame, keys: list[str] = CARD, cap: int = CAP) -> DataFrame:
    """Sorted, then one article a title (empty titles all stay), then the first `cap`; `place` counts from 1."""
    df = df.withColumn("_key", title_key(F.col("headline")))
    seen = F.row_number().over(Window.partitionBy(*keys, "_key").orderBy(*article_order()))
    df = df.withColumn("_seen", seen).filter((F.col("_seen") == 1) | (F.col("_key") == ""))
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*article_order()))).filter(F.col("place") <= cap).drop("_key", "_seen")


def build(df: DataFrame, keys: list[str] = CARD, cap: int = CAP) -> DataFrame:
    """One card per key: metadata of the first raw article, greatest confidence of all, and the ranked articles."""
    meta_names = ["country", "latitude", "longitude", "cameo_code", "cameo_label", "actor", "risk_category", "goldstein", "event_date", "date_added", "age_days"]
    # every step partitions by the keys, so the rows are shuffled once
    w = Window.partitionBy(*keys)
    first = F.struct(-F.coalesce("confidence", F.lit(-1)), F.coalesce(F.abs("mention_doc_tone"), F.lit(float("inf"))), "url")
    df = df.withColumn("_meta", F.min_by(F.struct(*meta_names), first).over(w)).withColumn("_confidence", F.max(F.coalesce("confidence", F.lit(-1))).over(w))
    item = F.struct("place", "headline", "url", "confidence", "in_raw_text", "mention_doc_tone", "mention_time")
    out = ranked_articles(prefer_raw_text(df, keys), keys, cap).groupBy(*keys).agg(
        F.array_sort(F.collect_list(item)).alias("articles"),
        F.max("filtered").alias("inrawtext_filtered"),
        F.min("mention_time").alias("oldest_article_time"),
        F.count(F.lit(1)).alias("n_articles"),
        F.first("_meta").alias("m"),
        F.max("_confidence").alias("max_confidence"),
    )
    return out.select(*keys, F.col("articles")[0]["headline"].alias("card_title"), F.col("articles")[0]["url"].alias("top_article_url"), *(F.col(f"m.{c}").alias(c) for c in meta_names), "max_confidence", "inrawtext_filtered", "oldest_article_time", "n_articles", "articles")


def order_cards(cards: DataFrame) -> DataFrame:
    return cards.orderBy(F.desc_nulls_last("oldest_article_time"), "global_event_id")


def card_rank(keys: str = "user_id") -> Column:
    return F.row_number().over(Window.partitionBy(keys).orderBy(F.desc_nulls_last("oldest_article_time"), "global_event_id"))


def with_tags(cards: DataFrame, tags: DataFrame) -> DataFrame:
    rows = tags.select("user_id", F.explode("tags").alias("global_event_id", "tag"))
    return cards.join(rows, ["user_id", "global_event_id"], "left")


def age_band(cards: DataFrame, briefing_days: int | None = None, min_age_days: int | None = None, exclude_archived: bool = True) -> DataFrame:
    for test in (briefing_days is not None and F.col("age_days") <= briefing_days, min_age_days is not None and F.col("age_days") > min_age_days, exclude_archived and F.coalesce(F.col("tag") != "archive", F.lit(True))):
        cards = cards.filter(test) if isinstance(test, Column) else cards
    return cards


def in_territories(cards: DataFrame, profiles: DataFrame) -> DataFrame:
    p = profiles.select("user_id", F.coalesce("territories", F.array().cast("array<string>")).alias("_t"))
    return cards.join(p, "user_id").filter((F.size("_t") == 0) | F.array_contains("_t", F.col("country"))).drop("_t")


def heat_map(cards: DataFrame) -> DataFrame:
    """(user_id, country, latitude, longitude, event_count) by place to four decimals; counts articles; archived cards and cards without a place are left out."""
    c = cards.filter("latitude is not null and longitude is not null and country is not null and coalesce(tag, '') <> 'archive'")
    first = lambda x: F.min_by(x, F.struct(F.col("oldest_article_time").isNull(), -F.unix_timestamp(F.col("oldest_article_time").cast("timestamp")), "global_event_id"))
    grouped = c.groupBy("user_id", "country", F.round("latitude", 4).alias("_a"), F.round("longitude", 4).alias("_o"))
    return grouped.agg(first("latitude").alias("latitude"), first("longitude").alias("longitude"), F.sum(F.greatest("n_articles", F.lit(1))).alias("event_count")).drop("_a", "_o")


def date_value(c: Column) -> Column:
    """Time of a text date for ordering: ISO, or yyyyMMdd in its first eight letters; what is neither is the lowest."""
    text = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    iso = text.try_cast("timestamp")
    compact = F.try_to_timestamp(F.substring(text, 1, 8), F.lit("yyyyMMdd"))
    return F.coalesce(F.when(~text.rlike("^[0-9]+$"), iso), F.when(text.rlike("^[0-9]{8}"), compact), F.lit("0001-01-01 00:00:00").cast("timestamp"))


def whole_value(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")).try_cast("bigint"), F.lit(-1).cast("bigint"))


def float_value(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")).try_cast("double"), F.lit(0.0))


def group_same_headlines(cards: DataFrame) -> DataFrame:
    """Cards of a user with one set of headlines become one: the leader's, with all ids (greatest first) and their number."""
    shown = cards.withColumn("_set", F.array_sort(F.array_distinct(F.filter(F.col("articles.headline"), lambda h: h != ""))))
    shown = shown.withColumn("_group", F.when(F.size("_set") > 0, F.array_join("_set", "\x1f")).otherwise(F.concat(F.lit("\x1e"), "global_event_id")))
    number = F.coalesce(F.col("global_event_id").try_cast("bigint"), F.lit(-1))
    lead = F.struct(F.coalesce("event_date", F.lit("0001-01-01").cast("date")), F.coalesce("date_added", F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")), "max_confidence", number)
    card = F.struct("global_event_id", "card_title", "event_date", "goldstein", "oldest_article_time", "n_articles", "tag")
    out = shown.groupBy("user_id", "_group").agg(F.max_by(card, lead).alias("c"), F.reverse(F.array_sort(F.collect_list(number))).alias("event_ids"))
    return out.select("user_id", "c.*", "event_ids", F.size("event_ids").alias("n_events"))


def grouped_rank() -> Column:
    return F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc_nulls_last("oldest_article_time"), F.desc_nulls_last("event_date"), F.asc_nulls_last("goldstein"), "global_event_id"))


def visible_groups(grouped: DataFrame) -> DataFrame:
    """Archived groups go only now, by the leader's tag."""
    return grouped.filter(F.coalesce(F.col("tag") != "archive", F.lit(True)))


def preview(cards: DataFrame, n: int = 3) -> DataFrame:
    shown = F.when(F.col("n_articles") >= CAP, F.lit(f"≥{CAP}")).otherwise(F.col("n_articles").cast("string"))
    return cards.select("user_id", "global_event_id", F.slice("articles", 1, n).alias("preview"), shown.alias("shown_count"))


def title_of(articles: Column, label: Column) -> Column:
    """First headline that is a real title, else the kind of event."""
    real = F.filter(articles, lambda a: ~a["headline"].startswith(NO_TITLE))
    return F.coalesce(F.try_element_at(real, F.lit(1))["headline"], F.concat(F.lit('"'), label_display(label), F.lit('" type of event')))


def notes(cards: DataFrame) -> DataFrame:
    return cards.select("user_id", "global_event_id", F.forall("articles", lambda a: F.coalesce(a["in_raw_text"] == 0, F.lit(False))).alias("all_inferred"), "inrawtext_filtered")


def table_rows(cards: DataFrame) -> DataFrame:
    return cards.select("user_id", "global_event_id", "card_title", "country", F.substring(F.col("event_date").cast("string"), 1, 10).alias("date"), F.coalesce("tag", F.lit("No tag")).alias("tag"), "top_article_url")


def tagged_articles(articles: DataFrame, tags: DataFrame, user: str, tag: str) -> DataFrame:
    """Articles of the events a user has tagged, matched or not."""
    ids = tags.filter(F.col("user_id") == user).select(F.explode("tags").alias("global_event_id", "tag")).filter(F.col("tag") == tag)
    return articles.join(ids.select("global_event_id").distinct(), "global_event_id", "left_semi")
