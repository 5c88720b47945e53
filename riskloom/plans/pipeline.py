"""Whole plans: bronze to silver, silver to gold, gold to what a user sees."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..operators import cards, catalogue, gold, matching, relevance, silver, validate


def to_silver(events: DataFrame, mentions: DataFrame, stored_events: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Relevant events and the mentions that refer to them (or to stored events), latest versions only."""
    kept = silver.latest_events(silver.typed_events(events.filter(relevance.is_relevant(events))))
    own = validate.referential(silver.typed_mentions(mentions), kept, stored_events) if stored_events is not None else validate.referential(silver.typed_mentions(mentions), kept)
    return kept, silver.latest_mentions(own)


@dataclass
class Gold:
    articles: DataFrame
    links: DataFrame
    status: str


def recompute(
    events: DataFrame, mentions: DataFrame, labels: DataFrame, profiles: DataFrame, territories: DataFrame, since: str | None = None, only_user: str | None = None, relational: bool | None = None, folder: str | None = None
) -> Gold:
    """Articles and links of all users, or what is new after `since`, or of one user.

    relational: match by joins (any number of users) or in one pass (few users); by default whichever the number of users
    asks for.  What is matched is written to `folder`, or a working folder, once: articles and links are two reads of it.
    """
    if since is not None and only_user is not None:
        raise ValueError("a run is for newer mentions or for one user, not both")
    if only_user is not None:
        profiles = profiles.filter(F.col("user_id") == only_user)
    if relational is None:
        relational = profiles.limit(matching.FEW_USERS + 1).count() > matching.FEW_USERS
    folder = folder or storage.working_folder(events.sparkSession)
    every = catalogue.build(events, mentions, labels, since)
    if relational:
        every = storage.stored(every, f"{folder}/catalogue")
        links = storage.stored(matching.match_relational(every, profiles, territories), f"{folder}/links")
        return Gold(gold.matched_articles(every, links), links, "OK")
    # one pass gives both: matched rows are the articles, their users the links
    matched = storage.stored(matching.matched_users(every, profiles, territories), f"{folder}/matched")
    return Gold(matched.drop("users"), matched.select(F.explode("users").alias("user_id"), "doc_id", "global_event_id"), "OK")


def publish(old: Gold, new: Gold, users: DataFrame, full: bool, protected: DataFrame | None) -> Gold:
    """Full runs replace users' links and sweep orphans; incremental ones only add."""
    articles = gold.upsert(old.articles, new.articles.select(*old.articles.columns))
    links = gold.replace_users(old.links, new.links, users) if full else gold.insert_absent(old.links, new.links)
    return Gold(gold.without_orphans(articles, links, protected, incremental=not full), links, new.status)


def user_cards(g: Gold, tags: DataFrame, as_of: str, max_age_days: int | None = 90) -> DataFrame:
    return cards.with_tags(cards.build(cards.user_articles(g.links, g.articles, as_of, max_age_days)), tags)


def list_events(g: Gold, tags: DataFrame, user: str, as_of: str, max_age_days: int = 90, briefing_days: int | None = None, min_age_days: int | None = None, exclude_archived: bool = True) -> DataFrame:
    own = Gold(g.articles, g.links.filter(F.col("user_id") == user), g.status)
    return cards.order_cards(cards.age_band(user_cards(own, tags, as_of, max_age_days), briefing_days, min_age_days, exclude_archived))


def one_event(g: Gold, tags: DataFrame, user: str, event: str, as_of: str) -> DataFrame:
    own = Gold(g.articles, g.links.filter((F.col("user_id") == user) & (F.col("global_event_id") == event)), g.status)
    return user_cards(own, tags, as_of, None)


def events_summary(g: Gold, tags: DataFrame, as_of: str) -> DataFrame:
    return cards.heat_map(user_cards(g, tags, as_of))


def tagged_events(g: Gold, tags: DataFrame, user: str, tag: str, as_of: str) -> DataFrame:
    """Cards of all articles of the events that a user tagged."""
    rows = cards.tagged_articles(g.articles, tags, user, tag).withColumns({"user_id": F.lit(user), "age_days": F.datediff(F.lit(as_of).cast("date"), "event_date")})
    return cards.order_cards(cards.with_tags(cards.build(rows), tags))


def retention(events: DataFrame, mentions: DataFrame, g: Gold, tags: DataFrame, cutoff: str) -> tuple[DataFrame, DataFrame, Gold, DataFrame]:
    """Everything that belongs to expired events goes, links by their whole pair."""
    gone = silver.expired_ids(events, mentions, cutoff)
    text = gone.select(F.col("GLOBALEVENTID").cast("string").alias("GLOBALEVENTID"))
    drop = lambda df: silver.drop_expired(df, text, "global_event_id")
    return silver.drop_expired(events, gone), silver.drop_expired(mentions, gone), Gold(drop(g.articles), drop(g.links), g.status), gold.drop_tags(tags, gone)


def run_retention(spark, folder: str, today: str, run, days: int = 365) -> bool:
    """run(cutoff) once a day: not if it has run today, and at the first call after days without one.  Returns whether it ran.

    The day of the last run is kept in `folder`; run(cutoff) gets the 14-digit stamp of midnight `days` before `today`.
    """
    from datetime import date, timedelta

    state = storage.State(spark, folder)
    if state.load({"last": ""})["last"] >= today:
        return False
    run((date.fromisoformat(today) - timedelta(days=days)).strftime("%Y%m%d000000"))
    state.save({"last": today})
    return True


def publish_gold(spark, g: Gold, root: str, as_of: str) -> str:
    """Articles, links and status as one version of the serving store."""
    status = spark.createDataFrame([(g.status,)], "status string")
    return storage.publish(spark, {"articles": gold.article_rows(g.articles, as_of), "user_articles": gold.link_rows(g.links), "pipeline_status": status}, root)


# --- what serving asks for -----------------------------------------------------------------------------------------
def profile_of(profiles: DataFrame, user: str) -> DataFrame:
    return profiles.filter(F.col("user_id") == user)


def all_profiles(profiles: DataFrame) -> DataFrame:
    """(user_id, display_name), by id."""
    return profiles.select("user_id", F.coalesce("display_name", "user_id").alias("display_name")).orderBy("user_id")


def territory_names(territories: DataFrame) -> DataFrame:
    return territories.select("name").orderBy("name")


def write_tags(tags: DataFrame, user: str, event: str, tag: str | None, events: list[str] | None = None) -> DataFrame:
    """The tags with one put on an event and on the others of its group; a user's first tag makes their row."""
    ids = [event, *(e for e in events or [] if e != event)]
    spark = tags.sparkSession
    new = spark.createDataFrame([(user, {})], tags.schema).join(tags.select("user_id"), "user_id", "left_anti")
    return gold.set_tag(tags.unionByName(new), user, ids, tag)
