"""Every operator as a query over the test tables, beside the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as X
from . import storage
from .functions import scalars as S
from .functions import text as T
from .operators import cards as C
from .operators import catalogue, gold, legacy, matching, monitoring, profiles, provenance, relevance, silver, validate
from .oracles import sql
from .plans import pipeline as P
from .sources import feeds, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
c = F.col


def query(name: str, oracle: str | None, *parts: str):
    def add(f):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = sql(oracle, *parts)
        return f

    return add


_built: dict[tuple, DataFrame] = {}


class World:
    """The fixture's tables.  Silver, catalogue and gold are written at their first use in an application, as a store has them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.dir, name)
        if key not in _built:
            _built[key] = storage.stored(make(), f"{storage.working_folder(self.spark)}/{name}")
        return _built[key]

    def _gold(self) -> P.Gold:
        def matched() -> DataFrame:
            return matching.matched_users(self.catalogue, self.profiles, self.territories)

        rows = self._once("matched", matched)
        return P.Gold(rows.drop("users"), rows.select(F.explode("users").alias("user_id"), "doc_id", "global_event_id"), "OK")

    def fresh_silver(self) -> tuple[DataFrame, DataFrame]:
        return P.to_silver(self.bronze_events, self.bronze_mentions)

    def fresh_catalogue(self) -> DataFrame:
        return catalogue.build(self.events, self.mentions, self.labels)

    def __getattr__(self, name: str):
        make = {
            "bronze_events": lambda: X.bronze_events(self.spark, self.dir),
            "bronze_mentions": lambda: X.bronze_mentions(self.spark, self.dir),
            "events": lambda: self._once("events", lambda: self.fresh_silver()[0]),
            "mentions": lambda: self._once("mentions", lambda: self.fresh_silver()[1]),
            "labels": lambda: X.labels(self.spark),
            "territories": lambda: X.territories(self.spark, self.dir),
            "profiles": lambda: X.profiles(self.spark),
            "tags": lambda: X.tags(self.spark),
            "catalogue": lambda: self._once("catalogue", self.fresh_catalogue),
            "gold": self._gold,
            "recent": lambda: C.user_articles(self.gold.links, self.gold.articles, X.AS_OF),
            "cards": lambda: P.user_cards(self.gold, self.tags, X.AS_OF),
            "documents": lambda: self.spark.read.parquet(f"{self.dir}/documents.parquet"),
            "pages": lambda: self.spark.read.parquet(f"{self.dir}/pages.parquet"),
        }[name]
        value = self.__dict__[name] = make()
        return value


def hexed(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.lower(F.hex("doc_id")))


def text_time(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


TOKENS_SQL = "list_transform(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda t: case when length(t) > 3 and ends_with(t, 's') then substr(t, 1, length(t) - 1) else t end)"
T_SQL = "strftime({0}, '%Y-%m-%d %H:%M:%S') as {0}"


# --- scans and sources ---------------------------------------------------------------------------------------------
@query("s04_slice_names", "select strftime(t, '%Y%m%d%H%M%S') as slice from generate_series(timestamp '2024-01-28 10:30:00', timestamp '2024-01-31 10:30:00', interval 15 minutes) as g(t)")
def _(s, d):
    return feeds.slice_names(s, "2024-01-31 10:44:59", 3)


@query("s04_slice_urls", """select strftime(t, '%Y%m%d%H%M%S') as slice, kind, 'http://feed.example.com/v2/' || strftime(t, '%Y%m%d%H%M%S') || case kind when 'events' then '.export.CSV.zip' else '.mentions.CSV.zip' end as url
 from generate_series(timestamp '2024-01-30 10:30:00', timestamp '2024-01-31 10:30:00', interval 15 minutes) as g(t), (values ('events'), ('mentions')) as k(kind)""")
def _(s, d):
    return feeds.slice_urls(s, "http://feed.example.com/v2", "2024-01-31 10:44:59", 1)


MANIFEST = "select * from values ('1 a http://f/20240101000000.export.CSV.zip'), ('2 b http://f/20240101000000.mentions.CSV.zip'), ('3 c http://f/20240101000000.gkg.csv.zip'), ('short') as t(value)"


@query("s01_manifest", "select * from (values ('events', 'http://f/20240101000000.export.CSV.zip'), ('mentions', 'http://f/20240101000000.mentions.CSV.zip')) as t(kind, url)")
def _(s, d):
    return feeds.parse_manifest(s.sql(MANIFEST))


SLICE_FILES = """select p.path, p.slice, p.kind, cast(p.m as timestamp) as modified from (values ('a1', '20240101000000', 'events', '2024-01-01 00:01:00'), ('a2', '20240101000000', 'mentions', '2024-01-01 00:01:05'),
 ('b1', '20240101001500', 'events', '2024-01-01 00:16:00'), ('c2', '20240101003000', 'mentions', '2024-01-01 00:29:59'), ('x', '20240101004500', 'unknown', '2024-01-01 00:30:00')) as p(path, slice, kind, m)"""


@query("s03_released_slices", f"""select slice, max(case when kind = 'events' then path end) as events, max(case when kind = 'mentions' then path end) as mentions
 from ({SLICE_FILES}) group by slice having (events is not null and mentions is not null) or epoch(timestamp '2024-01-01 00:30:00') - epoch(min(modified)) > 600""")
def _(s, d):
    return feeds.released_slices(s.sql(SLICE_FILES), "2024-01-01 00:30:00")


@query("t18_stable_files", f"select path from ({SLICE_FILES}) where modified <= timestamp '2024-01-01 00:30:00' - interval 3 seconds")
def _(s, d):
    return feeds.stable_files(s.sql(SLICE_FILES), "2024-01-01 00:30:00").select("path")


@query("f09_processable_slices", f"select slice, string_agg(distinct kind, '+' order by kind) as kinds, count(distinct kind) = 2 as is_pair from ({SLICE_FILES}) where kind in ('events', 'mentions') group by slice")
def _(s, d):
    return validate.processable(s.sql(SLICE_FILES))


@query("j14_pair_slices", f"""select coalesce(e.slice, m.slice) as slice, e.path as event_path, m.path as mention_path from (select * from ({SLICE_FILES}) where kind = 'events') e
 full join (select * from ({SLICE_FILES}) where kind = 'mentions') m on e.slice = m.slice""")
def _(s, d):
    f = s.sql(SLICE_FILES)
    return validate.pair_slices(f.filter("kind = 'events'"), f.filter("kind = 'mentions'"))


@query("s05_backfill_list", f"""select u.slice, u.kind from (select strftime(t, '%Y%m%d%H%M%S') as slice, kind from generate_series(timestamp '2024-01-01 00:00:00', timestamp '2024-01-02 00:00:00', interval 15 minutes) as g(t), (values ('events'), ('mentions')) as k(kind)) u
 where not exists (select 1 from ({SLICE_FILES}) f where f.slice = u.slice and f.kind = u.kind)""")
def _(s, d):
    return feeds.backfill_list(feeds.slice_urls(s, "http://f", "2024-01-02 00:00:00", 1), s.sql(SLICE_FILES)).select("slice", "kind")


@query("s09_feed_kind", """select path, case when contains(lower(path), 'mentions') then 'mentions' when contains(lower(path), 'export') then 'events' else 'unknown' end as kind, regexp_extract(path, '(\\d{14})', 1) as slice
 from (select distinct '/in/' || DATEADDED || case cast(GLOBALEVENTID as bigint) % 3 when 0 then '.export.CSV' when 1 then '.MENTIONS.csv' else '.txt' end as path from be)""", "be")
def _(s, d):
    b = World(s, d).bronze_events
    ending = F.element_at(F.array(F.lit(".export.CSV"), F.lit(".MENTIONS.csv"), F.lit(".txt")), (c("GLOBALEVENTID").cast("int") % 3 + 1))
    return b.select(F.concat(F.lit("/in/"), c("DATEADDED"), ending).alias("path")).distinct().select("path", S.feed_kind(c("path")).alias("kind"), S.slice_of_path(c("path")).alias("slice"))


@query("s10_id_ranges", """select part, count(*) as n, min(GLOBALEVENTID) as low, max(GLOBALEVENTID) as high from (select GLOBALEVENTID, cast(least(floor((GLOBALEVENTID - lo) / ceil((hi - lo + 1) / 8.0)), 7) as int) as part
 from ev, (select min(GLOBALEVENTID) as lo, max(GLOBALEVENTID) as hi from ev)) group by part""", "ev")
def _(s, d):
    e = World(s, d).events
    b = silver.bounds(e).first()
    return e.withColumn("part", silver.in_range(e, 8, b.low, b.high)).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("GLOBALEVENTID").alias("low"), F.max("GLOBALEVENTID").alias("high"))


@query("s14_query_events", "select GLOBALEVENTID, ActionGeo_CountryCode, Day, DATEADDED from ev where Day between '20240105' and '20240110' order by DATEADDED desc, GLOBALEVENTID, ActionGeo_CountryCode limit 5000", "ev")
def _(s, d):
    return silver.query_events(World(s, d).events, "20240105", "20240110").select("GLOBALEVENTID", "ActionGeo_CountryCode", "Day", "DATEADDED")


@query("s15_query_mentions", "select GLOBALEVENTID, MentionIdentifier from mn where GLOBALEVENTID in (select GLOBALEVENTID from ev where ActionGeo_CountryCode = 'F05') order by 1, 2 limit 50000", "mn", "ev")
def _(s, d):
    w = World(s, d)
    return silver.query_mentions(w.mentions, w.events.filter("ActionGeo_CountryCode = 'F05'")).select("GLOBALEVENTID", "MentionIdentifier")


@query("s16_query_legacy", "select GLOBALEVENTID, Day, EventCode from ev where ActionGeo_CountryCode = 'F07' and Day >= '20240103' order by Day desc, GLOBALEVENTID, ActionGeo_CountryCode limit 1000", "ev")
def _(s, d):
    return silver.query_legacy(World(s, d).events, "F07", "20240103", None).select("GLOBALEVENTID", "Day", "EventCode")


@query("s17_trim", "select 'events' as t, count(*) as n from ev where DATEADDED <= 20240115000000 union all select 'mentions', count(*) from mn where MentionTimeDate <= '20240115000000'", "ev", "mn")
def _(s, d):
    w = World(s, d)
    n = lambda df, t: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("t"), "n")
    return n(silver.trim_events(w.events, 20240115000000), "events").unionByName(n(silver.trim_mentions(w.mentions, "20240115000000"), "mentions"))


# --- projections, filters, checks ----------------------------------------------------------------------------------
@query("f01_event_code", "select GLOBALEVENTID, DATEADDED, f1 from flags", "flags")
def _(s, d):
    b = World(s, d).bronze_events
    return b.select("GLOBALEVENTID", "DATEADDED", relevance.has_event_code(b).alias("f1"))


@query("f02_actor", "select GLOBALEVENTID, DATEADDED, f2 from flags", "flags")
def _(s, d):
    b = World(s, d).bronze_events
    return b.select("GLOBALEVENTID", "DATEADDED", relevance.has_actor(b).alias("f2"))


@query("f03_keyword", "select GLOBALEVENTID, DATEADDED, f3 from flags", "flags")
def _(s, d):
    b = World(s, d).bronze_events
    return b.select("GLOBALEVENTID", "DATEADDED", relevance.has_keyword(b).alias("f3"))


@query("f04_has_url", "select GLOBALEVENTID, DATEADDED, f4 from flags", "flags")
def _(s, d):
    b = World(s, d).bronze_events
    return b.select("GLOBALEVENTID", "DATEADDED", relevance.has_url(b).alias("f4"))


@query("f05_relevant", "select GLOBALEVENTID, Day, Actor1Name, EventCode, ActionGeo_CountryCode, DATEADDED, SOURCEURL from flags where f1 and (f2 or f3) and f4", "flags")
def _(s, d):
    b = World(s, d).bronze_events
    return b.filter(relevance.is_relevant(b)).select("GLOBALEVENTID", "Day", "Actor1Name", "EventCode", "ActionGeo_CountryCode", "DATEADDED", "SOURCEURL")


LINES = "select * from values ('a', 0, ''), ('a', 1, 'x\ty\tz'), ('b', 0, 'x\ty'), ('b', 1, 'x\ty\tz'), ('c', 0, ''), ('c', 1, '  ') as t(path, line_no, value)"


@query("f06_wrong_width", "select 'b' as path, 2 as width")
def _(s, d):
    return validate.wrong_width(s.sql(LINES), 3)


@query("f07_confidence_slices", """select MentionTimeDate as slice, count(*) as bad from (select *, case when cast(GLOBALEVENTID as bigint) % 97 = 0 then '3000' when cast(GLOBALEVENTID as bigint) % 89 = 0 then 'n/a' else Confidence end as conf from bm)
 where trim(conf) <> '' and not coalesce(try_cast(trim(conf) as double) between 0 and 100, false) group by 1""", "bm")
def _(s, d):
    m = World(s, d).bronze_mentions
    n = c("GLOBALEVENTID").cast("bigint")
    m = m.withColumn("conf", F.when(n % 97 == 0, "3000").when(n % 89 == 0, "n/a").otherwise(c("Confidence"))).withColumn("slice", c("MentionTimeDate"))
    return validate.rejected_slices(m, "slice", validate.bad_confidence(c("conf")))


@query("f08_bad_stamps", """select GLOBALEVENTID, stamp, not (length(stamp) = 14 and try_strptime(stamp, '%Y%m%d%H%M%S') is not null) and stamp <> '' as bad from (
 select GLOBALEVENTID, case cast(GLOBALEVENTID as bigint) % 5 when 0 then '' when 1 then substr(DATEADDED, 1, 12) when 2 then '20261316133000' else DATEADDED end as stamp from be)""", "be")
def _(s, d):
    n = c("GLOBALEVENTID").cast("bigint") % 5
    b = World(s, d).bronze_events.select("GLOBALEVENTID", F.when(n == 0, "").when(n == 1, F.substring("DATEADDED", 1, 12)).when(n == 2, "20261316133000").otherwise(c("DATEADDED")).alias("stamp"))
    return b.withColumn("bad", validate.bad_stamp(c("stamp")))


@query("f08_accepted_slices", """select GLOBALEVENTID, slice from (select GLOBALEVENTID, DATEADDED as slice, cast(GLOBALEVENTID as bigint) % 97 = 0 as bad from be)
 where slice not in (select DATEADDED from be where cast(GLOBALEVENTID as bigint) % 97 = 0)""", "be")
def _(s, d):
    b = World(s, d).bronze_events.select("GLOBALEVENTID", c("DATEADDED").alias("slice"))
    return validate.accept_slices(b, "slice", c("GLOBALEVENTID").cast("bigint") % 97 == 0)


@query("p01_retained_columns", "select GLOBALEVENTID, Day, Actor1Name, Actor1CountryCode, Actor2Name, Actor2CountryCode, EventCode, EventRootCode, GoldsteinScale, NumArticles, AvgTone, Actor1Geo_CountryCode, Actor2Geo_CountryCode, ActionGeo_FullName, ActionGeo_CountryCode, ActionGeo_Lat, ActionGeo_Long, DATEADDED, SOURCEURL from be", "be")
def _(s, d):
    from .schemas import EVENT_COLUMNS

    return World(s, d).bronze_events.select(*EVENT_COLUMNS)


@query("f11_since", "select doc_id, global_event_id, MentionTimeDate as t from cat where MentionTimeDate > '20240115000000'", "cat")
def _(s, d):
    w = World(s, d)
    out = catalogue.build(w.events, w.mentions, w.labels, "20240115000000")
    return hexed(out).select("doc_id", "global_event_id", F.date_format("mention_time", "yyyyMMddHHmmss").alias("t"))


@query("f12_geo_predicate", "select doc_id, global_event_id from cat where Actor1CountryCode in ('N01', 'N07') or Actor2CountryCode in ('N01', 'N07') or country_code in ('F01', 'F07') or Actor1Geo_CountryCode in ('F01', 'F07') or Actor2Geo_CountryCode in ('F01', 'F07')", "cat")
def _(s, d):
    return hexed(World(s, d).catalogue.filter(matching.geo_predicate(["N01", "N07"], ["F01", "F07"]))).select("doc_id", "global_event_id")


@query("f13_keyword_predicate", "select doc_id, global_event_id from cat where contains(lower(url), 'small-ring') or list_has_all(row_tokens, ['small', 'ring']) or contains(lower(url), 'gears') or list_has_all(row_tokens, ['gear'])", "cat")
def _(s, d):
    return hexed(World(s, d).catalogue.filter(matching.keyword_predicate(["small rings", "gears"]) | matching.keyword_predicate(["small ring"]))).select("doc_id", "global_event_id")


@query("f14_legacy_geography", "select GLOBALEVENTID, ActionGeo_CountryCode, list_has_any([Actor1CountryCode, Actor2CountryCode, ActionGeo_CountryCode], ['N02', 'F09']) as hit from ev", "ev")
def _(s, d):
    codes = F.array("Actor1CountryCode", "Actor2CountryCode", "ActionGeo_CountryCode")
    return World(s, d).events.select("GLOBALEVENTID", "ActionGeo_CountryCode", matching.matches_geography(codes, F.array(F.lit("N02"), F.lit("F09"))).alias("hit"))


@query("f17_prefer_raw_text", "select user_id, doc_id, global_event_id, filtered from pref", "pref")
def _(s, d):
    return hexed(C.prefer_raw_text(World(s, d).recent)).select("user_id", "doc_id", "global_event_id", "filtered")


@query("f18_in_territories", "select user_id, global_event_id from cards where user_id not in (select user_id from places) or (user_id, country) in (select user_id, name from places)", "cards", "places")
def _(s, d):
    w = World(s, d)
    return C.in_territories(w.cards, w.profiles).select("user_id", "global_event_id")


@query("f19_protected_events", "select distinct global_event_id from tags where tag in ('requires_action', 'monitor')", "tags")
def _(s, d):
    return gold.protected_events(World(s, d).tags)


@query("f22_profile_problems", """select user_id, 'few territories' as problem from users where user_id not in (select user_id from places group by 1 having count(*) >= 2)
 union all select user_id, 'unknown territory ' || name from places where name not in (select name from terr)
 union all select user_id, 'few answers to ' || question from words group by user_id, question having count(*) < 2""", "users", "places", "words", "terr")
def _(s, d):
    w = World(s, d)
    return profiles.problems(w.profiles, w.territories, 2)


@query("f23_input_rules", """select user_id, regexp_matches(user_id, '^[A-Za-z0-9_]{1,20}$') as valid_name, coalesce(one, true) as one_word, coalesce(dist, true) as distinct_words, true as within_limit
 from users left join (select user_id, bool_and(not contains(trim(keyword), ' ')) as one, count(*) = count(distinct lower(keyword)) as dist from words group by 1) using (user_id)""", "users", "words")
def _(s, d):
    return profiles.input_rules(World(s, d).profiles)


# --- joins ---------------------------------------------------------------------------------------------------------
@query("j01_mentions_events", "select m.GLOBALEVENTID, MentionIdentifier, ActionGeo_CountryCode, DATEADDED from mn m join ev using (GLOBALEVENTID)", "mn", "ev")
def _(s, d):
    w = World(s, d)
    return catalogue.join_mentions(w.events, w.mentions).select("GLOBALEVENTID", "MentionIdentifier", "ActionGeo_CountryCode", "DATEADDED")


@query("j02_labels", "select EventCode, coalesce(lookup_label, 'Unknown') as cameo_label, count(*) as n from be left join labels on lookup_code = EventCode group by all", "be", "labels")
def _(s, d):
    w = World(s, d)
    return catalogue.with_labels(w.bronze_events, w.labels, "EventCode").groupBy("EventCode", "cameo_label").agg(F.count(F.lit(1)).alias("n"))


@query("j03_matched_articles", "select distinct doc_id, global_event_id from links", "links")
def _(s, d):
    w = World(s, d)
    return hexed(gold.matched_articles(w.catalogue, w.gold.links)).select("doc_id", "global_event_id")


@query("j04_user_articles", "select user_id, doc_id, global_event_id, age_days from recent", "recent")
def _(s, d):
    return hexed(World(s, d).recent).select("user_id", "doc_id", "global_event_id", "age_days")


@query("j05_referential_slice", "select GLOBALEVENTID, MentionIdentifier, enriched from bm where cast(GLOBALEVENTID as bigint) in (select GLOBALEVENTID from ev where ActionGeo_CountryCode < 'F10')", "bm", "ev")
def _(s, d):
    w = World(s, d)
    return validate.referential(w.bronze_mentions, w.events.filter("ActionGeo_CountryCode < 'F10'")).select("GLOBALEVENTID", "MentionIdentifier", "enriched")


@query("j05_referential_store", "select GLOBALEVENTID, MentionIdentifier, enriched from bm where cast(GLOBALEVENTID as bigint) in (select GLOBALEVENTID from ev)", "bm", "ev")
def _(s, d):
    w = World(s, d)
    e = w.events
    return validate.referential(w.bronze_mentions, e.filter("ActionGeo_CountryCode < 'F10'"), e.filter("ActionGeo_CountryCode >= 'F10'")).select("GLOBALEVENTID", "MentionIdentifier", "enriched")


@query("j06_orphans", "select doc_id, global_event_id from cat where (doc_id, global_event_id) not in (select doc_id, global_event_id from links where user_id in ('u1', 'u2')) and global_event_id not in (select global_event_id from tags where tag in ('requires_action', 'monitor'))", "cat", "links", "tags")
def _(s, d):
    w = World(s, d)
    return hexed(gold.orphans(w.catalogue, w.gold.links.filter("user_id in ('u1', 'u2')"), gold.protected_events(w.tags))).select("doc_id", "global_event_id")


@query("j08_tag_attach", "select user_id, global_event_id, tag from cards", "cards")
def _(s, d):
    return World(s, d).cards.select("user_id", "global_event_id", "tag")


@query("j09_tagged_articles", "select doc_id, global_event_id from cat where global_event_id in (select global_event_id from tags where user_id = 'u4' and tag = 'monitor')", "cat", "tags")
def _(s, d):
    w = World(s, d)
    return hexed(C.tagged_articles(w.catalogue, w.tags, "u4", "monitor")).select("doc_id", "global_event_id")


@query("j10_match_by_filter", "select user_id, doc_id, global_event_id from links", "links")
def _(s, d):
    w = World(s, d)
    return hexed(matching.match_by_filter(w.catalogue, w.profiles, w.territories))


@query("j10_match_relational", "select user_id, doc_id, global_event_id from links", "links")
def _(s, d):
    w = World(s, d)
    return hexed(matching.match_relational(w.catalogue, w.profiles, w.territories))


@query("j11_user_codes", """select user_id, coalesce(string_agg(cameo[1], ',' order by cameo[1]), '') as cameo, coalesce(string_agg(fips[1], ',' order by fips[1]), '') as fips
 from users left join places using (user_id) left join terr using (name) group by user_id""", "users", "places", "terr")
def _(s, d):
    w = World(s, d)
    return matching.user_codes(w.profiles, w.territories).select("user_id", F.array_join("cameo", ",").alias("cameo"), F.array_join("fips", ",").alias("fips"))


@query("j12_trace", """select user_id, upper(user_id) as display_name, l.doc_id, l.global_event_id, case when EventCode is null or m.GLOBALEVENTID is null then '(silver row gone)' else 'present' end as silver
 from links l join cat using (doc_id, global_event_id) left join (select cast(GLOBALEVENTID as varchar) as global_event_id, max(EventCode) as EventCode from ev where ActionGeo_CountryCode <> 'F03' group by 1) e on e.global_event_id = l.global_event_id
 left join mn m on cast(m.GLOBALEVENTID as varchar) = l.global_event_id and MentionIdentifier = cat.url""", "links", "cat", "ev", "mn")
def _(s, d):
    w = World(s, d)
    out = provenance.trace(w.gold.links, w.gold.articles, w.events.filter("ActionGeo_CountryCode <> 'F03'"), w.mentions, w.profiles)
    return hexed(out).select("user_id", "display_name", "doc_id", "global_event_id", "silver")


TITLE = "trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g'))"


@query("j13_enrich", f"""select url, t as article_title, case when t <> '' then 1 else 0 end as enriched, count(*) as n from (select url, {TITLE} as t from (select url, min(html) as html from pages group by url)) group by all
 union all select 'http://none.example.com', '', 0, 1""")
def _(s, d):
    w = World(s, d)
    m = w.pages.select(c("url").alias("MentionIdentifier")).distinct().unionByName(s.sql("select 'http://none.example.com' as MentionIdentifier"))
    return silver.enrich(m, feeds.page_titles(w.pages)).groupBy(c("MentionIdentifier").alias("url"), "article_title", "enriched").agg(F.count(F.lit(1)).alias("n"))


# --- aggregates and versions ---------------------------------------------------------------------------------------
@query("a01_watermark", "select nullif(max(DATEADDED), 0) as watermark from ev", "ev")
def _(s, d):
    return silver.watermark(World(s, d).events)


@query("a02_bounds", "select min(GLOBALEVENTID) as low, max(GLOBALEVENTID) as high from ev", "ev")
def _(s, d):
    return silver.bounds(World(s, d).events)


@query("a03_latest_events", "select GLOBALEVENTID, ActionGeo_CountryCode, DATEADDED, NumArticles from ev", "ev")
def _(s, d):
    return World(s, d).fresh_silver()[0].select("GLOBALEVENTID", "ActionGeo_CountryCode", "DATEADDED", "NumArticles")


@query("a03_latest_mentions", "select GLOBALEVENTID, MentionIdentifier, enriched, article_title, MentionTimeDate from mn", "mn")
def _(s, d):
    return World(s, d).fresh_silver()[1].select("GLOBALEVENTID", "MentionIdentifier", "enriched", "article_title", "MentionTimeDate")


EXPIRED = f"""select GLOBALEVENTID from mn group by 1 having max(MentionTimeDate) <> '' and max(MentionTimeDate) < '{X.CUTOFF}' union
 (select GLOBALEVENTID from ev group by 1 having max(cast(DATEADDED as varchar)) < '{X.CUTOFF}' except select GLOBALEVENTID from mn group by 1 having max(MentionTimeDate) <> '')"""


@query("a04_expired_ids", EXPIRED, "mn", "ev")
def _(s, d):
    w = World(s, d)
    return silver.expired_ids(w.events, w.mentions, X.CUTOFF)


@query("j07_retention", f"""with gone as ({EXPIRED}) select 'events' as t, count(*) as n from ev where GLOBALEVENTID not in (select * from gone) union all select 'mentions', count(*) from mn where GLOBALEVENTID not in (select * from gone)
 union all select 'articles', count(*) from (select distinct doc_id, global_event_id from links) where cast(global_event_id as bigint) not in (select * from gone)
 union all select 'links', count(*) from links where cast(global_event_id as bigint) not in (select * from gone)
 union all select 'tags', count(*) from tags where cast(global_event_id as bigint) not in (select * from gone)""".replace("with gone as", "select * from (with gone as", 1) + ")", "mn", "ev", "links", "tags")
def _(s, d):
    w = World(s, d)
    e, m, g, t = P.retention(w.events, w.mentions, w.gold, w.tags, X.CUTOFF)
    n = lambda df, t: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("t"), "n")
    return n(e, "events").unionByName(n(m, "mentions")).unionByName(n(g.articles, "articles")).unionByName(n(g.links, "links")).unionByName(n(t.select(F.explode("tags")), "tags"))


@query("k19_drop_tags", f"select user_id, global_event_id, tag from tags where cast(global_event_id as bigint) not in ({EXPIRED})", "tags", "mn", "ev")
def _(s, d):
    w = World(s, d)
    return gold.drop_tags(w.tags, silver.expired_ids(w.events, w.mentions, X.CUTOFF)).select("user_id", F.explode("tags").alias("global_event_id", "tag"))


@query("a05_present_ids", "select distinct cast(GLOBALEVENTID as bigint) as GLOBALEVENTID from bm where cast(GLOBALEVENTID as bigint) in (select GLOBALEVENTID from ev)", "bm", "ev")
def _(s, d):
    w = World(s, d)
    return silver.present_ids(w.events, w.bronze_mentions.select(c("GLOBALEVENTID").cast("bigint").alias("GLOBALEVENTID")))


@query("a06_catalogue", f"""select doc_id, global_event_id, url, headline, country, country_code, latitude, longitude, cameo_code, cameo_label, actor, '' as risk_category, goldstein, cast(event_date as varchar) as event_date,
 {T_SQL.format('date_added')}, confidence, in_raw_text, mention_doc_tone, {T_SQL.format('mention_time')} from cat""", "cat")
def _(s, d):
    out = hexed(World(s, d).fresh_catalogue())
    return out.select("doc_id", "global_event_id", "url", "headline", "country", "country_code", "latitude", "longitude", "cameo_code", "cameo_label", "actor", "risk_category", "goldstein", c("event_date").cast("string").alias("event_date"), text_time("date_added"), "confidence", "in_raw_text", "mention_doc_tone", text_time("mention_time"))


CARD_SQL = f"user_id, global_event_id, card_title, top_article_url, country, latitude, cameo_label, goldstein, cast(event_date as varchar) as event_date, age_days, max_confidence, inrawtext_filtered, {T_SQL.format('oldest_article_time')}, n_articles"


def card_columns(df: DataFrame) -> DataFrame:
    return df.select("user_id", "global_event_id", "card_title", "top_article_url", "country", "latitude", "cameo_label", "goldstein", c("event_date").cast("string").alias("event_date"), "age_days", "max_confidence", "inrawtext_filtered", text_time("oldest_article_time"), "n_articles")


@query("a07_cards", f"select {CARD_SQL} from cards", "cards")
def _(s, d):
    return card_columns(World(s, d).cards)


@query("a09_heat_map", """select user_id, country, first(latitude order by oldest_article_time desc nulls last, global_event_id) as latitude, first(longitude order by oldest_article_time desc nulls last, global_event_id) as longitude, sum(greatest(n_articles, 1))::bigint as event_count
 from cards where latitude is not null and longitude is not null and country is not null and coalesce(tag, '') <> 'archive' group by user_id, country, round(latitude, 4), round(longitude, 4)""", "cards")
def _(s, d):
    w = World(s, d)
    return P.events_summary(w.gold, w.tags, X.AS_OF)


@query("a10_fingerprint", "select user_id, count(*)::varchar || ':' || sum(('0x' || substr(md5(doc_id || '|' || global_event_id), 1, 15))::hugeint)::varchar as fingerprint from links group by user_id", "links")
def _(s, d):
    return gold.fingerprint(World(s, d).gold.links)


@query("a10_fingerprint_empty", "select '0:' as fingerprint")
def _(s, d):
    return gold.fingerprint_of(World(s, d).gold.links, "u6")


GROUPED = """select user_id, arg_max(global_event_id, (event_date, date_added, max_confidence, n)) as global_event_id, arg_max(card_title, (event_date, date_added, max_confidence, n)) as card_title,
 arg_max(coalesce(tag, ''), (event_date, date_added, max_confidence, n)) as tag, string_agg(n::varchar, ',' order by n desc) as event_ids, count(*) as n_events from (
 select *, cast(global_event_id as bigint) as n, list_sort(list_distinct(headlines)) as g from cards) group by user_id, g"""


@query("a11_grouped_cards", GROUPED, "cards")
def _(s, d):
    g = C.group_same_headlines(World(s, d).cards)
    return g.select("user_id", "global_event_id", "card_title", F.coalesce("tag", F.lit("")).alias("tag"), F.array_join(c("event_ids").cast("array<string>"), ",").alias("event_ids"), "n_events")


@query("f21_visible_groups", f"select user_id, global_event_id, n_events from ({GROUPED}) where tag <> 'archive'", "cards")
def _(s, d):
    return C.visible_groups(C.group_same_headlines(World(s, d).cards)).select("user_id", "global_event_id", "n_events")


@query("a12_relevance_reasons", """select GLOBALEVENTID, DATEADDED, case when EventCode in ('1411', '182', '1721') then 'EventCode=' || EventCode when EventRootCode in ('14', '18', '17') then 'EventRootCode=' || EventRootCode else '' end as f1,
 case when upper(Actor1Type1Code) in ('BUS', 'GOV') then 'Actor1Type1Code=' || Actor1Type1Code when Actor2KnownGroupCode = 'NATO' then 'Actor2KnownGroupCode=NATO' else '' end as f2,
 case when contains(SOURCEURL, 'airport') then 'airport|port' when contains(SOURCEURL, 'cargo') then 'cargo' else '' end as f3,
 concat_ws('+', case when upper(Actor1Type1Code) in ('BUS', 'GOV') or Actor2KnownGroupCode = 'NATO' then 'F2' end, case when contains(SOURCEURL, 'cargo') or contains(SOURCEURL, 'airport') then 'F3' end) as branch from be""", "be")
def _(s, d):
    return relevance.explain(World(s, d).bronze_events).select("GLOBALEVENTID", "DATEADDED", "f1", "f2", "f3", "branch")


@query("a13_branches", "select concat_ws('+', case when f2 then 'F2' end, case when f3 then 'F3' end) as branch, count(*) as n from flags where f1 and (f2 or f3) and f4 group by 1", "flags")
def _(s, d):
    b = World(s, d).bronze_events
    return provenance.distribution(relevance.explain(b.filter(relevance.is_relevant(b))), "branch")


GEO_FIELDS = (("CAMEO", "Actor1CountryCode", "N"), ("CAMEO", "Actor2CountryCode", "N"), ("FIPS", "ActionGeo_CountryCode", "F"), ("FIPS", "Actor1Geo_CountryCode", "F"), ("FIPS", "Actor2Geo_CountryCode", "F"))
GEO_HITS = ", ".join(f"case when {f} in ('{k}01', '{k}07') then struct_pack(s := '{system}', f := '{f}', c := {f}) end" for system, f, k in GEO_FIELDS)


@query("a12_geo_reasons", f"""select GLOBALEVENTID, ActionGeo_CountryCode, array_to_string(list_filter([list_position(list_transform(h, lambda x: x.s), 'CAMEO') > 0, list_position(list_transform(h, lambda x: x.s), 'FIPS') > 0], lambda b: b), '') as n,
 concat_ws('|', case when list_contains(list_transform(h, lambda x: x.s), 'CAMEO') then 'CAMEO' end, case when list_contains(list_transform(h, lambda x: x.s), 'FIPS') then 'FIPS' end) as geo_match_system,
 array_to_string(list_transform(h, lambda x: x.f), '|') as geo_match_field from (select *, list_filter([{GEO_HITS}], lambda x: x is not null) as h from ev)""".replace("""array_to_string(list_filter([list_position(list_transform(h, lambda x: x.s), 'CAMEO') > 0, list_position(list_transform(h, lambda x: x.s), 'FIPS') > 0], lambda b: b), '') as n,
 """, ""), "ev")
def _(s, d):
    lit = lambda *v: F.array(*map(F.lit, v))
    found = provenance.geo_match(lit("N01", "N07"), lit("F01", "F07"))
    return World(s, d).events.select("GLOBALEVENTID", "ActionGeo_CountryCode", *(found[f"geo_match_{n}"].alias(f"geo_match_{n}") for n in ("system", "field")))


@query("a12_keyword_reasons", """, spelled as (select * from (values ('u1', 1, 'bolts', 'bolts'), ('u1', 2, 'hot gear', 'hot-gear'), ('u1', 3, 'red widgets', 'red-widgets'), ('u3', 1, 'R&D', 'r-and-d'),
  ('u3', 2, 'R&D', 'rd'), ('u3', 3, 'blue bolt', 'blue-bolt'), ('u3', 4, 'small ring', 'small-ring')) as t(user_id, pos, k, v)),
 stemmed as (select * from (values ('u1', 1, 'bolts', ['bolt']), ('u1', 2, 'hot gear', ['hot', 'gear']), ('u1', 3, 'red widgets', ['red', 'widget']), ('u3', 1, 'R&D', ['r', 'd']),
  ('u3', 2, 'blue bolt', ['blue', 'bolt']), ('u3', 3, 'small ring', ['small', 'ring'])) as t(user_id, pos, k, v)),
 hits as (select user_id, doc_id, global_event_id, 0 as stage, pos, k, v as t, 'url' as f from ua join spelled using (user_id) where contains(lower(url), v) union all
  select user_id, doc_id, global_event_id, 1, pos, k, array_to_string(v, ' + '), case when list_has_all({tokens}, v) then 'article_title' else 'article_keywords' end from ua join stemmed using (user_id) where list_has_all(row_tokens, v)),
 best as (select * from (select *, row_number() over (partition by user_id, doc_id, global_event_id order by stage, pos) as n from hits) where n = 1)
 select ua.user_id, ua.doc_id, ua.global_event_id, case when ua.user_id in ('u2', 'u4', 'u5') then '(no keywords set)' else coalesce(k, '(no current keyword matches)') end as keyword_matched,
  coalesce(t, '') as keyword_tokens, case when ua.user_id in ('u2', 'u4', 'u5') then '(unfiltered)' else coalesce(f, '(stale gold row)') end as keyword_match_field
 from ua left join best using (user_id, doc_id, global_event_id)""".replace("{tokens}", TOKENS_SQL.format("article_title")), "ua")
def _(s, d):
    w = World(s, d)
    pairs = w.gold.links.join(w.gold.articles.select("doc_id", "global_event_id", "url", "article_title", "article_keywords"), ["doc_id", "global_event_id"])
    out = provenance.keyword_match(pairs.select("user_id", "doc_id", "global_event_id", "url", "article_title", "article_keywords"), w.profiles)
    return hexed(out).select("user_id", "doc_id", "global_event_id", "keyword_matched", "keyword_tokens", "keyword_match_field")


@query("a14_unique_urls", "select MentionTimeDate as slice, count(distinct MentionIdentifier) as urls from bm group by 1", "bm")
def _(s, d):
    return World(s, d).bronze_mentions.groupBy(c("MentionTimeDate").alias("slice")).agg(F.countDistinct("MentionIdentifier").alias("urls"))


@query("a15_slice_report", "select count(*) as seen, (count(*) filter (where ok))::bigint as kept, (count(*) filter (where ok and enriched = 1))::bigint as enriched, (count(*) filter (where not ok))::bigint as dropped from (select enriched, cast(GLOBALEVENTID as bigint) in (select GLOBALEVENTID from ev) as ok from bm)", "bm", "ev")
def _(s, d):
    w = World(s, d)
    return validate.slice_report(w.bronze_mentions, validate.referential(w.bronze_mentions, w.events))


@query("a16_slice_gaps", """select slice, cast((epoch(t) - epoch(prev)) / 900 - 1 as int) as missing, strftime(prev + interval 15 minutes, '%Y%m%d%H%M%S') as first_missing from (
 select slice, strptime(slice, '%Y%m%d%H%M%S') as t, lag(strptime(slice, '%Y%m%d%H%M%S')) over (order by slice) as prev from (select distinct DATEADDED as slice from be))
 where epoch(t) - epoch(prev) > 900""", "be")
def _(s, d):
    return silver.slice_gaps(World(s, d).bronze_events.select(c("DATEADDED").alias("slice")))


@query("a18_profile_overlap", "select a.user_id as user_a, b.user_id as user_b, count(distinct lower(a.keyword)) as shared from w2 a join w2 b on lower(a.keyword) = lower(b.keyword) and a.user_id < b.user_id group by all".replace("w2", "(select user_id, keyword from words union all select 'u7', 'Bolts' union all select 'u7', 'hot gear')"), "words")
def _(s, d):
    p = World(s, d).profiles.select("user_id", "keywords")
    return profiles.overlap(p.unionByName(s.sql("select 'u7' as user_id, map('q', array('Bolts', 'hot gear')) as keywords")))


# --- order, top-k, sets --------------------------------------------------------------------------------------------
@query("w01_article_order", "select user_id, global_event_id, url, row_number() over (partition by user_id, global_event_id order by coalesce(confidence, -1) desc, abs(mention_doc_tone) asc nulls last, url) as place from recent", "recent")
def _(s, d):
    from pyspark.sql import Window

    return World(s, d).recent.select("user_id", "global_event_id", "url", F.row_number().over(Window.partitionBy(*C.CARD).orderBy(*C.article_order())).alias("place"))


@query("w02_top_articles", "select user_id, global_event_id, url, place from ranked", "ranked")
def _(s, d):
    return C.ranked_articles(C.prefer_raw_text(World(s, d).recent)).select("user_id", "global_event_id", "url", "place")


@query("w03_title_dedup", "select country, count(*) as n, string_agg(doc_id, ',' order by place) as ids from (select *, row_number() over (partition by country order by doc_id) as place from (select country, headline, min(doc_id) as doc_id from (select country, lower(trim(regexp_replace(headline, '\\s+', ' ', 'g'))) as headline, doc_id || global_event_id as doc_id from cat) group by all)) where place <= 3 group by country", "cat")
def _(s, d):
    from pyspark.sql import Window

    out = hexed(World(s, d).catalogue).select("country", T.title_key(c("headline")).alias("headline"), F.concat("doc_id", "global_event_id").alias("doc_id"))
    first = silver.latest(out, ["country", "headline"], F.asc("doc_id")).withColumn("place", F.row_number().over(Window.partitionBy("country").orderBy("doc_id"))).filter("place <= 3")
    return first.groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("ids"))


@query("w04_card_order", "select user_id, global_event_id, row_number() over (partition by user_id order by oldest_article_time desc nulls last, global_event_id) as place from cards", "cards")
def _(s, d):
    return World(s, d).cards.select("user_id", "global_event_id", C.card_rank().alias("place"))


@query("w05_grouped_order", f"select user_id, global_event_id, row_number() over (partition by user_id order by oldest_article_time desc nulls last, event_date desc nulls last, goldstein asc nulls last, global_event_id) as place from (select user_id, global_event_id, event_date, goldstein, oldest_article_time from cards join ({GROUPED}) using (user_id, global_event_id))", "cards")
def _(s, d):
    return C.group_same_headlines(World(s, d).cards).select("user_id", "global_event_id", C.grouped_rank().alias("place"))


@query("w07_newest_slices", "select distinct DATEADDED as slice from be order by 1 desc limit 10", "be")
def _(s, d):
    return World(s, d).bronze_events.select(c("DATEADDED").alias("slice")).distinct().orderBy(F.desc("slice")).limit(10)


@query("w09_preview", "select user_id, global_event_id, array_to_string(headlines[1:3], ' / ') as preview, case when n_articles >= 20 then '≥20' else n_articles::varchar end as shown_count from cards", "cards")
def _(s, d):
    return C.preview(World(s, d).cards).select("user_id", "global_event_id", F.array_join(c("preview.headline"), " / ").alias("preview"), "shown_count")


@query("w10_card_title", """select user_id, global_event_id, coalesce(list_filter(headlines, lambda h: not starts_with(h, '(No article title) '))[1], '"' || regexp_replace(cameo_label, ', not specified below$', '') || '" type of event') as title from cards""", "cards")
def _(s, d):
    return World(s, d).cards.select("user_id", "global_event_id", C.title_of(c("articles"), c("cameo_label")).alias("title"))


@query("p06_card_table", "select user_id, global_event_id, card_title, country, cast(event_date as varchar) as date, coalesce(tag, 'No tag') as tag, top_article_url from cards", "cards")
def _(s, d):
    return C.table_rows(World(s, d).cards)


@query("u02_id_difference", "select distinct cast(GLOBALEVENTID as bigint) as GLOBALEVENTID from bm where cast(GLOBALEVENTID as bigint) not in (select GLOBALEVENTID from ev)", "bm", "ev")
def _(s, d):
    w = World(s, d)
    ids = w.bronze_mentions.select(S.id_or_zero(c("GLOBALEVENTID")).alias("GLOBALEVENTID"))
    return ids.exceptAll(ids.join(w.events, "GLOBALEVENTID", "left_semi")).distinct()


@query("u04_slice_union", "select DATEADDED as slice from be union select MentionTimeDate from bm", "be", "bm")
def _(s, d):
    w = World(s, d)
    return w.bronze_events.select(c("DATEADDED").alias("slice")).union(w.bronze_mentions.select("MentionTimeDate")).distinct()


@query("u07_shared_keywords", "select 'hot gear' as keyword")
def _(s, d):
    k = matching.user_keywords(World(s, d).profiles)
    return k.filter("user_id = 'u1'").select("keyword").intersect(s.sql("select * from values ('hot gear'), ('cold gear') as t(keyword)"))


# --- scalar functions ----------------------------------------------------------------------------------------------
RAW_TEXT = "select * from values (' a '), ('nan'), ('NaN '), (null), (''), ('x y') as t(v)"


@query("c01_safe_string", "select v, case when lower(trim(coalesce(v, ''))) = 'nan' then '' else trim(coalesce(v, '')) end as clean from (values (' a '), ('nan'), ('NaN '), (null), (''), ('x y')) as t(v)")
def _(s, d):
    return s.sql(RAW_TEXT).select("v", T.safe_string(c("v")).alias("clean"))


@query("c02_id_or_zero", "select GLOBALEVENTID, coalesce(try_cast(trim(v) as bigint), 0) as id from (select GLOBALEVENTID, case cast(GLOBALEVENTID as bigint) % 4 when 0 then 'x' || GLOBALEVENTID when 1 then ' ' || GLOBALEVENTID when 2 then '' else GLOBALEVENTID end as v from be)", "be")
def _(s, d):
    n = c("GLOBALEVENTID").cast("bigint") % 4
    v = F.when(n == 0, F.concat(F.lit("x"), c("GLOBALEVENTID"))).when(n == 1, F.concat(F.lit(" "), c("GLOBALEVENTID"))).when(n == 2, "").otherwise(c("GLOBALEVENTID"))
    return World(s, d).bronze_events.select("GLOBALEVENTID", S.id_or_zero(v).alias("id"))


@query("c03_truthy", "select * from (values ('1', true), ('TRUE', true), (' t ', true), ('Yes', true), ('0', false), ('no', false), (null, false)) as t(v, flag)")
def _(s, d):
    return s.sql("select * from values ('1'), ('TRUE'), (' t '), ('Yes'), ('0'), ('no'), (null) as t(v)").select("v", S.truthy(c("v")).alias("flag"))


@query("c04_doc_id", "select url, sha256(url) as doc_id from pages")
def _(s, d):
    return hexed(World(s, d).pages.select("url", S.doc_id(c("url")).alias("doc_id")))


@query("c06_country", "select ActionGeo_FullName, ActionGeo_CountryCode, case when trim(split_part(ActionGeo_FullName, ',', -1)) <> '' then trim(split_part(ActionGeo_FullName, ',', -1)) else ActionGeo_CountryCode end as country from be", "be")
def _(s, d):
    return World(s, d).bronze_events.select("ActionGeo_FullName", "ActionGeo_CountryCode", S.country(c("ActionGeo_FullName"), c("ActionGeo_CountryCode")).alias("country"))


@query("c07_dates", f"select GLOBALEVENTID, cast(strptime(Day, '%Y%m%d') as date)::varchar as event_date, datediff('day', strptime(Day, '%Y%m%d')::date, date '{X.AS_OF}') as age from be", "be")
def _(s, d):
    return World(s, d).bronze_events.select("GLOBALEVENTID", S.day(c("Day")).cast("string").alias("event_date"), S.age_days(X.AS_OF, S.day(c("Day"))).alias("age"))


@query("c08_stamps", "select v, strftime(try_strptime(v, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') as t from (values ('20240131094500'), ('20261332000000'), (''), ('202401310945')) as t(v)")
def _(s, d):
    return s.sql("select * from values ('20240131094500'), ('20261332000000'), (''), ('202401310945') as t(v)").select("v", F.date_format(S.stamp(c("v")), "yyyy-MM-dd HH:mm:ss").alias("t"))


@query("c10_numbers", "select v, cast(trunc(try_cast(v as double)) as int) as whole, try_cast(v as double) as number from (values ('85.5'), ('-3.9'), (''), ('x'), ('12')) as t(v)")
def _(s, d):
    return s.sql("select * from values ('85.5'), ('-3.9'), (''), ('x'), ('12') as t(v)").select("v", S.whole(c("v")).alias("whole"), S.number(c("v")).alias("number"))


@query("c12_label_display", "select lookup_code, regexp_replace(lookup_label, ', not specified below$', '') as shown from labels", "labels")
def _(s, d):
    return X.labels(s).select("lookup_code", T.label_display(c("lookup_label")).alias("shown"))


KEYWORDS_SQL = "('oil & gas'), ('R&D'), ('C++'), ('price > cost!'), ('A & B + C'), ('  Two  Words '), ('gas'), ('silicon wafers'), ('burn-in boards'), ('TSMC'), ('')"


@query("c13_url_variants", """select * from (values ('oil & gas', 'oil-and-gas,oil-gas'), ('R&D', 'r-and-d,rd'), ('C++', 'c,c--'), ('price > cost!', 'price-cost,pricecost'), ('A & B + C', 'a-and-b-c,a-and-bc,a-b-c,a-bc'),
 ('  Two  Words ', 'two-words'), ('gas', 'gas'), ('silicon wafers', 'silicon-wafers'), ('burn-in boards', 'burn-in-boards'), ('TSMC', 'tsmc'), ('', '')) as t(k, v)""")
def _(s, d):
    return s.sql(f"select * from values {KEYWORDS_SQL} as t(k)").select("k", F.array_join(T.url_variants(c("k")), ",").alias("v"))


@query("c14_light_normalise", "select v, regexp_replace(trim(v), ' +', ' ', 'g') as n from (values (' a  b '), ('A   + B')) as t(v)")
def _(s, d):
    return s.sql("select * from values (' a  b '), ('A   + B') as t(v)").select("v", T.light_normalise(c("v")).alias("n"))


@query("c15_keyword_tokens", """select * from (values ('oil & gas', 'oil,gas'), ('R&D', 'r,d'), ('C++', 'c'), ('price > cost!', 'price,cost'), ('A & B + C', 'a,b,c'), ('  Two  Words ', 'two,words'), ('gas', 'gas'),
 ('silicon wafers', 'silicon,wafers'), ('burn-in boards', 'burn,boards'), ('TSMC', 'tsmc'), ('', '')) as t(k, v)""")
def _(s, d):
    return s.sql(f"select * from values {KEYWORDS_SQL} as t(k)").select("k", F.array_join(T.keyword_tokens(c("k")), ",").alias("v"))




@query("c16_stems", f"select token, count(*) as n from (select unnest({TOKENS_SQL.format('text')}) as token from documents) group by token")
def _(s, d):
    return World(s, d).documents.select(F.explode(F.transform(T.split_tokens(c("text")), T.stem)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("c17_row_tokens", "select doc_id, global_event_id, array_to_string(list_sort(row_tokens), ' ') as tokens from cat", "cat")
def _(s, d):
    return hexed(World(s, d).catalogue).select("doc_id", "global_event_id", F.array_join(F.array_sort("row_tokens"), " ").alias("tokens"))


@query("c18_has_all", f"select doc_id, list_has_all(t, ['the', 'of']) as both, list_has_any(t, ['of', 'was']) as either from (select doc_id, {TOKENS_SQL.format('text')} as t from documents)")
def _(s, d):
    t = F.transform(T.split_tokens(c("text")), T.stem)
    lit = lambda *v: F.array(*map(F.lit, v))
    return World(s, d).documents.select("doc_id", T.has_all(t, lit("the", "of")).alias("both"), F.arrays_overlap(t, lit("of", "was")).alias("either"))


@query("c20_risk_score", """select GLOBALEVENTID, DATEADDED, round(least((10 - g) / 2 + least(log10(greatest(n, 1)), 2) / 2 + least(abs(least(t, 0)) / 20, 1), 10), 2) as score from (select GLOBALEVENTID, DATEADDED, cast(GoldsteinScale as double) as g, cast(NumArticles as double) as n, coalesce(try_cast(AvgTone as double), 0) as t from be)""", "be")
def _(s, d):
    return World(s, d).bronze_events.select("GLOBALEVENTID", "DATEADDED", S.risk_score(c("GoldsteinScale"), c("NumArticles"), c("AvgTone")).alias("score"))


@query("c21_legacy_events", """select GLOBALEVENTID as event_id, Day as date, EventCode as event_code, Actor1Name as actor1, ActionGeo_CountryCode as country_code, '' as fips_country, coalesce(try_cast(ActionGeo_Lat as double), 0) as lat,
 cast(GoldsteinScale as double) as goldstein, cast(NumArticles as int) as num_articles, round(least((10 - cast(GoldsteinScale as double)) / 2 + least(log10(greatest(cast(NumArticles as double), 1)), 2) / 2 + least(abs(least(coalesce(try_cast(AvgTone as double), 0), 0)) / 20, 1), 10), 2) as risk_score, SOURCEURL as source_url from be""", "be")
def _(s, d):
    return legacy.events(World(s, d).bronze_events).select("event_id", "date", "event_code", "actor1", "country_code", "fips_country", "lat", "goldstein", "num_articles", "risk_score", "source_url")


@query("c21_legacy_mentions", "select GLOBALEVENTID as event_id, MentionTimeDate as mention_time, MentionIdentifier as mention_url, coalesce(try_cast(Confidence as double), 0) as confidence, cast(MentionDocTone as double) as doc_tone, false as enriched from bm", "bm")
def _(s, d):
    return legacy.mentions(World(s, d).bronze_mentions).select("event_id", "mention_time", "mention_url", "confidence", "doc_tone", "enriched")


@query("a17_slice_timing", """select kind, count(*) as slices, sum(rows)::bigint as rows, max(epoch(stored) - epoch(first_seen))::bigint as slowest_s from (select kind, count(*) as rows, strptime(slice, '%Y%m%d%H%M%S') + interval 90 seconds as first_seen,
 strptime(slice, '%Y%m%d%H%M%S') + interval 90 seconds + to_seconds(count(*)) as stored from (select 'events' as kind, DATEADDED as slice from be union all select 'mentions', MentionTimeDate from bm) group by kind, slice) group by kind""", "be", "bm")
def _(s, d):
    w = World(s, d)
    seen = w.bronze_events.select(F.lit("events").alias("kind"), c("DATEADDED").alias("slice")).unionByName(w.bronze_mentions.select(F.lit("mentions").alias("kind"), c("MentionTimeDate").alias("slice")))
    seen = seen.groupBy("kind", "slice").agg(F.count(F.lit(1)).alias("rows")).withColumn("first_seen", S.stamp(c("slice")).cast("timestamp") + F.expr("interval 90 seconds"))
    seen = seen.withColumn("stored", F.timestamp_seconds(F.unix_timestamp("first_seen") + c("rows")))
    return monitoring.load_report(monitoring.slice_timing(seen))


@query("c24_slice_floor", "select event_id, strftime(time_bucket(interval 15 minutes, ts), '%Y%m%d%H%M%S') as slice from events")
def _(s, d):
    return s.read.parquet(f"{d}/events.parquet").select("event_id", S.slice_id(c("ts")).alias("slice"))


@query("c25_lag_light", "select event_id, cast(floor((epoch(timestamp '2024-02-01 00:00:00') - epoch(ts)) / 900) as bigint) as lag, case when floor((epoch(timestamp '2024-02-01 00:00:00') - epoch(ts)) / 900) <= 1 then 'green' when floor((epoch(timestamp '2024-02-01 00:00:00') - epoch(ts)) / 900) = 2 then 'yellow' else 'red' end as light from (select event_id, date_trunc('second', ts) as ts from events)")
def _(s, d):
    lag = S.lag_slices(F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"), c("ts"))
    return s.read.parquet(f"{d}/events.parquet").select("event_id", lag.cast("bigint").alias("lag"), S.lag_light(lag).alias("light"))


@query("c27_months", "select substr(Day, 1, 6) as month, count(*) as n from be group by 1", "be")
def _(s, d):
    return World(s, d).bronze_events.groupBy(S.month_of(c("Day")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("c29_json", "select event_id, cast(json_extract(props, '$.k') as int) as k from events")
def _(s, d):
    return s.read.parquet(f"{d}/events.parquet").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


STATUS_SQL = "('OK', timestamp '2024-01-01 10:00:00', true, true), ('OK', timestamp '2024-01-01 08:00:00', true, true), ('ERROR', timestamp '2024-01-01 10:00:00', true, true), ('OK', timestamp '2024-01-01 10:00:00', false, true), ('ERROR', null, true, false)"


@query("c31_status", """select status, up, profiles, case when not up then 'STORE-DOWN' when not profiles then 'PROFILE-STORE-DOWN' when stale <> 'OK' then stale else 'OK' end as overall, updated is null as never from (
 select *, case when status = 'OK' and epoch(timestamp '2024-01-01 10:30:00') - epoch(updated) > 3600 then 'STALE-PIPELINE' else status end as stale from (values """ + STATUS_SQL + ") as t(status, updated, up, profiles))")
def _(s, d):
    t = s.sql(f"select * from values {STATUS_SQL.replace('timestamp ', 'timestamp_ntz ')} as t(status, updated, up, profiles)")
    stale = S.stale_status(c("status"), c("updated"), "2024-01-01 10:30:00")
    return t.select("status", "up", "profiles", S.overall_status(c("up"), c("profiles"), stale).alias("overall"), S.never_built(F.lit(""), c("updated")).alias("never"))


@query("c33_tag_colour", "select user_id, global_event_id, case tag when 'requires_action' then 'red' when 'monitor' then 'orange' when 'archive' then 'green' else 'none' end as colour from tags", "tags")
def _(s, d):
    return World(s, d).tags.select("user_id", F.explode("tags").alias("global_event_id", "tag")).select("user_id", "global_event_id", S.tag_colour(c("tag")).alias("colour"))


@query("c34_card_notes", "select user_id, global_event_id, bool_and(coalesce(in_raw_text = 0, false)) as all_inferred, bool_or(filtered) as inrawtext_filtered from ranked group by 1, 2", "ranked")
def _(s, d):
    return C.notes(World(s, d).cards)


# --- gold merges ---------------------------------------------------------------------------------------------------
def halves(w: World) -> tuple[DataFrame, DataFrame]:
    """Old and new articles: two overlapping parts of the catalogue, the new one with other headlines."""
    a = hexed(w.catalogue).select("doc_id", "global_event_id", "headline")
    n = c("global_event_id").cast("bigint")
    return a.filter(n % 3 < 2), a.filter(n % 3 > 0).withColumn("headline", F.concat(F.lit("new "), c("headline")))


@query("k07_upsert", "select doc_id, global_event_id, case when cast(global_event_id as bigint) % 3 > 0 then 'new ' || headline else headline end as headline from cat", "cat")
def _(s, d):
    return gold.upsert(*halves(World(s, d)))


@query("k08_replace_users", "select user_id, doc_id, global_event_id from links where user_id not in ('u1', 'u2') union all select user_id, doc_id, global_event_id from links where user_id = 'u1' and cast(global_event_id as bigint) % 2 = 0", "links")
def _(s, d):
    g = World(s, d).gold.links
    new = g.filter((c("user_id") == "u1") & (c("global_event_id").cast("bigint") % 2 == 0))
    return hexed(gold.replace_users(g, new, s.sql("select * from values ('u1'), ('u2') as t(user_id)")))


@query("k09_insert_absent", "select user_id, doc_id, global_event_id from links", "links")
def _(s, d):
    g = World(s, d).gold.links
    n = c("global_event_id").cast("bigint")
    return hexed(gold.insert_absent(g.filter(n % 3 < 2), g.filter(n % 3 > 0)))


@query("k10_status", "select 'OK' as status, '2024-02-01 00:00:00' as timestamp_of_last_update, '20240131000000' as silver_watermark")
def _(s, d):
    old = s.sql("select 'ERROR' as status, '2024-01-31' as timestamp_of_last_update, '20240131000000' as silver_watermark")
    return gold.pipeline_status(gold.mark_error(old), "OK", "2024-02-01 00:00:00")


@query("k12_sweep", "select doc_id, global_event_id from cat where (doc_id, global_event_id) in (select doc_id, global_event_id from links where user_id in ('u1', 'u2')) or global_event_id in (select global_event_id from tags where tag in ('requires_action', 'monitor'))", "cat", "links", "tags")
def _(s, d):
    w = World(s, d)
    return hexed(gold.without_orphans(w.catalogue, w.gold.links.filter("user_id in ('u1', 'u2')"), gold.protected_events(w.tags))).select("doc_id", "global_event_id")


@query("k13_set_tag", "select user_id, global_event_id, case when user_id = 'u1' and global_event_id in ('8', '15') then null else tag end as tag from tags", "tags")
def _(s, d):
    return gold.set_tag(World(s, d).tags, "u1", ["8", "15"], None).select("user_id", F.explode("tags").alias("global_event_id", "tag"))


@query("k13_save_profile", "select user_id, case when user_id = 'u2' then 'Second' else upper(user_id) end as display_name from users", "users")
def _(s, d):
    p = World(s, d).profiles
    return gold.save_profile(p, p.filter("user_id = 'u2'").withColumn("display_name", F.lit("Second"))).select("user_id", "display_name")


@query("k16_dead_letters", "select DATEADDED || '.csv' as file_name, '2024-02-01' as dead_letter_day, '12:30:00' as dead_letter_time from (select distinct DATEADDED from be order by DATEADDED limit 10000)", "be")
def _(s, d):
    f = World(s, d).bronze_events.select(F.concat("DATEADDED", F.lit(".csv")).alias("file_name")).distinct()
    return sinks.dead_letters(f, "2024-02-01 12:30:00")


@query("k20_added_column", "select doc_id, global_event_id, null::varchar as extra from cat where cast(global_event_id as bigint) % 3 < 2", "cat")
def _(s, d):
    old, new = halves(World(s, d))
    return gold.add_missing_columns(old, new.withColumn("extra", F.lit("x"))).select("doc_id", "global_event_id", "extra")


@query("x_first_login", "select 'u9' as user_id")
def _(s, d):
    return gold.first_login(World(s, d).profiles, s.sql("select * from values ('u1'), ('u9') as t(user_id)"))


# --- plans and serving ---------------------------------------------------------------------------------------------
@query("t07_incremental_publish", "select user_id, doc_id, global_event_id from links", "links")
def _(s, d):
    w = World(s, d)
    old_mentions = w.mentions.filter("MentionTimeDate <= '20240115000000'")
    old = P.recompute(w.events, old_mentions, w.labels, w.profiles, w.territories)
    new = P.recompute(w.events, w.mentions, w.labels, w.profiles, w.territories, since="20240115000000")
    return hexed(P.publish(old, new, w.profiles, False, None).links)


@query("x_one_user", "select user_id, doc_id, global_event_id from links where user_id = 'u2'", "links")
def _(s, d):
    w = World(s, d)
    return hexed(P.recompute(w.events, w.mentions, w.labels, w.profiles, w.territories, only_user="u2", relational=True).links)


@query("x_list_events", f"select {CARD_SQL} from cards where user_id = 'u2' and age_days <= 25 and age_days > 5 and coalesce(tag, '') <> 'archive'", "cards")
def _(s, d):
    w = World(s, d)
    return card_columns(P.list_events(w.gold, w.tags, "u2", X.AS_OF, briefing_days=25, min_age_days=5))


@query("x_one_event", f"select {CARD_SQL} from cards where user_id = 'u4' and global_event_id = (select min(global_event_id) from cards where user_id = 'u2')", "cards")
def _(s, d):
    w = World(s, d)
    event = w.gold.links.filter("user_id = 'u2'").agg(F.min("global_event_id")).first()[0]
    return card_columns(P.one_event(w.gold, w.tags, "u4", event, X.AS_OF))


@query("x_tagged_events", "select 'u4' as user_id, global_event_id, count(distinct lower(trim(regexp_replace(headline, '\\s+', ' ', 'g')))) as n_articles from (select *, max(in_raw_text) over (partition by global_event_id) as n_raw from cat where global_event_id in (select global_event_id from tags where user_id = 'u4' and tag = 'monitor')) where n_raw = 0 or in_raw_text = 1 group by 2", "cat", "tags")
def _(s, d):
    w = World(s, d)
    return P.tagged_events(P.Gold(w.catalogue, w.gold.links, "OK"), w.tags, "u4", "monitor", X.AS_OF).select("user_id", "global_event_id", "n_articles")


@query("x03_page_titles", f"select url, {TITLE} as title, {TITLE} <> '' as ok from (select url, min(html) as html from pages group by url)")
def _(s, d):
    return feeds.page_titles(World(s, d).pages).select("url", "title", "ok")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevant events of the last 30 days for one user as cards of at most 20 articles, newest story first."""
    w = World(spark, sf_dir)
    return card_columns(P.list_events(w.gold, w.tags, "u2", X.AS_OF, briefing_days=30))


from . import queries_io  # noqa: E402, F401  registers its queries
