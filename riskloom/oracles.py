"""SQL building blocks of the oracles: named common table expressions that a query puts together."""

from __future__ import annotations

from . import fixtures

_NAMES = {n: n for n in ("events", "nation", "part", "documents")}

# Fixed values of the relevance rules, written down a second time: a wrong list in the engine must not be right here.
_CODES = """'1721', '1722', '1723', '1724', '163', '1631', '1632', '1633', '141', '1411', '1412', '1413', '143', '145', '191', '1911',
 '1912', '180', '182', '1821', '1822', '1823', '171', '172', '173', '175', '1751', '1752', '193', '194', '195', '196'"""
_ROOTS = "'14', '15', '17', '18', '19', '20'"
_TYPES = "'BUS', 'GOV', 'LAB', 'MNC', 'IGO'"
_GROUPS = "'OPEC', 'WTO', 'IMF', 'WORLDBANK', 'EU', 'ASEAN', 'NATO', 'UN'"
_KEYWORD_PATTERN = (
    "port|harbor|harbour|shipping|freight|cargo|cargoescustoms|tariff|logistics|supply chain|supply-chain|supply-side|warehouse|storage|refinery|refineriesfactory|factories|"
    "plant|semiconductor|microchip|oil|gas|pipeline|railway|railroad|airport|tanker|container|avalanche|blizzard|wildfire|bushfire|cold wave|derecho|drought|earthquake|"
    "flash flood|haboob|heat wave|hurricane|lahar|landslide|limnic eruption|polar vortex event|riverine flood|sinkhole|storm surge|tornado|tornadoes|tropical cyclone|tsunami|"
    "typhoon|volcanic eruption|waterspout|inflation|deflation|terrorist attack"
)


def _values(rows, names: str) -> str:
    lit = lambda v: "cast(null as varchar)" if v is None else "'" + v.replace("'", "''") + "'"
    return f"select * from (values {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) as t({names})"


PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "be": (fixtures.BRONZE_EVENTS.format(**_NAMES), ()),
    "bm": (fixtures.BRONZE_MENTIONS.format(**_NAMES), ()),
    "terr": (fixtures.TERRITORIES.format(**_NAMES), ()),
    "labels": (fixtures.LABELS, ()),
    "tags": (_values([(u, e, t) for u, m in fixtures.TAGS.items() for e, t in m.items()], "user_id, global_event_id, tag"), ()),
    "places": (_values([(u, p) for u, (ps, _) in fixtures.PROFILES.items() for p in ps], "user_id, name"), ()),
    "words": (_values([(u, q, k) for u, (_, w) in fixtures.PROFILES.items() for q, ks in w.items() for k in ks], "user_id, question, keyword"), ()),
    "users": (_values([(u,) for u in fixtures.PROFILES], "user_id"), ()),
    "flags": (
        f"""select *, EventCode in ({_CODES}) or EventRootCode in ({_ROOTS}) as f1,
  upper(trim(Actor1Type1Code)) in ({_TYPES}) or upper(trim(Actor2KnownGroupCode)) in ({_GROUPS}) as f2,
  regexp_matches(lower(concat_ws(' ', trim(Actor1Name), trim(Actor2Name), trim(SOURCEURL))), '{_KEYWORD_PATTERN}') as f3, trim(SOURCEURL) <> '' as f4 from be""",
        ("be",),
    ),
    "ev": (
        """select * exclude (k, GLOBALEVENTID, DATEADDED), cast(GLOBALEVENTID as bigint) as GLOBALEVENTID, cast(DATEADDED as bigint) as DATEADDED from (
 select *, row_number() over (partition by GLOBALEVENTID, ActionGeo_CountryCode order by cast(DATEADDED as bigint) desc, cast(NumArticles as bigint) desc, SOURCEURL desc) as k
 from flags where f1 and (f2 or f3) and f4) where k = 1""",
        ("flags",),
    ),
    "mn": (
        """select * exclude (k) from (
 select cast(GLOBALEVENTID as bigint) as GLOBALEVENTID, * exclude (GLOBALEVENTID), row_number() over (partition by GLOBALEVENTID, MentionIdentifier order by enriched desc, MentionTimeDate desc, article_title desc) as k
 from bm where cast(GLOBALEVENTID as bigint) in (select GLOBALEVENTID from ev)) where k = 1""",
        ("bm", "ev"),
    ),
    "cat": (
        """select * exclude (k) from (
 select sha256(MentionIdentifier) as doc_id, cast(m.GLOBALEVENTID as varchar) as global_event_id, MentionIdentifier as url,
  case when trim(article_title) <> '' then trim(article_title) else '(No article title) ' || MentionIdentifier end as headline,
  case when trim(split_part(ActionGeo_FullName, ',', -1)) <> '' then trim(split_part(ActionGeo_FullName, ',', -1)) else ActionGeo_CountryCode end as country,
  ActionGeo_CountryCode as country_code, try_cast(ActionGeo_Lat as double) as latitude, try_cast(ActionGeo_Long as double) as longitude, EventCode as cameo_code,
  coalesce(lookup_label, 'Unknown') as cameo_label, Actor1Name as actor, try_cast(GoldsteinScale as double) as goldstein, strptime(Day, '%Y%m%d')::date as event_date,
  strptime(cast(DATEADDED as varchar), '%Y%m%d%H%M%S') as date_added, cast(trunc(try_cast(Confidence as double)) as int) as confidence, cast(InRawText as int) as in_raw_text,
  try_cast(MentionDocTone as double) as mention_doc_tone, strptime(MentionTimeDate, '%Y%m%d%H%M%S') as mention_time, MentionTimeDate, Actor1CountryCode, Actor2CountryCode, Actor1Geo_CountryCode, Actor2Geo_CountryCode, article_title, article_keywords,
  list_distinct(list_transform(regexp_split_to_array(lower(concat_ws(' ', article_title, article_keywords)), '[^a-z0-9]+'), lambda t: case when length(t) > 3 and ends_with(t, 's') then substr(t, 1, length(t) - 1) else t end)) as row_tokens,
  row_number() over (partition by m.GLOBALEVENTID, MentionIdentifier order by DATEADDED desc, ActionGeo_CountryCode desc) as k
 from mn m join ev using (GLOBALEVENTID) left join labels on lookup_code = EventCode where trim(MentionIdentifier) <> '') where k = 1""",
        ("mn", "ev", "labels"),
    ),
    "links": (
        """select user_id, doc_id, global_event_id from cat, users where case user_id
  when 'u1' then (Actor1CountryCode in ('N01', 'N07') or Actor2CountryCode in ('N01', 'N07') or country_code in ('F01', 'F07') or Actor1Geo_CountryCode in ('F01', 'F07') or Actor2Geo_CountryCode in ('F01', 'F07'))
   and (contains(lower(url), 'red-widgets') or contains(lower(url), 'hot-gear') or contains(lower(url), 'bolts')
    or list_has_all(row_tokens, ['red', 'widget']) or list_has_all(row_tokens, ['hot', 'gear']) or list_has_all(row_tokens, ['bolt']))
  when 'u2' then Actor1CountryCode in ('N03', 'N04') or Actor2CountryCode in ('N03', 'N04') or country_code in ('F03', 'F04') or Actor1Geo_CountryCode in ('F03', 'F04') or Actor2Geo_CountryCode in ('F03', 'F04')
  when 'u3' then contains(lower(url), 'blue-bolt') or contains(lower(url), 'small-ring') or contains(lower(url), 'rd') or contains(lower(url), 'r-and-d')
   or list_has_all(row_tokens, ['blue', 'bolt']) or list_has_all(row_tokens, ['small', 'ring']) or list_has_all(row_tokens, ['r', 'd'])
  when 'u4' then true when 'u5' then true
  when 'u6' then (Actor1CountryCode in ('N02') or Actor2CountryCode in ('N02') or country_code in ('F02') or Actor1Geo_CountryCode in ('F02') or Actor2Geo_CountryCode in ('F02'))
   and (contains(lower(url), 'zeppelin-moorings') or list_has_all(row_tokens, ['zeppelin', 'mooring'])) end""",
        ("cat", "users"),
    ),
    "ua": (f"select links.user_id, cat.*, datediff('day', event_date, date '{fixtures.AS_OF}') as age_days from links join cat using (doc_id, global_event_id)", ("links", "cat")),
    "recent": ("select * from ua where age_days <= 90", ("ua",)),
    "pref": (
        """select * exclude (n_raw, n_all), n_raw = 1 and n_all = 0 as filtered from (
 select *, max(case when in_raw_text = 1 then 1 else 0 end) over (partition by user_id, global_event_id) as n_raw,
  min(case when in_raw_text = 1 then 1 else 0 end) over (partition by user_id, global_event_id) as n_all from recent)
 where n_raw = 0 or in_raw_text = 1""",
        ("recent",),
    ),
    "ranked": (
        """select * exclude (key, seen) from (select *, row_number() over (partition by user_id, global_event_id order by coalesce(confidence, -1) desc, abs(mention_doc_tone) asc nulls last, url) as place from (
 select *, row_number() over (partition by user_id, global_event_id, key order by coalesce(confidence, -1) desc, abs(mention_doc_tone) asc nulls last, url) as seen
 from (select *, lower(trim(regexp_replace(headline, '\\s+', ' ', 'g'))) as key from pref)) where seen = 1 or key = '') where place <= 20""".replace("\\\\", "\\"),
        ("pref",),
    ),
    "cards": (
        """select b.user_id, b.global_event_id, s.card_title, s.top_article_url, b.country, b.latitude, b.longitude, b.cameo_code, b.cameo_label, b.actor, b.goldstein, b.event_date, b.date_added,
  b.age_days, max_confidence, inrawtext_filtered, oldest_article_time, n_articles, headlines, tag
 from (select * from (select *, row_number() over (partition by user_id, global_event_id order by coalesce(confidence, -1) desc, abs(mention_doc_tone) asc nulls last, url) as k,
   max(coalesce(confidence, -1)) over (partition by user_id, global_event_id) as max_confidence from recent) where k = 1) b
 join (select user_id, global_event_id, max(case when place = 1 then headline end) as card_title, max(case when place = 1 then url end) as top_article_url, bool_or(filtered) as inrawtext_filtered,
   min(mention_time) as oldest_article_time, count(*) as n_articles, list(headline order by place) as headlines from ranked group by all) s using (user_id, global_event_id)
 left join tags using (user_id, global_event_id)""",
        ("recent", "ranked", "tags"),
    ),
}


def sql(body: str, *names: str) -> str:
    """`body` after the named parts and all that they need."""
    order: list[str] = []

    def need(n: str) -> None:
        for m in PARTS[n][1]:
            need(m)
        if n not in order:
            order.append(n)

    for n in names:
        need(n)
    head = ",\n".join(f"{n} as ({PARTS[n][0]})" for n in order)
    return f"with {head}\n{body}" if order else body
