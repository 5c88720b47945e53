"""Feed-shaped tables derived from the test tables by integer arithmetic only: the SQL runs unchanged in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BRONZE_EVENTS = """
select * from (
with base as (
 select event_id, ts, user_id, event_type, cast(substr(props,7,length(props)-7) as int) as k,
   cast(year(ts) as bigint)*10000 + month(ts)*100 + day(ts) as d8,
   cast(year(ts) as bigint)*10000000000 + cast(month(ts) as bigint)*100000000 + day(ts)*1000000 + hour(ts)*10000 + (minute(ts) - minute(ts)%15)*100 as s14,
   ts + interval 1 day as ts2
 from {events}),
pub as (
 select event_id, user_id, event_type, k, d8, s14, 0 as rev from base
 union all
 select event_id, user_id, event_type, k, d8,
   cast(year(ts2) as bigint)*10000000000 + cast(month(ts2) as bigint)*100000000 + day(ts2)*1000000 + hour(ts2)*10000 + (minute(ts2) - minute(ts2)%15)*100 as s14, 1 as rev
 from base where event_id % 10 = 0)
select cast(p.event_id as string) as GLOBALEVENTID, cast(p.d8 as string) as Day,
  n1.n_name as Actor1Name, 'N' || lpad(cast(n1.n_nationkey as string),2,'0') as Actor1CountryCode,
  n2.n_name as Actor2Name, 'N' || lpad(cast(n2.n_nationkey as string),2,'0') as Actor2CountryCode,
  case p.k % 5 when 0 then 'BUS' when 1 then 'gov' else '' end as Actor1Type1Code,
  case when p.k % 11 = 0 then 'NATO' else '' end as Actor2KnownGroupCode,
  case p.event_type when 'click' then '1411' when 'error' then '182' when 'purchase' then '1621' when 'signup' then '042' else '1721' end as EventCode,
  case p.event_type when 'click' then '14' when 'error' then '18' when 'purchase' then '16' when 'signup' then '04' else '17' end as EventRootCode,
  cast(p.k % 21 - 10 as string) || '.' || cast(p.event_id % 10 as string) as GoldsteinScale,
  case when p.event_id % 31 = 0 then '' else cast(p.event_id % 19 - 12 as string) || '.37' end as AvgTone,
  case when p.event_id % 3 = 0 then 'F' || lpad(cast((p.event_id*5 + 1) % 25 as string),2,'0') else '' end as Actor1Geo_CountryCode,
  case when p.event_id % 5 = 0 then 'F' || lpad(cast((p.event_id*3 + 2) % 25 as string),2,'0') else '' end as Actor2Geo_CountryCode,
  cast(1 + p.k + p.rev as string) as NumArticles,
  case when p.event_id % 23 = 0 then '' else 'City ' || cast(p.event_id % 50 as string) || ', ' || n1.n_name end as ActionGeo_FullName,
  'F' || lpad(cast(case when p.rev = 1 and p.event_id % 50 = 0 then n2.n_nationkey else n1.n_nationkey end as string),2,'0') as ActionGeo_CountryCode,
  case when p.event_id % 29 = 0 then '' else cast(p.event_id % 90 as string) || '.25' end as ActionGeo_Lat,
  case when p.event_id % 29 = 0 then '' else '-' || cast(p.event_id % 180 as string) || '.75' end as ActionGeo_Long,
  cast(p.s14 as string) as DATEADDED,
  case when p.event_id % 17 = 0 then '' else 'https://n' || cast(p.event_id % 7 as string) || '.example.com/item-' || cast(p.event_id as string) ||
    case p.event_id % 6 when 0 then '-cargo' when 1 then '-airport-report' else '' end end as SOURCEURL
from pub p join {nation} n1 on n1.n_nationkey = p.user_id % 25 join {nation} n2 on n2.n_nationkey = (p.event_id*7 + 3) % 25) b"""

BRONZE_MENTIONS = """
with m as (
 select e.event_id, v.i, (e.event_id*7 + v.i*13) % 4001 as slot, e.ts + v.i * interval 6 hour as mts
 from {events} e join (values (0),(1),(2),(3)) as v(i) on v.i <= e.event_id % 4),
r as (select m.*, 0 as dup from m union all select m.*, 1 as dup from m where event_id % 20 = 0)
select cast(case when m.i = 3 and m.event_id % 13 = 0 then m.event_id + 10000000 else m.event_id end as string) as GLOBALEVENTID,
  cast(cast(year(mts) as bigint)*10000000000 + cast(month(mts) as bigint)*100000000 + day(mts)*1000000 + hour(mts)*10000 + (minute(mts) - minute(mts)%15)*100 as string) as MentionTimeDate,
  's' || cast(slot % 5 as string) || '.example.com' as MentionSourceName,
  'https://s' || cast(slot % 5 as string) || '.example.com/' || replace(p.p_name,' ','-') || '-' || cast(slot as string) as MentionIdentifier,
  cast((m.event_id + m.i) % 3 % 2 as string) as InRawText,
  case when (m.event_id + m.i) % 37 = 0 then '' else cast(10*(1 + (m.event_id + m.i) % 10) as string) end as Confidence,
  cast((m.event_id + 3*m.i) % 41 - 20 as string) || '.5' as MentionDocTone,
  case when slot % 9 = 0 or dup = 1 then '' else substr(replace(d.text, chr(10), ' '),1,60) end as article_title,
  case when slot % 9 = 0 or dup = 1 then '' else replace(p.p_name,' ',', ') end as article_keywords,
  case when slot % 9 = 0 or dup = 1 then 0 else 1 end as enriched
from r m join {part} p on p.p_partkey = slot % 200 join {documents} d on d.doc_id = slot % 200"""

AS_OF = "2024-02-01"
CUTOFF = "20240110000000"

TERRITORIES = """
select n_name as name, array['N' || lpad(cast(n_nationkey as string), 2, '0')] as cameo, array['F' || lpad(cast(n_nationkey as string), 2, '0')] as fips from {nation}"""

LABELS = """
select * from (values ('1411', 'Demonstrate for leadership change'), ('182', 'Physically assault, not specified below'), ('1621', 'Reduce aid'),
 ('1721', 'Impose restrictions')) as t(lookup_code, lookup_label)"""

#: user -> territories, keywords by question.  u4 has neither and u5 no known territory: both match everything; u6 matches nothing.
PROFILES = {
    "u1": (["NATION_1", "NATION_7"], {"sourcing": ["red widgets", "hot gear"], "storage": ["bolts"]}),
    "u2": (["NATION_3", "NATION_4"], {}),
    "u3": ([], {"delivery": ["blue bolt", "small ring"], "companies": ["R&D"]}),
    "u4": ([], {}),
    "u5": (["Atlantis"], {}),
    "u6": (["NATION_2"], {"sourcing": ["zeppelin moorings"]}),
}
TAGS = {
    "u1": {str(i): ("archive", "monitor", None)[i % 3] for i in range(1, 1000, 7)},
    "u2": {str(i): ("requires_action", "archive")[i % 2] for i in range(3, 1000, 11)},
    "u3": {str(i): "monitor" for i in range(5, 1000, 13)},
    "u4": {str(i): ("archive", "requires_action", "monitor", None)[i % 4] for i in range(2, 1000, 5)},
}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BRONZE_EVENTS, **tables(spark, sf_dir, "events", "nation"))


def bronze_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BRONZE_MENTIONS, **tables(spark, sf_dir, "events", "part", "documents"))


def territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TERRITORIES.replace("array[", "array(").replace("'0')]", "'0'))"), **tables(spark, sf_dir, "nation"))


def labels(spark: SparkSession) -> DataFrame:
    return spark.sql(LABELS)


def _literal(v: str | None) -> str:
    return "cast(null as string)" if v is None else "'" + v.replace("'", "''") + "'"


def profiles(spark: SparkSession) -> DataFrame:
    rows = []
    for user, (places, words) in PROFILES.items():
        lists = ", ".join(f"{_literal(q)}, array({', '.join(map(_literal, w))})" for q, w in words.items())
        words_sql = f"map({lists})" if lists else "cast(map() as map<string,array<string>>)"
        places_sql = f"array({', '.join(map(_literal, places))})" if places else "cast(array() as array<string>)"
        rows.append(f"select {_literal(user)} as user_id, {_literal(user.upper())} as display_name, {places_sql} as territories, {words_sql} as keywords, 30 as briefing_days, 60 as older_news_days, 'OK' as status")
    return spark.sql(" union all ".join(rows))


def tags(spark: SparkSession) -> DataFrame:
    rows = [f"select {_literal(u)} as user_id, map({', '.join(f'{_literal(e)}, {_literal(t)}' for e, t in m.items())}) as tags" for u, m in TAGS.items()]
    return spark.sql(" union all ".join(rows))
