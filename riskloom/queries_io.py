"""Queries of what reads, writes and streams: each writes to a working folder, reads back, and is held against plain SQL."""

from __future__ import annotations

import io
import tempfile
import urllib.error
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fixtures as X
from . import storage
from .functions import scalars as S
from .functions import text as T
from .operators import cards as C
from .operators import catalogue, gold, legacy, monitoring, relevance, silver
from .plans import pipeline as P
from .queries import CARD_SQL, SLICE_FILES, World, c, card_columns, halves, hexed, query
from .schemas import EVENT_FEED, EVENT_FEED_SCHEMA, MENTION_FEED, MENTION_FEED_SCHEMA, PROFILE_SCHEMA, STORE_ARTICLE_COLUMNS
from .sources import feeds, sinks
from .streaming import slices

EVENT_KEYS = ["GLOBALEVENTID", "Day", "EventCode", "ActionGeo_CountryCode", "DATEADDED", "SOURCEURL"]
MENTION_KEYS = ["GLOBALEVENTID", "MentionTimeDate", "MentionIdentifier", "InRawText", "Confidence", "MentionDocTone"]


def as_feed(df: DataFrame, names) -> DataFrame:
    """All columns of a feed, empty where the fixture has none."""
    return df.select(*(c(n) if n in df.columns else F.lit("").alias(n) for n in names))


def zipped(w: World, kind: str) -> DataFrame:
    """(slice, kind, content): the fixture's rows as one ZIP file a day, the last four fields cut off where they are empty."""
    names, by = (EVENT_FEED, "Day") if kind == "events" else (MENTION_FEED, "MentionTimeDate")
    rows = as_feed(w.bronze_events if kind == "events" else w.bronze_mentions, names).withColumn("slice", F.concat(F.substring(by, 1, 8), F.lit("000000")))

    def pack(key, table):
        lines = ["\t".join(r).rstrip("\t") for r in zip(*(table[n].to_pylist() for n in names), strict=True)]
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"{key[0].as_py()}.CSV", "\r\n".join(lines) + "\r\n")
        return pa.table({"slice": pa.array([key[0].as_py()], pa.string()), "kind": pa.array([kind], pa.string()), "content": pa.array([out.getvalue()], pa.binary())})

    return rows.groupBy("slice").applyInArrow(pack, "slice string, kind string, content binary")


def unpacked(files: DataFrame, folder: str) -> list[str]:
    """The files written under their feed names, in folders by kind; local paths of all."""

    def write(batches: Iterator[pa.RecordBatch]):
        from pyarrow import fs

        where, base = fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "file://", 1))
        for batch in batches:
            for name, kind, content in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                path = f"{base}/{kind}/{name}.{'export' if kind == 'events' else 'mentions'}.CSV.zip"
                where.create_dir(f"{base}/{kind}", recursive=True)
                with where.open_output_stream(path) as f:
                    f.write(content)
                yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    return sorted(r.path for r in files.mapInArrow(write, "path string").collect())


# --- sources -------------------------------------------------------------------------------------------------------
BE = f"select {', '.join(EVENT_KEYS)} from be"
BM = f"select {', '.join(MENTION_KEYS)} from bm"


@query("s06_read_events", BE, "be")
def _(s, d):
    folder = storage.working_folder(s)
    sinks.write_feed(as_feed(World(s, d).bronze_events, EVENT_FEED), f"{folder}/feed")
    return feeds.read_feed(s, f"{folder}/feed", EVENT_FEED_SCHEMA).select(*EVENT_KEYS)


@query("s06_read_mentions", BM, "bm")
def _(s, d):
    folder = storage.working_folder(s)
    sinks.write_feed(as_feed(World(s, d).bronze_mentions, MENTION_FEED), f"{folder}/feed")
    return feeds.read_feed(s, f"{folder}/feed", MENTION_FEED_SCHEMA, strict=False).select(*MENTION_KEYS)


@query("p03_named_fields", "select 60 as events, 16 as mentions, 'SOURCEURL' as last_event_field, 'Extras' as last_mention_field".replace("60", "61"))
def _(s, d):
    e, m = as_feed(World(s, d).bronze_events, EVENT_FEED), as_feed(World(s, d).bronze_mentions, MENTION_FEED)
    return s.createDataFrame([(len(e.columns), len(m.columns), e.columns[-1], m.columns[-1])], "events int, mentions int, last_event_field string, last_mention_field string")


@query("p02_positional_names", "select GLOBALEVENTID, EventCode, DATEADDED from be", "be")
def _(s, d):
    folder = storage.working_folder(s)
    sinks.write_feed(as_feed(World(s, d).bronze_events, EVENT_FEED), f"{folder}/feed")
    unnamed = s.read.option("sep", "\t").option("quote", '"').option("escape", '"').csv(f"{folder}/feed")
    return unnamed.toDF(*EVENT_FEED).select("GLOBALEVENTID", "EventCode", "DATEADDED")


@query("s07_unzip_events", f"select substr(Day, 1, 8) || '000000' as slice, 'events' as kind, {', '.join(EVENT_KEYS)} from be", "be")
def _(s, d):
    return feeds.unzip(zipped(World(s, d), "events"), EVENT_FEED).select("slice", "kind", *EVENT_KEYS)


@query("s08_read_zipped", f"select substr(MentionTimeDate, 1, 8) || '000000' as slice, 'mentions' as kind, {', '.join(MENTION_KEYS)} from bm", "bm")
def _(s, d):
    folder = storage.working_folder(s)
    unpacked(zipped(World(s, d), "mentions"), folder)
    return feeds.read_zipped(s, folder, MENTION_FEED).select("slice", "kind", *MENTION_KEYS)


@query("s02_backfill", "select substr(MentionTimeDate, 1, 8) || '000000' as slice, count(*) as n, 1 as files from bm group by 1", "bm")
def _(s, d):
    """Downloaded twice by file: URLs, one of them of nothing: the second run finds nothing new."""
    folder = storage.working_folder(s)
    paths = unpacked(zipped(World(s, d), "mentions"), f"{folder}/site")
    urls = s.createDataFrame([(p.rsplit("/", 1)[1][:14], "mentions", f"file://{p}") for p in [*paths, paths[0].replace("20", "19")]], "slice string, kind string, url string")
    for _ in range(2):
        staged = feeds.backfill(s, urls, f"{folder}/staging")
    rows = feeds.unzip(staged, MENTION_FEED).groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(staged.groupBy("slice").agg(F.count(F.lit(1)).cast("int").alias("files")), "slice")


@query("s19_sane_files", """select slice, 'events' as kind, case when slice = low then 0 when slice = high then n + 1 else n end as n_rows, slice <> low and slice <> high as ok from (
 select Day || '000000' as slice, count(*) as n, min(Day || '000000') over () as low, max(Day || '000000') over () as high from be group by Day)""", "be")
def _(s, d):
    """One file is broken and one has a row that is too long."""
    files = zipped(World(s, d), "events").cache()
    low, high = files.agg(F.min("slice"), F.max("slice")).first()

    def spoil(batches):
        for batch in batches:
            out = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if name == high:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        text = z.read(z.namelist()[0]).decode()
                    new = io.BytesIO()
                    with zipfile.ZipFile(new, "w") as z:
                        z.writestr("x.CSV", text + "\t".join(["x"] * 70) + "\r\n")
                    content = new.getvalue()
                out.append(b"broken" if name == low else content)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["slice", "kind", "content"])

    return feeds.sane_files(files.mapInArrow(spoil, files.schema), {"events": len(EVENT_FEED)})


class Site:
    """Answers of a web server, in order; counts the waits between them."""

    def __init__(self, *answers):
        self.answers, self.waits = list(answers), []

    def __call__(self, url, timeout):
        answer = self.answers.pop(0)
        if isinstance(answer, int):
            raise urllib.error.HTTPError(url, answer, "", {}, None)
        if answer is None:
            raise OSError("no route")
        return io.BytesIO(answer)


@query("s01_fetch", """select * from (values ('first', 'ok', ''), ('after a 404', 'ok', '5.0'), ('never', 'missing', '5.0 5.0'), ('final 404', 'missing', ''), ('errors', 'failed', '5.0 10.0')) as t(what, status, waits)""")
def _(s, d):
    cases = {"first": (Site(b"x"), {}), "after a 404": (Site(404, b"x"), {}), "never": (Site(404, 404, 404), {}), "final 404": (Site(404), {"missing_is_final": True}), "errors": (Site(None, 500, None), {"linear": True})}
    rows = []
    for what, (site, options) in cases.items():
        status, _ = feeds.fetch("http://x", opener=site, sleep=site.waits.append, **options)
        rows.append((what, status, " ".join(map(str, site.waits))))
    return s.createDataFrame(rows, "what string, status string, waits string")


@query("s01_latest_urls", "select * from (values ('events', 'http://f/20240101000000.export.CSV.zip'), ('mentions', 'http://f/20240101000000.mentions.CSV.zip')) as t(kind, url)")
def _(s, d):
    site = Site(404, b"1 a http://f/20240101000000.export.CSV.zip\n2 b http://f/20240101000000.mentions.CSV.zip\n3 c http://f/20240101000000.gkg.csv.zip\nshort\n")
    return s.createDataFrame(sorted(feeds.latest_urls("http://m", opener=site, sleep=site.waits.append).items()), "kind string, url string")


_stores: list[tempfile.TemporaryDirectory] = []


def own_table(s, name: str) -> tuple[str, str]:
    """The URL of a store in the driver's JVM, kept in files so that large tables fit, and a table name of its own there."""
    s._jvm.System.setProperty("derby.stream.error.file", "/dev/null")  # no log file
    if not _stores:
        _stores.append(tempfile.TemporaryDirectory(prefix="riskloom-", ignore_cleanup_errors=True))
    return f"jdbc:derby:{_stores[0].name}/store;create=true", f"{name}_{uuid.uuid4().hex[:12]}"


@query("s10_jdbc_ranges", "select GLOBALEVENTID, ActionGeo_CountryCode, DATEADDED from ev where DATEADDED > 20240110000000", "ev")
def _(s, d):
    """Written to a store by JDBC, then read in key ranges with a filter that runs in the store, beside a read of an empty table."""
    url, table = own_table(s, "ev")
    rows = World(s, d).events.select("GLOBALEVENTID", "ActionGeo_CountryCode", "DATEADDED")
    sinks.write_jdbc(rows, url, table, "overwrite")
    where = "DATEADDED > 20240110000000"
    nothing = feeds.read_partitioned(s, url, table, "GLOBALEVENTID", where="DATEADDED < 0")
    return feeds.read_partitioned(s, url, table, "GLOBALEVENTID", where=where).unionByName(nothing)


@query("k05_write_jdbc", "select user_id, doc_id, global_event_id from links", "links")
def _(s, d):
    """Written, overwritten without dropping the table, and appended to."""
    (url, table), rows = own_table(s, "links"), hexed(World(s, d).gold.links)
    sinks.write_jdbc(rows, url, table, "overwrite")
    few = c("user_id") < "u3"
    sinks.write_jdbc(rows.filter(few), url, table, "overwrite", truncate=True)
    sinks.write_jdbc(rows.filter(~few), url, table)
    return feeds.read_table(s, url, table)


@query("s11_labels", "select lookup_code, lookup_label from labels", "labels")
def _(s, d):
    """The first place does not exist; without any there are no labels."""
    folder = storage.working_folder(s)
    rows = X.labels(s).collect()
    storage.put_new(s, f"{folder}/codes.txt", "CODE\tLABEL\r\n" + "".join(f"{r.lookup_code}\t {r.lookup_label} \r\n" for r in rows) + "broken\r\n")
    return feeds.read_labels(s, f"{folder}/none.txt", f"{folder}/codes.txt").unionByName(feeds.read_labels(s, f"{folder}/none.txt"))


@query("s12_read_territories", "select name, array_to_string(cameo, ',') as cameo, array_to_string(fips, ',') as fips from terr union all select 'Alone', 'X', ''", "terr")
def _(s, d):
    """Codes as lists, as text and as null, from one JSON object."""
    folder = storage.working_folder(s)
    entry = F.struct(c("name"), F.struct("cameo", "fips"))
    text = World(s, d).territories.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("t")).first().t
    storage.put_new(s, f"{folder}/t.json", text[:-1] + ', "Alone": {"cameo": "X", "fips": null}}')
    return feeds.read_territories(s, f"{folder}/t.json").select("name", F.array_join("cameo", ",").alias("cameo"), F.array_join("fips", ",").alias("fips"))


@query("s13_read_profiles", "select users.user_id, upper(users.user_id) as display_name, question, keyword from users left join words using (user_id)", "users", "words")
def _(s, d):
    folder = storage.working_folder(s)
    World(s, d).profiles.write.json(f"{folder}/profiles")
    p = feeds.read_profiles(s, f"{folder}/profiles").select("user_id", "display_name", F.explode_outer("keywords").alias("question", "k"))
    return p.select("user_id", "display_name", "question", F.explode_outer("k").alias("keyword"))


@query("s13_read_tags", "select * from tags", "tags")
def _(s, d):
    folder = storage.working_folder(s)
    World(s, d).tags.write.option("ignoreNullFields", False).json(f"{folder}/tags")
    return feeds.read_tags(s, f"{folder}/tags").select("user_id", F.explode("tags").alias("global_event_id", "tag"))


@query("s17_snapshot", "select 'exported' as t, count(*) as n from ev union all select 'wiped', 0 union all select 'recreated', count(*) from ev", "ev")
def _(s, d):
    folder, e = storage.working_folder(s), World(s, d).events
    e.write.parquet(f"{folder}/events")
    sinks.export_snapshot(s.read.parquet(f"{folder}/events"), f"{folder}/snapshot")
    exported = sinks.restore_snapshot(s, f"{folder}/snapshot").count()
    sinks.wipe(sinks.restore_snapshot(s, f"{folder}/snapshot"), f"{folder}/events")
    wiped = s.read.parquet(f"{folder}/events").count()
    sinks.recreate(s, f"{folder}/snapshot", f"{folder}/events")
    return s.createDataFrame([("exported", exported), ("wiped", wiped), ("recreated", s.read.parquet(f"{folder}/events").count())], "t string, n long")


# --- sinks ---------------------------------------------------------------------------------------------------------
def three_slices(w: World, folder: str) -> list[str]:
    """The fixture's events in three slice files, written newest first."""
    b, third = as_feed(w.bronze_events, EVENT_FEED), c("GLOBALEVENTID").cast("bigint") % 3
    return [sinks.write_slice(b.filter(third == i), folder, f"2024010100{15 * i:02d}00.export.CSV") for i in (2, 0, 1)]


@query("k01_write_slice", "select '2024010100' || case cast(GLOBALEVENTID as bigint) % 3 when 0 then '00' when 1 then '15' else '30' end || '00' as slice, 'events' as kind, count(*) as n from be group by 1", "be")
def _(s, d):
    folder = storage.working_folder(s)
    three_slices(World(s, d), folder)
    files = feeds.list_files(s, folder).select("slice", "kind")
    rows = feeds.read_feed(s, folder, EVENT_FEED_SCHEMA).groupBy(S.slice_of_path(F.input_file_name()).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    return files.join(rows, "slice")


def silver_twice(w: World, folder: str) -> None:
    """The relevant events appended in two parts, one of them again."""
    kept = w.bronze_events.filter(relevance.is_relevant(w.bronze_events))
    odd = c("GLOBALEVENTID").cast("bigint") % 2 == 1
    for part in (kept.filter(odd), kept.filter(~odd), kept.filter(odd)):
        sinks.append_silver(part, f"{folder}/events", "events")


EV = "select GLOBALEVENTID, ActionGeo_CountryCode, DATEADDED, NumArticles, substr(Day, 1, 6) as month from ev"


@query("k03_append_events", EV, "ev")
def _(s, d):
    folder = storage.working_folder(s)
    silver_twice(World(s, d), folder)
    return slices.latest_view(s, f"{folder}/events", "events").select("GLOBALEVENTID", "ActionGeo_CountryCode", "DATEADDED", "NumArticles", c("month").cast("string").alias("month"))


@query("k03_append_mentions", "select GLOBALEVENTID, MentionIdentifier, enriched, MentionTimeDate from mn", "mn")
def _(s, d):
    folder, w = storage.working_folder(s), World(s, d)
    mentions = w.bronze_mentions.join(w.events.select(c("GLOBALEVENTID").cast("string").alias("GLOBALEVENTID")).distinct(), "GLOBALEVENTID", "left_semi")
    for _ in range(2):
        sinks.append_silver(mentions, f"{folder}/mentions", "mentions")
    return slices.latest_view(s, f"{folder}/mentions", "mentions").select("GLOBALEVENTID", "MentionIdentifier", "enriched", "MentionTimeDate")


@query("k18_compact", f"select *, (select count(*) from ev) as n from ({EV})", "ev")
def _(s, d):
    folder = storage.working_folder(s)
    silver_twice(World(s, d), folder)
    sinks.compact(s, f"{folder}/events", f"{folder}/compact", "events")
    t = s.read.parquet(f"{folder}/compact")
    return t.select("GLOBALEVENTID", "ActionGeo_CountryCode", "DATEADDED", "NumArticles", c("month").cast("string").alias("month"), F.lit(t.count()).cast("long").alias("n"))


@query("t12_reingestion", "select count(*) as n, sum(DATEADDED) as stamps from ev", "ev")
def _(s, d):
    folder = storage.working_folder(s)
    silver_twice(World(s, d), folder)
    return slices.latest_view(s, f"{folder}/events", "events").agg(F.count(F.lit(1)).alias("n"), F.sum(c("DATEADDED").cast("decimal(38,0)")).alias("stamps"))


@query("k06_publish", "select 'published' as t, count(*) as n from links union all select 'articles', count(*) from (select distinct doc_id, global_event_id from links) union all select 'versions', 2", "links")
def _(s, d):
    """Two versions are published, then a run fails half way: readers stay at the second."""
    folder, w = storage.working_folder(s), World(s, d)
    P.publish_gold(s, P.Gold(w.gold.articles.limit(1), w.gold.links.limit(1), "OK"), folder, X.AS_OF)
    P.publish_gold(s, w.gold, folder, X.AS_OF)
    fails = w.gold.links.withColumn("user_id", F.raise_error(F.lit("store is down")).cast("string"))
    try:
        storage.publish(s, {"articles": w.gold.articles.limit(0), "user_articles": fails}, folder)
    except Exception:  # noqa: BLE001  what this query is about
        pass
    counts = [("published", storage.current(s, folder, "user_articles").count()), ("articles", storage.current(s, folder, "articles").count()), ("versions", len(storage._published(s, folder)))]
    return s.createDataFrame(counts, "t string, n long")


@query("p05_store_articles", """select doc_id, url as document_identifier, headline as mention_identifier, global_event_id, in_raw_text, confidence, mention_doc_tone, country, '' as risk_category, goldstein, cameo_code, cameo_label, actor,
 latitude, longitude, cast(event_date as varchar) as event_date, strftime(date_added, '%Y-%m-%d %H:%M:%S') as date_added, datediff('day', event_date, date '{as_of}') as age_days, strftime(mention_time, '%Y-%m-%d %H:%M:%S') as mention_time from cat""".replace("{as_of}", X.AS_OF), "cat")
def _(s, d):
    out = gold.article_rows(World(s, d).catalogue, X.AS_OF)
    assert out.columns == STORE_ARTICLE_COLUMNS
    shown = {"event_date": c("event_date").cast("string"), **{n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in ("date_added", "mention_time")}}
    return hexed(out).withColumns(shown)


@query("k11_mark_error", "select 'ERROR' as status, '2024-01-31' as timestamp_of_last_update, '20240131000000' as silver_watermark")
def _(s, d):
    return gold.mark_error(s.sql("select 'OK' as status, '2024-01-31' as timestamp_of_last_update, '20240131000000' as silver_watermark"))


@query("k14_publish_territories", "select name, array_to_string(cameo, ',') as cameo, array_to_string(fips, ',') as fips from terr", "terr")
def _(s, d):
    folder, t = storage.working_folder(s), World(s, d).territories
    for part in (t.limit(3), t):
        sinks.publish_territories(part, folder)
    return storage.current(s, folder, "territories").select("name", F.array_join("cameo", ",").alias("cameo"), F.array_join("fips", ",").alias("fips"))


@query("k15_csv", "select user_id, global_event_id, card_title, country from cards", "cards")
def _(s, d):
    folder = storage.working_folder(s)
    rows = World(s, d).cards.select("user_id", "global_event_id", "card_title", "country")
    rows.write.option("header", True).option("escape", '"').csv(f"{folder}/cards")
    return s.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{folder}/cards")


@query("k15_report", "select 'first' as run, '3' as slices union all select 'second', '4'")
def _(s, d):
    folder = storage.working_folder(s)
    for run, n in (("first", 3), ("second", 4)):
        sinks.append_report(s.createDataFrame([(run, n)], "run string, slices int"), folder)
    return s.read.option("header", True).csv(folder)


@query("k16_bounded_log", "select DATEADDED || '.csv' as file_name, case when n <= 40 then '2024-02-01' else '2024-02-02' end as dead_letter_day, '12:30:00' as dead_letter_time from (select DATEADDED, row_number() over (order by DATEADDED) as n from (select distinct DATEADDED from be)) where n <= 100", "be")
def _(s, d):
    """A log that has room for 60 of the second run's rows."""
    names = World(s, d).bronze_events.select(F.concat("DATEADDED", F.lit(".csv")).alias("file_name")).distinct().orderBy("file_name")
    first = s.createDataFrame(names.limit(40).collect(), "file_name string")
    log = sinks.append_dead_letters(s.createDataFrame([], sinks.LOG_SCHEMA), first, "2024-02-01 12:30:00", 100)
    return sinks.append_dead_letters(log, names.join(first, "file_name", "left_anti"), "2024-02-02 12:30:00", 100)


@query("k16_move", "select * from (values ('20240101000000.export.CSV', 'in', false), ('20240101000000.export.CSV', 'dead', true), ('20240101001500.export.CSV', 'in', true), ('20240101001500.export.CSV', 'dead', false)) as t(file_name, place, is_there)")
def _(s, d):
    folder = storage.working_folder(s)
    for name in ("20240101000000.export.CSV", "20240101001500.export.CSV"):
        storage.put_new(s, f"{folder}/in/{name}", "x")
    log = sinks.move_dead_letters(s, [f"{folder}/in/20240101000000.export.CSV", f"{folder}/in/gone.CSV"], f"{folder}/dead", "20240101000000", "2024-02-01 12:30:00")
    rows = [(n, place, storage.exists(s, f"{folder}/{at}/{n}")) for n in ("20240101000000.export.CSV", "20240101001500.export.CSV") for place, at in (("in", "in"), ("dead", "dead/20240101000000"))]
    return s.createDataFrame(rows, "file_name string, place string, is_there boolean").crossJoin(log.agg(F.count(F.lit(1)).alias("n"))).filter("n = 1").drop("n")


LOG = "('old.csv', '2022-12-31', '23:59:59'), ('lost.csv', '2022-01-01', '00:00:00'), ('new.csv', '2024-01-01', '00:00:00'), ('odd.csv', 'no day', ''), ('', '2022-01-01', '00:00:00')"


@query("t16_purge", "select * from (values ('lost.csv', false), ('new.csv', true), ('odd.csv', true)) as t(file_name, is_there)")
def _(s, d):
    """A stale file goes with its row; a stale row whose file is lost, rows without a time and new ones stay."""
    folder = storage.working_folder(s)
    for name in ("old.csv", "new.csv", "odd.csv"):
        storage.put_new(s, f"{folder}/20230101000000/{name}", "x")
    log = s.sql(f"select * from values {LOG} as t(file_name, dead_letter_day, dead_letter_time)")
    left = [r.file_name for r in sinks.purge_dead_letter_files(s, folder, log, "2024-02-01 00:00:00").collect()]
    assert not storage.exists(s, f"{folder}/20230101000000/old.csv")
    return s.createDataFrame([(n, storage.exists(s, f"{folder}/20230101000000/{n}")) for n in left], "file_name string, is_there boolean")


@query("k17_legacy_write", "select GLOBALEVENTID as event_id, Day as date, substr(Day, 1, 6) as month, EventCode as event_code, '2024-02-01 00:00:00' as inserted_at from be", "be")
def _(s, d):
    folder = storage.working_folder(s)
    legacy.write_events(legacy.events(World(s, d).bronze_events), folder, "2024-02-01 00:00:00")
    return s.read.parquet(folder).select("event_id", "date", c("month").cast("string").alias("month"), "event_code", F.date_format("inserted_at", "yyyy-MM-dd HH:mm:ss").alias("inserted_at"))


@query("k20_migrated", "select doc_id, global_event_id, 'rebuilt' as extra from cat", "cat")
def _(s, d):
    """A table keyed by URL alone is not carried over: gold is built again."""
    w = World(s, d)
    new = hexed(w.catalogue).select("doc_id", "global_event_id", F.lit("rebuilt").alias("extra"))
    old = new.select("doc_id").distinct()
    return gold.migrated(old, new.limit(0), lambda: new).unionByName(gold.migrated(halves(w)[0].limit(0).select("doc_id", "global_event_id"), new, lambda: new))


@query("c28_bucketed_join", "select count(*) as n, 0 as exchanges from mn join ev using (GLOBALEVENTID)", "mn", "ev")
def _(s, d):
    """Tables bucketed alike join without an exchange of either."""
    w, folder = World(s, d), storage.working_folder(s)
    tag = folder.rsplit("-", 1)[1]
    sinks.write_bucketed(w.events.select("GLOBALEVENTID", "DATEADDED"), f"events_{tag}", 4, path=f"{folder}/events")
    sinks.write_bucketed(w.mentions.select("GLOBALEVENTID", "MentionIdentifier"), f"mentions_{tag}", 4, path=f"{folder}/mentions")
    joined = s.table(f"mentions_{tag}").hint("merge").join(s.table(f"events_{tag}"), "GLOBALEVENTID")
    plan = joined._jdf.queryExecution().sparkPlan().toString() + joined._jdf.queryExecution().executedPlan().toString()
    return joined.agg(F.count(F.lit(1)).alias("n")).withColumn("exchanges", F.lit(plan.count("Exchange hashpartitioning")))


@query("u08_batches", f"{BE} union all {BE}", "be")
def _(s, d):
    b = World(s, d).bronze_events
    parts = [b.filter(c("GLOBALEVENTID").cast("bigint") % 3 == i) for i in range(3)]
    once = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return once.unionByName(b).select(*EVENT_KEYS)


@query("c23_text_dates", """select * from (values ('2024-01-31T10:00:00Z', '2024-01-31', '7', 7, 7.0), ('2024-01-31', '2024-01-31', ' 12 ', 12, 12.0), ('20240131094500', '2024-01-31', 'x', -1, 0.0), ('20240131', '2024-01-31', '1.5', -1, 1.5),
 ('', '0001-01-01', '', -1, 0.0), (null, '0001-01-01', null, -1, 0.0), ('soon', '0001-01-01', '-3', -3, -3.0)) as t(v, day, n, whole, number)""")
def _(s, d):
    rows = [("2024-01-31T10:00:00Z", "7"), ("2024-01-31", " 12 "), ("20240131094500", "x"), ("20240131", "1.5"), ("", ""), (None, None), ("soon", "-3")]
    df = s.createDataFrame(rows, "v string, n string")
    return df.select("v", F.date_format(C.date_value(c("v")), "yyyy-MM-dd").alias("day"), "n", C.whole_value(c("n")).alias("whole"), C.float_value(c("n")).alias("number"))


# --- streaming -----------------------------------------------------------------------------------------------------
@query("t01_stream_to_silver", "select GLOBALEVENTID, ActionGeo_CountryCode, DATEADDED from ev", "ev")
def _(s, d):
    """Slice files as a stream, run twice from one checkpoint: the second run finds nothing new."""
    folder = storage.working_folder(s)
    three_slices(World(s, d), f"{folder}/in")
    for _ in range(2):
        slices.events_to_silver(s, f"{folder}/in", f"{folder}/silver", f"{folder}/check").awaitTermination()
    return slices.latest_view(s, f"{folder}/silver", "events").select("GLOBALEVENTID", "ActionGeo_CountryCode", "DATEADDED")


@query("t01_mentions_to_silver", "select GLOBALEVENTID, MentionIdentifier, enriched from mn", "mn")
def _(s, d):
    folder, w = storage.working_folder(s), World(s, d)
    w.events.write.parquet(f"{folder}/events")
    sinks.write_slice(as_feed(w.bronze_mentions, MENTION_FEED), f"{folder}/in", "20240101000000.mentions.CSV")
    slices.mentions_to_silver(s, f"{folder}/in", f"{folder}/events", f"{folder}/silver", f"{folder}/check").awaitTermination()
    # the feed has no titles: enrichment comes later
    found = slices.latest_view(s, f"{folder}/silver", "mentions").select("GLOBALEVENTID", "MentionIdentifier")
    return found.join(w.mentions.select("GLOBALEVENTID", "MentionIdentifier", "enriched"), ["GLOBALEVENTID", "MentionIdentifier"])


@query("t03_slices_in_order", """select * from (values ('first run', '20240101000000 20240101001500 20240101003000', '20240101003000'), ('a late slice', '20231231234500', '20240101003000')) as t(run, slices, watermark)""")
def _(s, d):
    """Slices of a micro-batch are handled oldest first, a late one never moves the watermark back, and a restart goes on."""
    folder, rows = storage.working_folder(s), []
    three_slices(World(s, d), f"{folder}/in")
    for run in ("first run", "a late slice"):
        if rows:
            sinks.write_slice(as_feed(World(s, d).bronze_events.limit(3), EVENT_FEED), f"{folder}/in", "20231231234500.export.CSV")
        done: list[str] = []
        state = storage.State(s, f"{folder}/state")  # as after a restart of the driver
        slices.write_batches(slices.read_stream(s, f"{folder}/in", "events"), f"{folder}/check", slices.by_slice(lambda df, name: done.append(name), state)).awaitTermination()
        rows.append((run, " ".join(done), state.load({})["watermark"]))
    return s.createDataFrame(rows, "run string, slices string, watermark string")


@query("t09_dead_slices", "select * from (values ('20240101000000', 'done'), ('20240101001500', 'dead: bad slice'), ('20240101003000', 'done')) as t(slice, outcome)")
def _(s, d):
    """A slice that fails three times goes to the dead letters, and the next ones go on."""
    folder, rows, tried = storage.working_folder(s), [], []
    three_slices(World(s, d), f"{folder}/in")

    def handle(df, name):
        if name == "20240101001500":
            tried.append(name)
            raise ValueError("bad slice")
        rows.append((name, "done"))

    run = slices.by_slice(handle, None, lambda name, e: rows.append((name, f"dead: {e}")))
    slices.write_batches(slices.read_stream(s, f"{folder}/in", "events"), f"{folder}/check", run).awaitTermination()
    assert len(tried) == 3
    return s.createDataFrame(rows, "slice string, outcome string")


@query("t09_take_slices", """select * from (values (1, '20240101000000', 0, '20240101000000'), (2, '', 0, '20240101000000'), (3, '20240101003000', 1, '20240101003000'), (4, '', 1, '20240101003000')) as t(run, done, dead, watermark)""")
def _(s, d):
    """A folder loop over restarts: one slice a listing is too young, one fails three times."""
    folder, rows, dead = storage.working_folder(s), [], []
    for name in ("20240101000000.export.CSV", "20240101000000.mentions.CSV", "20240101001500.export.CSV"):
        storage.put_new(s, f"{folder}/in/{name}", "x")

    def handle(name, events, mentions):
        if name == "20240101001500":
            raise ValueError("bad slice")
        for path in (events, mentions):
            if path:
                storage.remove(s, path)

    def letter(name, paths, reason):
        dead.extend(sinks.move_dead_letters(s, paths, f"{folder}/dead", name, "2024-02-01 00:00:00").collect())

    for run in range(1, 5):
        if run == 3:
            storage.put_new(s, f"{folder}/in/20240101003000.mentions.CSV", "x")
        state = storage.State(s, f"{folder}/state")
        done = slices.take_slices(s, f"{folder}/in", state, handle, letter, "2100-01-01 00:00:00") if storage.names(s, f"{folder}/in") else []
        rows.append((run, " ".join(done), len(dead), state.load({"watermark": ""})["watermark"]))
    return s.createDataFrame(rows, "run int, done string, dead int, watermark string")


@query("t09_ready_and_orphans", f"""select slice, max(case when kind = 'events' then path end) as events, max(case when kind = 'mentions' then path end) as mentions, 'ready' as what from ({SLICE_FILES}) where kind <> 'unknown'
 group by slice having max(modified) <= timestamp '2024-01-01 00:30:00' - interval 3 seconds union all select slice, path, kind, 'orphan' from ({SLICE_FILES}) where kind <> 'unknown' and epoch(timestamp '2024-01-01 01:15:00') - epoch(modified) > 3600""")
def _(s, d):
    f = s.sql(SLICE_FILES)
    ready = feeds.ready_slices(f, "2024-01-01 00:30:00").withColumn("what", F.lit("ready"))
    return ready.union(feeds.orphans(f, "2024-01-01 01:15:00").select("slice", "path", "kind", F.lit("orphan")))


@query("t09_sweep", "select * from (values ('20240101000000.export.CSV', 'dead')) as t(file_name, place)")
def _(s, d):
    folder = storage.working_folder(s)
    storage.put_new(s, f"{folder}/in/20240101000000.export.CSV", "x")
    storage.put_new(s, f"{folder}/in/readme.txt", "x")
    move = lambda name, paths, reason: sinks.move_dead_letters(s, paths, f"{folder}/dead", name, "2024-02-01 00:00:00").collect()
    swept = slices.sweep_orphans(s, f"{folder}/in", "2100-01-01 00:00:00", move)
    assert storage.names(s, f"{folder}/in") == ["readme.txt"] and slices.sweep_orphans(s, f"{folder}/in", "1990-01-01 00:00:00", move) == []
    return s.createDataFrame([(p.rsplit("/", 1)[1], "dead" if storage.exists(s, f"{folder}/dead/20240101000000/{p.rsplit('/', 1)[1]}") else "lost") for p in swept], "file_name string, place string")


@query("t02_windows", "select strftime(strptime(DATEADDED, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') as slice, count(*) as n from be group by 1", "be")
def _(s, d):
    """Tumbling windows of a stream, against a plain group-by."""
    folder = storage.working_folder(s)
    three_slices(World(s, d), f"{folder}/in")
    stream = slices.slice_counts(slices.read_stream(s, f"{folder}/in", "events"), late="60 days")
    done = stream.writeStream.outputMode("complete").format("memory").queryName("slice_counts").option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start()
    done.awaitTermination()
    return s.table("slice_counts").select(F.date_format("window.start", "yyyyMMddHHmmss").alias("slice"), "n")


@query("t05_watermark", """select * from (values (0, 'full', null), (1, null, null), (2, 'incremental', '20240101000000'), (3, null, null), (4, 'stale', null), (5, null, null), (6, 'full', null), (7, 'failed', null), (8, 'incremental', '20240101000000')) as t(step, did, since)""")
def _(s, d):
    """Looks at silver's watermark, each as after a restart: forward, idle, backward (a rebuilt silver), and a run that fails."""
    folder, rows = storage.working_folder(s), []
    looks = [("20240101000000", 0), ("20240101000000", 60), ("20240101001500", 120), ("20240101001500", 1000), ("20240101001500", 9000), ("20240101001500", 9060), ("20240101000000", 9120), ("20240101003000", 9180), ("20240101003000", 9240)]
    for step, (now, seconds) in enumerate(looks):
        since: list = [None]

        def run(mode, after, step=step, since=since):
            if step == 7:
                raise ValueError("no store")
            since[0] = after

        try:
            did = slices.watermark_step(storage.State(s, folder), now, seconds, run, lambda waited: None)
        except ValueError:
            did = "failed"
        rows.append((step, did, since[0]))
    return s.createDataFrame(rows, "step int, did string, since string")


@query("t05_recompute_on_change", "select max(DATEADDED)::varchar as watermark, 'full' as mode from ev", "ev")
def _(s, d):
    """A stream of silver rows that starts one recompute."""
    folder, runs = storage.working_folder(s), []
    e = World(s, d).events.select("GLOBALEVENTID", "DATEADDED")
    e.write.parquet(f"{folder}/silver")
    for _ in range(2):
        stream = s.readStream.schema(e.schema).parquet(f"{folder}/silver")
        slices.recompute_on_change(stream, f"{folder}/check", lambda mode, since: runs.append(mode)).awaitTermination()
    last = storage.State(s, f"{folder}/check-state").load({})["last"]
    return s.createDataFrame([(last, " ".join(runs))], "watermark string, mode string")


@query("t06_profile_changes", "select user_id, 1 as runs from users", "users")
def _(s, d):
    folder, runs = storage.working_folder(s), []
    p = World(s, d).profiles
    p.unionByName(p).write.json(f"{folder}/profiles")  # two saves of each profile in one batch: one recompute
    slices.profile_changes(s, f"{folder}/profiles", PROFILE_SCHEMA, f"{folder}/check", runs.append).awaitTermination()
    return s.createDataFrame([(u, runs.count(u)) for u in sorted(set(runs))], "user_id string, runs int")


@query("t11_liveness", "select * from (values ('quiet', 'ERROR'), ('never', 'ERROR'), ('recent', 'OK'), ('same files', 'ERROR'), ('new files', 'OK'), ('one old file', 'ERROR')) as t(what, status)")
def _(s, d):
    """U5 with it: an error goes only when no file is one of those that were there at the error."""
    from datetime import datetime, timedelta

    now = datetime(2024, 2, 1)
    old = now - timedelta(minutes=36)
    cases = {"quiet": (old, [], []), "never": (None, [], []), "recent": (now - timedelta(minutes=34), [], []), "same files": (old, ["a"], ["a"]), "new files": (old, ["a"], ["b"]), "one old file": (old, ["a"], ["a", "b"])}
    return s.createDataFrame([(k, slices.liveness(last, now, errors, fresh)) for k, (last, errors, fresh) in cases.items()], "what string, status string")


@query("t13_daily_retention", "select * from (values ('2024-02-01', '20230201000000'), ('2024-02-04', '20230204000000')) as t(day, cutoff)")
def _(s, d):
    """Once a day, not again on the same day, and at the first call after days without one."""
    folder, rows = storage.working_folder(s), []
    for day in ("2024-02-01", "2024-02-01", "2024-02-04"):
        P.run_retention(s, folder, day, lambda cutoff, day=day: rows.append((day, cutoff)))
    return s.createDataFrame(rows, "day string, cutoff string")


@query("t15_exclusive", "select 'refused' as second, 'taken' as third, 'taken' as stale")
def _(s, d):
    """A lock that other drivers see: held, freed, and left behind by one that died."""
    path = f"{storage.working_folder(s)}/lock"

    def attempt(**options):
        try:
            with storage.lock(s, path, **options):
                return "taken"
        except RuntimeError:
            return "refused"

    with monitoring.exclusive(s, path):
        second = attempt()
    third = attempt()
    storage.put_new(s, path, "0")
    return s.createDataFrame([(second, third, attempt(stale=60.0))], "second string, third string, stale string")


@query("t17_rebuild_pending", "select * from (values ('as saved, soon', true), ('as saved, late', false), ('moved', false)) as t(what, pending)")
def _(s, d):
    links = World(s, d).gold.links
    now = gold.fingerprint_of(links, "u1")
    saved = now.first().fingerprint
    cases = (("as saved, soon", saved, 10), ("as saved, late", saved, 91), ("moved", "0:", 10))
    out = [gold.rebuild_pending(then, now, seconds).select(F.lit(what).alias("what"), "pending") for what, then, seconds in cases]
    return out[0].unionByName(out[1]).unionByName(out[2])


# --- what serving asks for -----------------------------------------------------------------------------------------
@query("x06_profiles", "select user_id, upper(user_id) as display_name from users", "users")
def _(s, d):
    return P.all_profiles(World(s, d).profiles)


@query("x06_profile", "select 'u3' as user_id, 'U3' as display_name")
def _(s, d):
    return P.profile_of(World(s, d).profiles, "u3").select("user_id", "display_name")


@query("x06_territories", "select name from terr", "terr")
def _(s, d):
    return P.territory_names(World(s, d).territories)


@query("x06_write_tags", "select user_id, global_event_id, tag from tags where user_id <> 'u1' or global_event_id not in ('8', '15') union all select * from (values ('u1', '8', 'monitor'), ('u1', '15', 'monitor'), ('u9', '1', 'archive')) as t(user_id, global_event_id, tag)", "tags")
def _(s, d):
    """A group's tag goes to its event and to the others of the group; a user without a row gets one."""
    t = P.write_tags(World(s, d).tags, "u1", "8", "monitor", ["8", "15"])
    return P.write_tags(t, "u9", "1", "archive").select("user_id", F.explode("tags").alias("global_event_id", "tag"))


@query("x06_served_cards", f"select {CARD_SQL} from cards", "cards")
def _(s, d):
    """Cards from the published tables."""
    w, folder = World(s, d), storage.working_folder(s)
    storage.publish(s, {"articles": w.gold.articles, "links": w.gold.links}, folder)
    return card_columns(P.user_cards(P.Gold(storage.current(s, folder, "articles"), storage.current(s, folder, "links"), "OK"), w.tags, X.AS_OF))


@query("x03_enrich_urls", "select url, length(url) as n from pages group by url")
def _(s, d):
    """A pluggable fetcher: each URL once."""

    def fetcher(batches):
        for batch in batches:
            urls = batch.column(0)
            yield pa.RecordBatch.from_arrays([urls, urls, pa.array([""] * len(urls)), pa.array([True] * len(urls))], ["url", "title", "words", "ok"])

    pages = World(s, d).pages
    found = feeds.enrich_urls(pages.unionByName(pages), fetcher)
    return found.select("url", F.length("title").cast("long").alias("n"))


@query("s18_fixture", "select (select count(*) from be) as events, (select count(*) from bm) as mentions, (select count(*) from terr) as territories, 6 as users", "be", "bm", "terr")
def _(s, d):
    w = World(s, d)
    counts = (w.bronze_events.count(), w.bronze_mentions.count(), w.territories.count(), w.profiles.count())
    return s.createDataFrame([counts], "events long, mentions long, territories long, users int")


@query("x05_no_labels", "select distinct 'Unknown' as cameo_label from cat", "cat")
def _(s, d):
    w = World(s, d)
    return catalogue.build(w.events, w.mentions, feeds.read_labels(s)).select("cameo_label").distinct()


@query("u06_keyword_sets", "select * from (values ('oil & gas', 'gas,oil'), ('silicon wafers', 'silicon,wafer')) as t(k, v)")
def _(s, d):
    k = s.sql("select * from values ('oil & gas'), ('silicon wafers') as t(k)")
    return k.select("k", F.array_join(F.array_sort(F.array_distinct(F.transform(T.keyword_tokens(c("k")), T.stem))), ",").alias("v"))


@query("w11_latest_by_time", "select GLOBALEVENTID, max(DATEADDED) as DATEADDED from ev group by 1", "ev")
def _(s, d):
    newest = silver.latest(World(s, d).events, ["GLOBALEVENTID"], F.desc("DATEADDED"), F.desc("ActionGeo_CountryCode"))
    return newest.select("GLOBALEVENTID", "DATEADDED")
