import zipfile

from pyspark.sql import functions as F

from riskloom import fixtures as X
from riskloom.operators import validate
from riskloom.schemas import EVENT_FEED, EVENT_FEED_SCHEMA, MENTION_FEED, text_schema
from riskloom.sources import feeds, sinks
from riskloom.streaming import slices

SF = "/root/testdata/sf0.001"


def feed_rows(df, names):
    return df.select(*((F.col(n) if n in df.columns else F.lit("").alias(n)) for n in names))


def test_feed_round_trip(spark, tmp_path):
    b = feed_rows(X.bronze_events(spark, SF).limit(50), EVENT_FEED).cache()
    sinks.write_feed(b, f"{tmp_path}/feed")
    back = feeds.read_feed(spark, f"{tmp_path}/feed", EVENT_FEED_SCHEMA)
    assert sorted(map(str, back.collect())) == sorted(map(str, b.collect()))


def test_width_guard(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\nx\ty\tz\n")
    (tmp_path / "b.csv").write_text("x\ty\n")
    (tmp_path / "c.csv").write_text("\n \n")
    bad = validate.wrong_width(feeds.read_lines(spark, f"{tmp_path}/*.csv"), 3).collect()
    assert len(bad) == 1 and bad[0].path.endswith("b.csv") and bad[0].width == 2


def test_zipped_feed(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "20240101001500.mentions.CSV.zip", "w") as z:
        z.writestr("m.csv", "1\t2\t3\n4\t5\n")
    rows = feeds.read_zipped(spark, str(tmp_path), ["a", "b", "c"]).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [("20240101001500", "mentions", "1", "2", "3"), ("20240101001500", "mentions", "4", "5", "")]


def test_territories_and_labels(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"A": {"cameo": "X", "fips": ["Y", "Z"]}, "B": {"cameo": null, "fips": null}}')
    rows = {r.name: (r.cameo, r.fips) for r in feeds.read_territories(spark, f"{tmp_path}/t.json").collect()}
    assert rows == {"A": (["X"], ["Y", "Z"]), "B": ([], [])}
    (tmp_path / "l.tsv").write_bytes(b"code\tlabel\r\n01\t MAKE \r\nbroken\r\n")
    assert [tuple(r) for r in feeds.read_labels(spark, f"{tmp_path}/l.tsv").collect()] == [("01", "MAKE")]


def test_stream_to_silver(spark, tmp_path):
    source, events, check = tmp_path / "in", f"{tmp_path}/events", f"{tmp_path}/check"
    b = feed_rows(X.bronze_events(spark, SF), EVENT_FEED)
    for i in range(3):
        part = b.filter(F.col("GLOBALEVENTID").cast("bigint") % 3 == i)
        text = "\n".join("\t".join(r) for r in part.collect())
        source.mkdir(exist_ok=True)
        (source / f"2024010100{15 * i:02d}00.export.CSV").write_text(text + "\n")
    slices.events_to_silver(spark, str(source), events, check, every=None).awaitTermination()
    from riskloom.operators.silver import typed_events
    from riskloom.plans.pipeline import to_silver

    want = to_silver(X.bronze_events(spark, SF), X.bronze_mentions(spark, SF))[0]
    got = slices.latest_view(spark, events, "events")
    key = ["GLOBALEVENTID", "ActionGeo_CountryCode", "DATEADDED"]
    assert sorted(map(str, got.select(*key).collect())) == sorted(map(str, want.select(*key).collect()))
    # the same files again: latest-wins keeps the table as it was
    sinks.append_silver(b.filter("GLOBALEVENTID = '6'"), events, "events")
    assert typed_events(b).count() >= slices.latest_view(spark, events, "events").count()


def test_dead_letters_after_retries(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "20240101000000.export.CSV").write_text("\t".join(["1"] * 61) + "\n")
    seen, tried = [], []

    def fail(batch, number):
        tried.append(number)
        raise ValueError("no")

    slices.write_batches(slices.read_stream(spark, str(tmp_path / "in"), "events"), f"{tmp_path}/c", fail, lambda b, n, e: seen.append(str(e))).awaitTermination()
    assert seen == ["no"] and len(tried) == 3


def test_compaction_and_buckets(spark, tmp_path):
    e = X.bronze_events(spark, SF)
    sinks.append_silver(e, f"{tmp_path}/s", "events")
    sinks.compact(spark, f"{tmp_path}/s", f"{tmp_path}/t", "events")
    n = spark.read.parquet(f"{tmp_path}/t").count()
    assert n == e.select("GLOBALEVENTID", "ActionGeo_CountryCode").distinct().count()


def test_offline_enricher_and_schema(spark):
    pages = spark.createDataFrame([("http://a", "<TITLE x>Red\n Widgets</TITLE>"), ("http://b", "none"), ("http://c", None)], "url string, html string")
    got = {r.url: (r.title, r.ok) for r in feeds.page_titles(pages).collect()}
    assert got["http://a"] == ("Red Widgets", True) and got["http://b"] == ("", False)
    assert text_schema(MENTION_FEED).fieldNames()[0] == "GLOBALEVENTID"
