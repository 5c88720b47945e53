import pytest
from pyspark.sql import functions as F

from riskloom import fixtures as X
from riskloom.operators import cards, catalogue, gold, matching, relevance, silver, validate
from riskloom.plans import pipeline as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def world(spark):
    e, m = P.to_silver(X.bronze_events(spark, SF), X.bronze_mentions(spark, SF))
    return e.cache(), m.cache()


def rows(df):
    return sorted(map(str, df.collect()))


def test_keyword_set_has_57_words():
    assert len(set(relevance.KEYWORDS)) == 57 and "cargoes" not in relevance.KEYWORDS


def test_substring_keywords(spark):
    df = spark.createDataFrame([("", "", "http://x/airline-report"), ("", "", "http://x/none")], "Actor1Name string, Actor2Name string, SOURCEURL string")
    assert [r[0] for r in df.select(relevance.has_keyword(df)).collect()] == [True, False]


def test_both_matching_forms_agree(spark, world):
    cat = catalogue.build(*world, X.labels(spark)).cache()
    args = (cat, X.profiles(spark), X.territories(spark, SF))
    assert rows(matching.match_by_filter(*args)) == rows(matching.match_relational(*args))


def test_users_without_constraints_match_all(spark, world):
    cat = catalogue.build(*world, X.labels(spark))
    n = {r.user_id: r["count"] for r in matching.match_relational(cat, X.profiles(spark), X.territories(spark, SF)).groupBy("user_id").count().collect()}
    assert n["u4"] == n["u5"] == cat.count() and "u6" not in n


def test_no_labels_give_unknown(spark, world):
    cat = catalogue.build(*world, catalogue.no_labels(spark))
    assert [r[0] for r in cat.select("cameo_label").distinct().collect()] == ["Unknown"]


def test_reingestion_changes_nothing(spark, world):
    e, m = world
    again = silver.latest_events(e.unionByName(e))
    assert rows(again) == rows(e)
    assert rows(silver.latest_mentions(m.unionByName(m))) == rows(m)


def test_incremental_is_part_of_full(spark, world):
    e, m = world
    args = (X.labels(spark), X.profiles(spark), X.territories(spark, SF))
    full, new = P.recompute(e, m, *args), P.recompute(e, m, *args, since="20240115000000")
    assert set(rows(new.links)) <= set(rows(full.links))
    with pytest.raises(ValueError):
        P.recompute(e, m, *args, since="2024", only_user="u1")


def test_whole_slice_rejection(spark):
    df = spark.createDataFrame([("a", "50"), ("a", "3000"), ("b", ""), ("b", "85.5"), ("c", "n/a")], "slice string, conf string")
    assert [r.slice for r in validate.accept_slices(df, "slice", validate.bad_confidence(F.col("conf"))).select("slice").distinct().collect()] == ["b"]


def test_bad_stamps(spark):
    df = spark.createDataFrame([("",), ("20240131094500",), ("202401310945",), ("20261316133000",), (None,)], "t string")
    assert [r[0] for r in df.select(validate.bad_stamp(F.col("t"))).collect()] == [False, False, True, True, False]


def test_blank_times_are_not_old(spark):
    e = spark.createDataFrame([(1, 20240120000000), (2, 20230101000000), (3, 20230101000000)], "GLOBALEVENTID long, DATEADDED long")
    m = spark.createDataFrame([(1, ""), (2, ""), (3, "20240120000000")], "GLOBALEVENTID long, MentionTimeDate string")
    assert [r[0] for r in silver.expired_ids(e, m, "20240110000000").collect()] == [2]


def test_merges(spark):
    old = spark.createDataFrame([("a", "1", "x"), ("b", "1", "x")], "doc_id string, global_event_id string, v string")
    new = spark.createDataFrame([("b", "1", "y"), ("c", "1", "y")], old.schema)
    assert rows(gold.upsert(old, new)) == rows(spark.createDataFrame([("a", "1", "x"), ("b", "1", "y"), ("c", "1", "y")], old.schema))
    assert rows(gold.insert_absent(old, new, gold.PAIR)) == rows(spark.createDataFrame([("a", "1", "x"), ("b", "1", "x"), ("c", "1", "y")], old.schema))


def test_run_mode():
    assert gold.run_mode("2", None, 1) == gold.run_mode("1", "2", 1) == gold.run_mode("3", "2", 12) == gold.run_mode("3", "2", 1, incremental=False) == "full"
    assert gold.run_mode("3", "2", 1) == "incremental"


def test_fingerprint_ignores_order(spark):
    df = spark.createDataFrame([("u", bytearray(b"a" * 32), "1"), ("u", bytearray(b"b" * 32), "2")], "user_id string, doc_id binary, global_event_id string")
    assert rows(gold.fingerprint(df)) == rows(gold.fingerprint(df.orderBy(F.desc("global_event_id"))))


def test_cards_with_null_confidence_and_tone(spark):
    schema = "user_id string, global_event_id string, url string, headline string, confidence int, in_raw_text int, mention_doc_tone double, mention_time timestamp_ntz, country string, latitude double, longitude double, cameo_code string, cameo_label string, actor string, risk_category string, goldstein double, event_date date, date_added timestamp_ntz, age_days int"
    base = (None, "X", 1.0, 2.0, "1", "L", "A", "", 0.0, None, None, 3)
    data = [("u", "1", f"http://{i}", h, conf, raw, tone, *base) for i, (h, conf, raw, tone) in enumerate([("T", None, 0, None), ("t ", 50, 0, -3.0), ("", 50, 0, 1.0), ("", None, None, None)])]
    (card,) = cards.build(spark.createDataFrame(data, schema)).collect()
    assert [a.url for a in card.articles] == ["http://2", "http://1", "http://3"] and card.max_confidence == 50 and not card.inrawtext_filtered


def test_empty_tables(spark, world):
    e, m = (df.limit(0) for df in world)
    g = P.recompute(e, m, X.labels(spark), X.profiles(spark), X.territories(spark, SF), relational=True)
    assert g.links.count() == 0 and P.user_cards(g, X.tags(spark), X.AS_OF).count() == 0
