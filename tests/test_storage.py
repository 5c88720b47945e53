import threading

import pytest

from riskloom import fixtures as X
from riskloom import storage
from riskloom.operators import matching, monitoring
from riskloom.plans import pipeline as P
from riskloom.streaming import slices

SF = "/root/testdata/sf0.001"


def test_state_survives_and_ignores_cut_off_writes(spark, tmp_path):
    state = storage.State(spark, f"file://{tmp_path}/state")
    assert state.load({"a": 1}) == {"a": 1}
    for i in range(4):
        state.save({"a": i})
    assert storage.State(spark, f"file://{tmp_path}/state").load({}) == {"a": 3}
    storage.put_new(spark, f"file://{tmp_path}/state/{99:012d}.json", '{"a": ')
    assert storage.State(spark, f"file://{tmp_path}/state").load({}) == {"a": 3}
    assert len(storage.names(spark, f"file://{tmp_path}/state")) <= 3


def test_lock_waits_and_is_freed_after_an_error(spark, tmp_path):
    path = f"file://{tmp_path}/lock"
    with pytest.raises(ValueError), storage.lock(spark, path):
        raise ValueError
    order = []
    held = threading.Event()

    def holder():
        with storage.lock(spark, path):
            held.set()
            threading.Event().wait(0.6)
            order.append("first")

    t = threading.Thread(target=holder)
    t.start()
    held.wait(10)
    with pytest.raises(RuntimeError), storage.lock(spark, path):
        pass
    with storage.lock(spark, path, wait=20.0):
        order.append("second")
    t.join()
    assert order == ["first", "second"] and not storage.exists(spark, path)


def test_exclusive_in_one_driver(spark):
    with monitoring.exclusive(), pytest.raises(RuntimeError), monitoring.exclusive():
        pass
    with monitoring.exclusive():
        pass


def test_publish_keeps_versions_and_ignores_unfinished_ones(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    assert storage.current(spark, root, "t") is None
    for i in range(4):
        storage.publish(spark, {"t": spark.range(i)}, root)
    assert storage.current(spark, root, "t").count() == 3 and len(storage._published(spark, root)) == 2
    spark.range(50).write.parquet(f"{root}/{4:012d}/t")  # a run that stopped before its marker
    assert storage.current(spark, root, "t").count() == 3
    storage.publish(spark, {"t": spark.range(7)}, root)
    assert storage.current(spark, root, "t").count() == 7


def test_clusters_need_a_shared_folder():
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "yarn", "spark.sql.warehouse.dir": "file:/tmp/x"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="checkpoint"):
        storage.working_folder(Session())


def test_many_users_are_matched_by_joins(spark, monkeypatch):
    monkeypatch.setattr(matching, "FEW_USERS", 3)
    e, m = P.to_silver(X.bronze_events(spark, SF), X.bronze_mentions(spark, SF))
    args = (X.labels(spark), X.profiles(spark), X.territories(spark, SF))
    with pytest.raises(ValueError, match="match_relational"):
        matching.matched_users(P.catalogue.build(e, m, args[0]), *args[1:])
    by_joins = P.recompute(e, m, *args)
    monkeypatch.setattr(matching, "FEW_USERS", 100)
    one_pass = P.recompute(e, m, *args)
    assert sorted(map(str, by_joins.links.collect())) == sorted(map(str, one_pass.links.collect()))
    key = ["doc_id", "global_event_id"]
    assert sorted(map(str, by_joins.articles.select(*key).collect())) == sorted(map(str, one_pass.articles.select(*key).collect()))


def test_rare_runs_find_spellings_anywhere(spark):
    urls = [("http://a.example.com/blue-bolt-1",), ("http://b.example.com/BLUE-bolts",), ("http://c.example.com/other",), ("http://c.example.com/r-x",)]
    catalogue = spark.createDataFrame(urls, "url string")
    words = spark.createDataFrame([("u1", "blue bolt"), ("u2", "com"), ("u3", "zeppelin"), ("u4", "R"), ("u4", "")], "user_id string, keyword string")
    got = {(r.user_id, r.url[7]) for r in matching._url_hits(catalogue, words).collect()}
    assert got == {("u1", "a"), ("u1", "b"), *(("u2", x) for x in "abcc"), ("u4", "c")}


def test_an_unmoved_watermark_runs_nothing_after_a_restart(spark, tmp_path):
    runs = []
    for now in ("1", "1", None, "2"):
        slices.watermark_step(storage.State(spark, f"file://{tmp_path}/w"), now, 0.0, lambda mode, since: runs.append((mode, since)))
    assert runs == [("full", None), ("incremental", "1")]
