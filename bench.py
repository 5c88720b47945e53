"""Times the headline queries: python bench.py.  BENCH_SF_DIR: the tables; BENCH_CPUS: local cores.  Prints one JSON line."""

import json
import os
import statistics
import time

from riskloom.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
#: Relevance, versions, catalogue, matching (both forms), cards, serving: the whole recompute is `recompute_full`.
HEADLINE = ("f05_relevant", "a03_latest_events", "a03_latest_mentions", "a06_catalogue", "j10_match_by_filter", "j10_match_relational", "a07_cards", "a11_grouped_cards", "a04_expired_ids", "c17_row_tokens")


def main() -> None:
    spark = local_session(CPUS)
    from riskloom import fixtures, queries, storage
    from riskloom.plans import pipeline

    folder = storage.working_folder(spark)

    def recompute_full(s, d):
        """Silver on disk -> articles and links of all users, as the reference's full recompute."""
        w = queries.World(s, d)
        for kind in ("events", "mentions"):
            w.__dict__[kind] = s.read.parquet(f"{folder}/{kind}")
        g = pipeline.recompute(w.events, w.mentions, w.labels, w.profiles, w.territories)
        g.articles.drop("row_tokens").write.mode("overwrite").parquet(f"{folder}/articles")
        return g.links

    events, mentions = pipeline.to_silver(fixtures.bronze_events(spark, SF_DIR), fixtures.bronze_mentions(spark, SF_DIR))
    events.write.mode("overwrite").parquet(f"{folder}/events")
    mentions.write.mode("overwrite").parquet(f"{folder}/mentions")
    todo = {n: queries.QUERIES[n] for n in HEADLINE} | {"recompute_full": recompute_full}
    try:
        from riskloom.llm import registry

        todo |= registry.QUERIES
    except ImportError:
        pass
    seconds = {}
    for name, f in todo.items():
        times = []
        for _ in range(RUNS if name in HEADLINE or name == "recompute_full" else 1):
            begin = time.perf_counter()
            f(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
            spark.catalog.clearCache()
        seconds[name] = round(statistics.median(times), 3)
    head = {n: s for n, s in seconds.items() if n in HEADLINE or n == "recompute_full"}
    rows = {k: spark.read.parquet(f"{folder}/{k}").count() for k in ("events", "mentions")}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(head.values()), 3), "unit": "sec", "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1], "silver_rows": rows, "users": len(fixtures.PROFILES), "cpus": CPUS}))


if __name__ == "__main__":
    main()
