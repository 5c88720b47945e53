"""Writers: silver by month, snapshots, feeds, dead letters.  Spark's commit protocol makes each write whole or absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.silver import latest_events, latest_mentions, typed_events, typed_mentions
from . import embedded


def write_feed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", False).option("quote", '"').option("escape", '"').option("emptyValue", "").option("nullValue", "").csv(path)


def write_slice(df: DataFrame, folder: str, name: str) -> str:
    """One slice's file under its own name: written apart, then renamed, so that readers see it whole or not at all."""
    spark, apart = df.sparkSession, f"{folder.rstrip('/')}/.{name}"
    write_feed(df.coalesce(1), apart)
    part = next((n for n in storage.names(spark, apart) if n.startswith("part-")), None)
    path = f"{folder.rstrip('/')}/{name}"
    if part is None:  # no rows
        storage.put_new(spark, path)
    else:
        hadoop, fs = storage._at(spark, f"{apart}/{part}")
        to, _ = storage._at(spark, path)
        fs.delete(to, False)
        fs.rename(hadoop, to)
    storage.remove(spark, apart)
    return path


def _by_month(df: DataFrame) -> DataFrame:
    """A month's rows in as many tasks and files as they need: rebalancing splits a large month and packs small ones together."""
    return df.hint("rebalance", "month").sortWithinPartitions("month", "GLOBALEVENTID")


def append_silver(df: DataFrame, path: str, kind: str) -> None:
    """Rows of one or many slices in one append, a folder a month, sorted by id within files for row-group skipping."""
    typed = typed_events(df) if kind == "events" else typed_mentions(df)
    _by_month(typed).write.mode("append").partitionBy("month").parquet(path)


def compact(spark: SparkSession, path: str, to: str, kind: str) -> None:
    """The latest rows only, written beside the old table; readers switch by path."""
    df = spark.read.parquet(path)
    kept = latest_events(df) if kind == "events" else latest_mentions(df)
    _by_month(kept).write.mode("overwrite").partitionBy("month").parquet(to)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = "GLOBALEVENTID", path: str | None = None) -> None:
    """Events and mentions bucketed alike join on the key without a shuffle; with `path` the table's files lie there."""
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def export_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def restore_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def wipe(df: DataFrame, path: str) -> None:
    """An empty table of the same columns in place of the old one."""
    df.limit(0).write.mode("overwrite").parquet(path)


def recreate(spark: SparkSession, snapshot: str, path: str) -> None:
    """The table as the snapshot has it."""
    restore_snapshot(spark, snapshot).write.mode("overwrite").parquet(path)


def write_gold(df: DataFrame, path: str, partitions: int = 4) -> None:
    df.repartition(partitions).write.mode("overwrite").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", partitions: int = 4, truncate: bool = False, **options) -> None:
    if embedded.driver_only(df.sparkSession, url):
        return embedded.write(df, url, table, mode, truncate, options)
    df.repartition(partitions).write.option("batchsize", 5000).option("truncate", truncate).jdbc(url, table, mode, options)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_report(df: DataFrame, path: str) -> None:
    """Rows added to a CSV report of runs."""
    df.coalesce(1).write.mode("append").option("header", True).csv(path)


def publish_territories(territories: DataFrame, root: str) -> None:
    """The territory table for serving, replaced as a whole; see storage.current()."""
    storage.publish(territories.sparkSession, {"territories": territories.select("name", "cameo", "fips").coalesce(1)}, root)


LOG_SCHEMA = "file_name string, dead_letter_day string, dead_letter_time string"


def log_rows(failures: DataFrame, now: str) -> DataFrame:
    """(file_name, dead_letter_day, dead_letter_time)"""
    t = F.lit(now).cast("timestamp_ntz")
    return failures.select("file_name", F.date_format(t, "yyyy-MM-dd").alias("dead_letter_day"), F.date_format(t, "HH:mm:ss").alias("dead_letter_time"))


def dead_letters(failures: DataFrame, now: str, keep: int = 10_000) -> DataFrame:
    """The log of one run's failures, the first `keep` by name."""
    return log_rows(failures, now).orderBy("file_name").limit(keep)


def append_dead_letters(log: DataFrame, failures: DataFrame, now: str, keep: int = 10_000) -> DataFrame:
    """The log with new rows behind the old ones; a full log takes no more until it is purged."""
    room = max(0, keep - log.count())
    return log.unionByName(log_rows(failures, now).orderBy("file_name").limit(room))


def move_dead_letters(spark: SparkSession, paths: list[str], folder: str, slice_name: str, now: str) -> DataFrame:
    """Move the files of an abandoned slice out of the way, never deleting them; returns their log rows."""
    moved = [storage.move(spark, path, f"{folder.rstrip('/')}/{slice_name}") for path in paths if storage.exists(spark, path)]
    return log_rows(spark.createDataFrame([(m.rsplit("/", 1)[-1],) for m in moved], "file_name string"), now)


def stale_letters(log: DataFrame, now: str, days: int = 365) -> DataFrame:
    """Rows of the log that are older than `days`; rows without a usable stamp never are."""
    stamp = F.try_to_timestamp(F.concat_ws(" ", F.trim("dead_letter_day"), F.trim("dead_letter_time")), F.lit("yyyy-MM-dd HH:mm:ss"))
    return log.filter(stamp < F.lit(now).cast("timestamp") - F.expr(f"interval {int(days)} days"))


def purge_dead_letters(log: DataFrame, deleted: DataFrame) -> DataFrame:
    """The log without the rows of deleted files (file_name), and without rows that name no file."""
    return log.filter(F.trim(F.coalesce("file_name", F.lit(""))) != "").join(deleted.select("file_name").distinct(), "file_name", "left_anti").select(*log.columns)


def purge_dead_letter_files(spark: SparkSession, folder: str, log: DataFrame, now: str, days: int = 365) -> DataFrame:
    """Delete the files of stale rows; returns the log without them.  A stale row whose file is not there stays."""
    stale = [r.file_name for r in stale_letters(log, now, days).select(F.trim("file_name").alias("file_name")).distinct().collect()]  # the log is bounded
    gone = []
    for slice_name in storage.names(spark, folder) if stale else ():
        for name in set(storage.names(spark, f"{folder.rstrip('/')}/{slice_name}")) & set(stale):
            storage.remove(spark, f"{folder.rstrip('/')}/{slice_name}/{name}")
            gone.append((name,))
    return purge_dead_letters(log, spark.createDataFrame(gone, "file_name string"))
