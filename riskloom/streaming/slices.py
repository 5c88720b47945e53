"""Structured Streaming: feed files to silver, slice by slice, and gold after it."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import slice_of_path, stamp
from ..operators import relevance, silver, validate
from ..operators.gold import run_mode
from ..schemas import EVENT_FEED_SCHEMA, MENTION_FEED_SCHEMA
from ..sources import feeds
from ..sources.sinks import append_silver
from ..storage import State


def read_stream(spark: SparkSession, path: str, kind: str, files_per_batch: int = 50) -> DataFrame:
    """Feed files as they appear, with their slice; oldest files first, several slices a batch (by_slice puts these in order).

    The file source takes a file as soon as it has its name, so writers must rename whole files into the folder, as
    sinks.write_slice does; for others see take_slices.
    """
    schema = EVENT_FEED_SCHEMA if kind == "events" else MENTION_FEED_SCHEMA
    df = spark.readStream.schema(schema).option("sep", "\t").option("header", False).option("maxFilesPerTrigger", files_per_batch).option("latestFirst", False).csv(path)
    return df.na.fill("").withColumn("slice", slice_of_path(F.input_file_name()))


def write_batches(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], dead: Callable[[DataFrame, int, Exception], None] | None = None, tries: int = 3, every: str | None = None) -> StreamingQuery:
    """handle(batch, id) with bounded retries, then dead(batch, id, error).  Without `every`, what is there now and stop."""

    def run(batch: DataFrame, number: int) -> None:
        for turn in range(tries):
            try:
                handle(batch, number)
                return
            except Exception as e:  # noqa: BLE001  the last one goes to the dead letters
                if turn == tries - 1:
                    if dead is None:
                        raise
                    dead(batch, number, e)

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def by_slice(handle: Callable[[DataFrame, str], None], progress: State | None = None, dead: Callable[[str, Exception], None] | None = None, tries: int = 3) -> Callable[[DataFrame, int], None]:
    """A batch handler that takes the slices of a micro-batch one by one, oldest first, whatever order their files came in.

    A slice that fails `tries` times goes to dead(slice, error) and the later ones go on.  progress keeps the greatest slice
    done: a late slice is done like any other and never moves it back.  Slices in a batch are bounded by its files.
    """

    def run(batch: DataFrame, number: int) -> None:
        for (name,) in batch.select("slice").distinct().orderBy("slice").collect():
            for turn in range(tries):
                try:
                    handle(batch.filter(F.col("slice") == name), name)
                    break
                except Exception as e:  # noqa: BLE001  the last one goes to the dead letters
                    if turn == tries - 1:
                        if dead is None:
                            raise
                        dead(name, e)
            else:
                continue
            if progress is not None:
                state = progress.load({"watermark": ""})
                if name > state["watermark"]:
                    progress.save({**state, "watermark": name})

    return run


def take_slices(spark: SparkSession, source: str, state: State, handle: Callable[[str, str | None, str | None], None], dead: Callable[[str, list[str], str], None], now: str, tries: int = 3, seconds: int = 3) -> list[str]:
    """Hand over the ready slices of a folder, oldest first: handle(slice, events path, mentions path); returns those done.

    For feeds whose writers do not rename: only files of `seconds` of age are taken, in pairs or alone.  Failed attempts and
    the watermark are kept in `state`, so a restart goes on where it stopped; after `tries` failures dead(slice, paths,
    reason) is called, and the slices behind go on.  One file listing a call; handle() removes or moves what it has taken.
    """
    kept, done = state.load({"watermark": "", "attempts": {}}), []
    for r in feeds.ready_slices(feeds.list_files(spark, source), now, seconds).orderBy("slice").toLocalIterator():
        try:
            handle(r.slice, r.events, r.mentions)
            kept["attempts"].pop(r.slice, None)
            kept["watermark"] = max(kept["watermark"], r.slice)
            done.append(r.slice)
        except Exception as e:  # noqa: BLE001  counted, then dead-lettered
            kept["attempts"][r.slice] = kept["attempts"].get(r.slice, 0) + 1
            if kept["attempts"][r.slice] >= tries:
                dead(r.slice, [p for p in (r.events, r.mentions) if p], f"{tries} failed attempts: {e}")
                kept["attempts"].pop(r.slice)
        state.save(kept)
    return done


def sweep_orphans(spark: SparkSession, source: str, now: str, dead: Callable[[str, list[str], str], None], seconds: int = 3600) -> list[str]:
    """Set aside files that nothing has taken for `seconds`; returns their paths."""
    waiting = feeds.orphans(feeds.list_files(spark, source), now, seconds).orderBy("slice", "path").collect()
    for r in waiting:
        dead(r.slice, [r.path], f"unconsumed for over {seconds} s")
    return [r.path for r in waiting]


def events_to_silver(spark: SparkSession, source: str, silver_path: str, checkpoint: str, **options) -> StreamingQuery:
    """Relevant events appended to silver; late slices too: the latest version of a key counts when silver is read."""

    def handle(batch: DataFrame, number: int) -> None:
        good = validate.accept_slices(batch, "slice", validate.bad_stamp(F.col("DATEADDED")))
        append_silver(good.filter(relevance.is_relevant(good)).drop("slice"), silver_path, "events")

    return write_batches(read_stream(spark, source, "events"), checkpoint, handle, **options)


def mentions_to_silver(spark: SparkSession, source: str, silver_events: str, silver_path: str, checkpoint: str, **options) -> StreamingQuery:
    def handle(batch: DataFrame, number: int) -> None:
        good = validate.accept_slices(batch, "slice", validate.bad_confidence(F.col("Confidence")))
        stored = spark.read.parquet(silver_events)
        kept = validate.referential(good, stored).withColumns({"article_title": F.lit(""), "article_keywords": F.lit(""), "enriched": F.lit("0")})
        append_silver(kept.drop("slice"), silver_path, "mentions")

    return write_batches(read_stream(spark, source, "mentions"), checkpoint, handle, **options)


def slice_counts(events: DataFrame, stamp_col: str = "DATEADDED", late: str = "1 day") -> DataFrame:
    """(window, n): events by 15-minute window; state of windows older than the watermark is dropped."""
    df = events.withColumn("t", stamp(F.col(stamp_col).cast("string")).cast("timestamp")).filter("t is not null")
    return df.withWatermark("t", late).groupBy(F.window("t", "15 minutes")).agg(F.count(F.lit(1)).alias("n"))


#: Seconds without a new watermark after which silver counts as stalled.
IDLE = 45 * 60


def watermark_step(state: State, now_stamp: str | None, seconds: float, run: Callable[[str, str | None], None], stale: Callable[[int], None] | None = None, idle: float = IDLE) -> str | None:
    """One look at silver's watermark: run(mode, since) if it moved, forward or backward; the mode, "stale", or None.

    seconds: the time of the look.  The state survives the driver: after a restart an unmoved watermark runs nothing.  After
    `idle` seconds without a move, stale(seconds) is called once.  A run that fails leaves the state as it was, to be tried again.
    """
    kept = state.load({"last": None, "runs": 0, "moved": seconds, "stale": False})
    if now_stamp and now_stamp != kept["last"]:
        mode = run_mode(now_stamp, kept["last"], kept["runs"])
        run(mode, kept["last"] if mode == "incremental" else None)
        state.save({"last": now_stamp, "runs": kept["runs"] + 1, "moved": seconds, "stale": False})
        return mode
    waited = seconds - kept["moved"]
    if waited > idle and not kept["stale"]:
        if stale is not None:
            stale(int(waited))
        state.save({**kept, "stale": True})
        return "stale"
    if kept["last"] is None:
        state.save(kept)  # the clock runs from the first look
    return None


def recompute_on_change(watermarks: DataFrame, checkpoint: str, run: Callable[[str, str | None], None], stale: Callable[[int], None] | None = None, **options) -> StreamingQuery:
    """run(mode, since) whenever the newest stamp of a stream of silver rows moves; its state lies beside the checkpoint.

    A stream only sees new rows, so its newest stamp moves backward when silver was built again with an earlier end.
    """
    state = State(watermarks.sparkSession, f"{checkpoint.rstrip('/')}-state")

    def handle(batch: DataFrame, number: int) -> None:
        watermark_step(state, batch.agg(F.max("DATEADDED").cast("string")).first()[0], time.time(), run, stale)

    return write_batches(watermarks, checkpoint, handle, **options)


def profile_changes(spark: SparkSession, path: str, schema, checkpoint: str, run: Callable[[str], None], **options) -> StreamingQuery:
    """run(user) for each changed profile, once a batch."""

    def handle(batch: DataFrame, number: int) -> None:
        for r in batch.select("user_id").distinct().orderBy("user_id").toLocalIterator():
            run(r.user_id)

    return write_batches(spark.readStream.schema(schema).json(path), checkpoint, handle, **options)


def liveness(last_file, now, error_files: list[str], fresh_files: list[str], minutes: int = 35) -> str:
    """ERROR after `minutes` without files; cleared only by files that were not there at the error."""
    if fresh_files and not set(fresh_files) & set(error_files):
        return "OK"
    return "ERROR" if last_file is None or (now - last_file).total_seconds() > minutes * 60 else "OK"


def latest_view(spark: SparkSession, path: str, kind: str) -> DataFrame:
    df = spark.read.parquet(path)
    return silver.latest_events(df) if kind == "events" else silver.latest_mentions(df)
