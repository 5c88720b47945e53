"""Folders that driver and executors share, and the few file operations that Spark's writers do not have.

Everything goes through Hadoop's file systems, so any store that Spark reads will do.
"""

from __future__ import annotations

import atexit
import contextlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: list[str] = []


def working_folder(spark: SparkSession) -> str:
    """A new folder inside spark.checkpoint.dir, or in a local run without one, in the warehouse; removed when the driver ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.riskloom"
    if not _folders:
        atexit.register(_leave, spark)
    _folders.append(f"{base.rstrip('/')}/work-{uuid.uuid4().hex}")
    return _folders[-1]


def _leave(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone
        for path in _folders:
            remove(spark, path)


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _at(spark, path)
    return fs.exists(hadoop)


def remove(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _at(spark, path)
    return fs.delete(hadoop, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, in order; none if it is not there."""
    hadoop, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def move(spark: SparkSession, source: str, folder: str) -> str:
    """Move a file into a folder, replacing one of its name there; returns the new path."""
    hadoop, fs = _at(spark, source)
    to, there = _at(spark, f"{folder.rstrip('/')}/{hadoop.getName()}")
    there.mkdirs(to.getParent())
    if there.exists(to):
        there.delete(to, False)
    if not fs.rename(hadoop, to):
        raise OSError(f"{source} cannot be moved to {folder}")
    return to.toString()


def put_new(spark: SparkSession, path: str, text: str = "") -> bool:
    """Write a small file if none is there; False if there is one: only one of several writers succeeds."""
    hadoop, fs = _at(spark, path)
    try:
        out = fs.create(hadoop, False)
    except Exception as e:  # noqa: BLE001  whatever the JVM calls it
        if "AlreadyExists" in str(e) or fs.exists(hadoop):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    hadoop, fs = _at(spark, path)
    try:
        stream = fs.open(hadoop)
    except Exception as e:  # noqa: BLE001  whatever the JVM calls it
        if "NotFound" in str(e) or not fs.exists(hadoop):
            return None
        raise
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows written as Parquet and read again: the plan behind them runs once."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class State:
    """A small record that survives the driver: each save is a new file, the greatest number counts, older ones are removed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _versions(self) -> list[str]:
        return [n for n in names(self.spark, self.folder) if n.endswith(".json") and not n.startswith(".")]

    def load(self, default: dict) -> dict:
        for name in reversed(self._versions()):
            with contextlib.suppress(ValueError):  # a write that was cut off: the one before it counts
                return json.loads(read_text(self.spark, f"{self.folder}/{name}") or "")
        return dict(default)

    def save(self, value: dict) -> None:
        old = self._versions()
        number = int(old[-1].split(".")[0]) + 1 if old else 0
        put_new(self.spark, f"{self.folder}/{number:012d}.json", json.dumps(value, sort_keys=True))
        for name in old[:-1]:
            remove(self.spark, f"{self.folder}/{name}")


@contextlib.contextmanager
def lock(spark: SparkSession, path: str, wait: float = 0.0, stale: float | None = None, pause: float = 0.2):
    """One holder at a time among all drivers that share `path`; others wait up to `wait` seconds, then are refused.

    stale: seconds after which a lock whose holder died may be taken over.
    """
    began = time.monotonic()
    while not put_new(spark, path, str(time.time())):
        held = read_text(spark, path)
        if stale is not None and held and time.time() - float(held) > stale:
            remove(spark, path)
        elif time.monotonic() - began >= wait:
            raise RuntimeError("a recompute is running")
        else:
            time.sleep(pause)
    try:
        yield
    finally:
        remove(spark, path)


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, keep: int = 2) -> str:
    """Write several tables beside the published ones and switch to all of them at once; returns the new version's folder.

    The version counts from the moment its marker file is there.  A run that fails leaves its tables for inspection and
    readers at the version before; the `keep` newest versions stay, so that readers that have begun can finish.
    """
    published = _published(spark, root)
    number = int(published[-1]) + 1 if published else 0
    folder = f"{root.rstrip('/')}/{number:012d}"
    remove(spark, folder)  # what a failed run may have left
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    put_new(spark, f"{folder}/_PUBLISHED")
    for old in published[: max(0, len(published) + 1 - keep)]:
        remove(spark, f"{root.rstrip('/')}/{old}")
    return folder


def _published(spark: SparkSession, root: str) -> list[str]:
    return [n for n in names(spark, root) if exists(spark, f"{root.rstrip('/')}/{n}/_PUBLISHED")]


def current(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table of the newest published version; None before the first."""
    published = _published(spark, root)
    return spark.read.parquet(f"{root.rstrip('/')}/{published[-1]}/{name}") if published else None
