"""Readers: tab-separated feeds (plain or zipped), label and territory files, profiles, slice listings."""

from __future__ import annotations

import io
import time
import urllib.error
import urllib.request
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import feed_kind, slice_of_path, slice_url
from ..schemas import LABEL_SCHEMA, PROFILE_SCHEMA, TAG_SCHEMA, text_schema
from ..storage import exists
from . import embedded


def read_feed(spark: SparkSession, path, schema: T.StructType, strict: bool = True) -> DataFrame:
    """A feed without header, all text, empty where missing.  strict: a malformed line fails the read; else it is skipped."""
    df = spark.read.schema(schema).option("sep", "\t").option("header", False).option("quote", '"').option("escape", '"').option("mode", "FAILFAST" if strict else "DROPMALFORMED").csv(path)
    return df.na.fill("")


def read_lines(spark: SparkSession, path) -> DataFrame:
    """(path, line_no, value): lines of text files in order, for width checks."""
    df = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "value"))
    return df


def _unzipped(content: bytes, n: int) -> list[list[str]] | None:
    """The rows of a ZIP file's first member, short ones padded to n fields; None if it cannot be read or a row is too long."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            rows = [line.split("\t") for line in z.read(z.namelist()[0]).decode("utf-8", "replace").split("\n") if line.strip()]
    except (zipfile.BadZipFile, IndexError, NotImplementedError, RuntimeError):
        return None
    return [[f.rstrip("\r") for f in r] + [""] * (n - len(r)) for r in rows]


def unzip(files: DataFrame, names: list[str]) -> DataFrame:
    """(slice, kind, *names) from files (slice, kind, content): the first member of each; rows that are too long are left out."""
    schema = T.StructType([T.StructField("slice", T.StringType()), T.StructField("kind", T.StringType()), *text_schema(names)])
    n = len(names)

    def run(batches):
        for batch in batches:
            for slice_name, kind, content in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                rows = [r for r in _unzipped(content, n) or [] if len(r) == n]
                columns = [pa.array([slice_name] * len(rows), pa.string()), pa.array([kind] * len(rows), pa.string()), *(pa.array([r[i] for r in rows], pa.string()) for i in range(n))]
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return files.select("slice", "kind", "content").mapInArrow(run, schema)


def sane_files(files: DataFrame, widths: dict[str, int]) -> DataFrame:
    """(slice, kind, n_rows, ok): whether each file (slice, kind, content) can be read and has no row that is too long.

    A file that is not ok is kept out of its slice; widths: fields by kind.
    """

    def run(batches):
        for batch in batches:
            kinds = batch.column(1).to_pylist()
            rows = [_unzipped(content, widths.get(kind, 0)) for kind, content in zip(kinds, batch.column(2).to_pylist(), strict=True)]
            ok = [r is not None and all(len(x) == widths.get(kind) for x in r) for kind, r in zip(kinds, rows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(r or ()) for r in rows], pa.int64()), pa.array(ok)], ["slice", "kind", "n_rows", "ok"])

    return files.select("slice", "kind", "content").mapInArrow(run, "slice string, kind string, n_rows long, ok boolean")


def zip_files(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(slice, kind, content) of the ZIP files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(slice_of_path(F.col("path")).alias("slice"), feed_kind(F.col("path")).alias("kind"), "content")


def read_zipped(spark: SparkSession, path: str, names: list[str], glob: str = "*.zip") -> DataFrame:
    """(slice, kind, *names) of the first member of each ZIP file under a folder; short rows are padded with empty fields."""
    return unzip(zip_files(spark, path, glob), names)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, slice, kind, modified) of the files under a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", slice_of_path(F.col("path")).alias("slice"), feed_kind(F.col("path")).alias("kind"), F.col("modificationTime").alias("modified"))


def stable_files(files: DataFrame, now, seconds: int = 3) -> DataFrame:
    return files.filter(F.col("modified") <= F.lit(now).cast("timestamp") - F.expr(f"interval {seconds} seconds"))


def ready_slices(files: DataFrame, now, seconds: int = 3) -> DataFrame:
    """(slice, events, mentions): slices whose files are all old enough to be whole, partial ones too, to be taken oldest first."""
    known = files.filter("kind <> 'unknown'")
    young = known.join(stable_files(known, now, seconds).select("path"), "path", "left_anti").select("slice").distinct()
    path = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("path"))).alias(kind)
    return known.join(young, "slice", "left_anti").groupBy("slice").agg(path("events"), path("mentions"))


def orphans(files: DataFrame, now, seconds: int = 3600) -> DataFrame:
    """Files that have waited too long to be taken, whatever the reason; they go to the dead letters."""
    return files.filter((F.col("kind") != "unknown") & (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("modified") > seconds))


def released_slices(files: DataFrame, now, deadline_seconds: int = 600) -> DataFrame:
    """(slice, events, mentions): slices that are complete, or whose first file is older than the deadline."""
    g = files.groupBy("slice").agg(F.max(F.when(F.col("kind") == "events", F.col("path"))).alias("events"), F.max(F.when(F.col("kind") == "mentions", F.col("path"))).alias("mentions"), F.min("modified").alias("first"))
    late = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("first") > deadline_seconds
    return g.filter((F.col("events").isNotNull() & F.col("mentions").isNotNull()) | late).drop("first")


def slice_names(spark: SparkSession, end: str, days: int) -> DataFrame:
    """(slice): every 15 minutes of the last days up to a time floored to a slice, both ends included."""
    t = f"timestamp_ntz '{end}'"
    floored = f"date_trunc('hour', {t}) + make_interval(0,0,0,0,0,cast(floor(minute({t}) / 15) * 15 as int),0)"
    return spark.sql(f"select date_format(t, 'yyyyMMddHHmmss') as slice from (select explode(sequence({floored} - interval {int(days)} days, {floored}, interval 15 minutes)) as t)")


def slice_urls(spark: SparkSession, base: str, end: str, days: int, kinds=("events", "mentions")) -> DataFrame:
    s = slice_names(spark, end, days).withColumn("kind", F.explode(F.array(*map(F.lit, kinds))))
    return s.select("slice", "kind", slice_url(base, F.col("slice"), F.col("kind")).alias("url"))


def parse_manifest(lines: DataFrame, col: str = "value") -> DataFrame:
    """(kind, url) from the third field of a manifest's lines."""
    url = F.get(F.split(F.trim(col), " +"), F.lit(2))
    return lines.select(feed_kind(url).alias("kind"), url.alias("url")).filter("url is not null and kind <> 'unknown'")


def fetch(url: str, tries: int = 3, wait: float = 5.0, linear: bool = False, missing_is_final: bool = False, timeout: float = 60.0, opener: Callable = urllib.request.urlopen, sleep: Callable = time.sleep) -> tuple[str, bytes | None]:
    """("ok", content), ("missing", None) after a 404, or ("failed", None).

    Between tries it waits `wait` seconds, or with `linear` that times the number of tries so far.  missing_is_final: a 404
    is not tried again (a slice of the past that was never made, unlike the newest one).
    """
    status = "failed"
    for turn in range(1, tries + 1):
        try:
            with opener(url, timeout=timeout) as f:
                return "ok", f.read()
        except urllib.error.HTTPError as e:
            status = "missing" if e.code == 404 else "failed"
            if status == "missing" and missing_is_final:
                return status, None
        except OSError as e:
            # a file: URL of nothing
            status = "missing" if isinstance(getattr(e, "reason", e), FileNotFoundError) else "failed"
            if status == "missing" and missing_is_final:
                return status, None
        if turn < tries:
            sleep(wait * turn if linear else wait)
    return status, None


def latest_urls(manifest_url: str, **options) -> dict[str, str]:
    """URL by kind from the manifest of the newest slice; its 404s are tried again, since the file is being replaced."""
    status, content = fetch(manifest_url, **options)
    if status != "ok":
        raise OSError(f"the manifest is {status}")
    out: dict[str, str] = {}
    for line in (content or b"").decode("utf-8", "replace").splitlines():
        for kind, ending in (("events", ".export.CSV.zip"), ("mentions", ".mentions.CSV.zip")):
            if len(line.split()) >= 3 and line.split()[2].endswith(ending):
                out[kind] = line.split()[2]
    return out


def backfill_list(urls: DataFrame, have: DataFrame) -> DataFrame:
    return urls.join(have.select("slice", "kind"), ["slice", "kind"], "left_anti")


def download(urls: DataFrame, parallel: int = 4, fetcher: Callable[[str], tuple[str, bytes | None]] | None = None) -> DataFrame:
    """(slice, kind, url, status, content) of each URL; `parallel` tasks, since feeds limit the rate."""

    def run(batches):
        get = fetcher or (lambda url: fetch(url, linear=True, missing_is_final=True))
        for batch in batches:
            found = [get(url) for url in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.binary())], ["slice", "kind", "url", "status", "content"])

    return urls.select("slice", "kind", "url").repartition(parallel).mapInArrow(run, "slice string, kind string, url string, status string, content binary")


def backfill(spark: SparkSession, urls: DataFrame, staging: str, parallel: int = 4, fetcher: Callable | None = None) -> DataFrame:
    """Download what `staging` does not have yet, append it there, and return all that is staged; missing files are asked for again."""
    schema = "slice string, kind string, url string, status string, content binary"
    have = spark.read.schema(schema).option("ignoreMissingFiles", True).parquet(staging) if exists(spark, staging) else spark.createDataFrame([], schema)
    new = download(backfill_list(urls, have), parallel, fetcher).filter("status = 'ok'")
    new.write.mode("append").parquet(staging)
    return spark.read.schema(schema).parquet(staging)


def read_labels(spark: SparkSession, *paths: str) -> DataFrame:
    """Event codes and labels from the first of the paths that is there, else none: every label is "Unknown" then."""
    for path in paths:
        if exists(spark, path):
            df = spark.read.schema(LABEL_SCHEMA).option("sep", "\t").option("header", True).csv(path)
            return df.select(F.trim("lookup_code").alias("lookup_code"), F.trim(F.regexp_replace("lookup_label", "\r$", "")).alias("lookup_label")).filter("lookup_label is not null")
    return spark.createDataFrame([], LABEL_SCHEMA)


def read_territories(spark: SparkSession, path: str) -> DataFrame:
    """(name, cameo, fips) from one JSON object of names; codes may be text, a list or null."""
    raw = spark.read.option("wholetext", True).text(path)
    rows = raw.select(F.explode(F.from_json("value", "map<string,struct<cameo:string,fips:string>>")).alias("name", "v"))
    as_list = lambda c: F.when(c.isNull(), F.array().cast("array<string>")).when(c.startswith("["), F.from_json(c, "array<string>")).otherwise(F.array(c))
    return rows.select("name", as_list(F.col("v.cameo")).alias("cameo"), as_list(F.col("v.fips")).alias("fips"))


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROFILE_SCHEMA).json(path)


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TAG_SCHEMA).json(path)


def read_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A whole JDBC table, by one connection."""
    if embedded.driver_only(spark, url):
        return embedded.read(spark, url, table, ["1 = 1"], options)
    return spark.read.jdbc(url, table, properties=options)


def read_partitioned(spark: SparkSession, url: str, table: str, key: str, low: int | None = None, high: int | None = None, parts: int = 8, where: str | None = None, **options) -> DataFrame:
    """A JDBC table in `parts` key ranges; `where` runs in the store.  Bounds that are not given are asked for; an empty table has no rows."""
    source = f"(select * from {table}{' where ' + where if where else ''}) t"
    if low is None or high is None:
        found = read_table(spark, url, f"(select min({key}) as low, max({key}) as high from {source}) b", **options).first()
        low, high = found[0], found[1]
        if low is None:
            return read_table(spark, url, f"(select * from {table} where 1 = 0) t", **options)
    if embedded.driver_only(spark, url):
        return embedded.read(spark, url, source, embedded.ranges(key, low, high, parts), options)
    return spark.read.jdbc(url, source, column=key, lowerBound=low, upperBound=high + 1, numPartitions=parts, properties=options)


def page_titles(pages: DataFrame) -> DataFrame:
    """(url, title, words, ok): the offline enricher: titles from stored pages, once per URL."""
    title = F.trim(F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))
    one = pages.groupBy("url").agg(F.min("html").alias("html")).select("url", title.alias("title"))
    return one.select("url", "title", F.array_join(F.array_distinct(F.filter(F.split(F.lower("title"), "[^a-z0-9]+"), lambda t: F.length(t) > 3)), ", ").alias("words"), (F.col("title") != "").alias("ok"))


def enrich_urls(urls: DataFrame, fetcher, schema: str = "url string, title string, words string, ok boolean") -> DataFrame:
    """Each distinct URL through a fetcher of Arrow batches (mapInArrow)."""
    return urls.select("url").distinct().mapInArrow(fetcher, schema)
