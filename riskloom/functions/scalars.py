"""Typed conversions, keys, times and small classifications."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import safe_string


def id_or_zero(c: Column) -> Column:
    return F.coalesce(F.trim(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true", "t", "yes"), F.lit(False))


def doc_id(url: Column) -> Column:
    """SHA-256 of the URL as 32 bytes; null stays null."""
    return F.unhex(F.sha2(url.cast("binary"), 256))


def whole(c: Column) -> Column:
    """Integer by truncation; null if it is no number."""
    return c.try_cast("double").try_cast("int")


def number(c: Column) -> Column:
    return c.try_cast("double")


def country(full_name: Column, code: Column) -> Column:
    last = F.trim(F.element_at(F.split(F.coalesce(full_name, F.lit("")), ","), -1))
    return F.when(last != "", last).otherwise(code)


def day(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]{8}$"), F.try_to_timestamp(c, F.lit("yyyyMMdd"))).cast("date")


def stamp(c: Column) -> Column:
    """Time of a 14-digit stamp, without zone; null if it is none."""
    return F.when(c.rlike("^[0-9]{14}$"), F.try_to_timestamp(c, F.lit("yyyyMMddHHmmss"))).cast("timestamp_ntz")


def age_days(as_of, event_date: Column) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), event_date)


def month_of(c: Column) -> Column:
    return F.substring(c, 1, 6)


def floor_quarter(c: Column) -> Column:
    """Start of the 15-minute slice."""
    return F.timestamp_seconds(F.floor(F.unix_timestamp(c.cast("timestamp")) / 900) * 900).cast("timestamp_ntz")


def slice_id(c: Column) -> Column:
    return F.date_format(floor_quarter(c), "yyyyMMddHHmmss")


def slice_of_path(path: Column) -> Column:
    return F.regexp_extract(path, r"(\d{14})", 1)


def feed_kind(path: Column) -> Column:
    """events, mentions or unknown, by the file's name."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    return F.when(name.contains("mentions"), "mentions").when(name.contains("export"), "events").otherwise("unknown")


def slice_url(base: str, slice_name: Column, kind: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), slice_name, F.when(kind == "events", ".export.CSV.zip").otherwise(".mentions.CSV.zip"))


def lag_slices(expected: Column, watermark: Column) -> Column:
    return F.floor((F.unix_timestamp(expected.cast("timestamp")) - F.unix_timestamp(watermark.cast("timestamp"))) / 900)


def lag_light(lag: Column) -> Column:
    return F.when(lag <= 1, "green").when(lag == 2, "yellow").otherwise("red")


def stale_status(status: Column, updated: Column, now, seconds: int = 3600) -> Column:
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(updated.cast("timestamp"))
    return F.when((status == "OK") & (age > seconds), "STALE-PIPELINE").otherwise(status)


def overall_status(store_up: Column, profiles_up: Column, pipeline: Column) -> Column:
    return F.when(~store_up, "STORE-DOWN").when(~profiles_up, "PROFILE-STORE-DOWN").when(pipeline != "OK", pipeline).otherwise("OK")


def never_built(error: Column, updated: Column) -> Column:
    return (F.coalesce(error, F.lit("")) == "") & updated.isNull()


def tag_colour(tag: Column) -> Column:
    return F.when(tag == "requires_action", "red").when(tag == "monitor", "orange").when(tag == "archive", "green").otherwise("none")


def risk_score(goldstein: Column, articles: Column, tone: Column) -> Column:
    """0..10 from a hostile scale, coverage and a negative tone; what is no number counts as 0, 1 and 0."""
    clean = lambda c, default: F.coalesce(F.nanvl(safe_string(c).try_cast("double"), F.lit(None)), F.lit(default))
    hostile = (10 - clean(goldstein, 0.0)) / 2
    coverage = F.least(F.log10(F.greatest(clean(articles, 1.0), F.lit(1.0))), F.lit(2.0)) / 2
    negative = F.least(F.abs(F.least(clean(tone, 0.0), F.lit(0.0))) / 20, F.lit(1.0))
    return F.round(F.least(hostile + coverage + negative, F.lit(10.0)), 2)


def region_prefix(adm1: Column) -> Column:
    return F.when(F.length(adm1) >= 2, F.substring(adm1, 1, 2)).otherwise("")
