"""Checks on slices and rows before anything is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import id_or_zero


def field_widths(lines: DataFrame, path_col: str = "path", line_col: str = "value", number_col: str = "line_no") -> DataFrame:
    """(path, width): fields of each file's first line that is not blank; files without one are left out."""
    full = lines.filter(F.trim(line_col) != "")
    return full.groupBy(path_col).agg(F.min_by(F.size(F.split(line_col, "\t")), number_col).alias("width"))


def wrong_width(lines: DataFrame, expected: int, **names) -> DataFrame:
    return field_widths(lines, **names).filter(F.col("width") != expected)


def bad_confidence(c: Column) -> Column:
    """Not empty, and no number from 0 to 100."""
    value = F.trim(c).try_cast("double")
    return (F.trim(F.coalesce(c, F.lit(""))) != "") & ~F.coalesce(value.between(0, 100), F.lit(False))


def bad_stamp(c: Column) -> Column:
    """Not empty, and not 14 digits that are a time."""
    text = F.trim(F.coalesce(c, F.lit("")))
    real = text.rlike("^[0-9]{14}$") & F.try_to_timestamp(F.when(text.rlike("^[0-9]{14}$"), text), F.lit("yyyyMMddHHmmss")).isNotNull()
    return (text != "") & ~F.coalesce(real, F.lit(False))


def rejected_slices(df: DataFrame, slice_col: str, bad: Column) -> DataFrame:
    """(slice, bad): slices with any bad value; one value rejects all of its slice."""
    return df.groupBy(slice_col).agg(F.count_if(bad).alias("bad")).filter("bad > 0")


def accept_slices(df: DataFrame, slice_col: str, bad: Column) -> DataFrame:
    return df.join(rejected_slices(df, slice_col, bad).select(slice_col), slice_col, "left_anti")


def processable(files: DataFrame, slice_col: str = "slice", kind_col: str = "kind") -> DataFrame:
    """(slice, kinds, is_pair): slices with an event file, a mention file, or both."""
    known = files.filter(F.col(kind_col).isin("events", "mentions"))
    out = known.groupBy(slice_col).agg(F.array_join(F.array_sort(F.collect_set(kind_col)), "+").alias("kinds"))
    return out.withColumn("is_pair", F.col("kinds") == "events+mentions")


def pair_slices(events: DataFrame, mentions: DataFrame, slice_col: str = "slice") -> DataFrame:
    """(slice, event_path, mention_path): the files of each slice; either may be missing."""
    e = events.select(slice_col, F.col("path").alias("event_path"))
    return e.join(mentions.select(slice_col, F.col("path").alias("mention_path")), slice_col, "full_outer")


def referential(mentions: DataFrame, own_events: DataFrame, stored_events: DataFrame | None = None, key: str = "GLOBALEVENTID") -> DataFrame:
    """Mentions of events in the same slice (own_events) or in the store.  Pass no store for the bulk loader's stricter mode."""
    ids = own_events.select(id_or_zero(F.col(key)).alias("_id"))
    if stored_events is not None:
        ids = ids.union(stored_events.select(id_or_zero(F.col(key)).alias("_id")))
    kept = mentions.withColumn("_id", id_or_zero(F.col(key))).filter("_id > 0")
    return kept.join(ids.distinct(), "_id", "left_semi").drop("_id")


def slice_report(mentions: DataFrame, kept: DataFrame) -> DataFrame:
    """(seen, kept, dropped, enriched) as one row."""
    seen = mentions.agg(F.count(F.lit(1)).alias("seen"))
    left = kept.agg(F.count(F.lit(1)).alias("kept"), F.count_if(F.col("enriched") == 1).alias("enriched"))
    return seen.join(left).withColumn("dropped", F.col("seen") - F.col("kept"))
