"""Checks on user profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .matching import user_keywords

NAME_PATTERN = "^[A-Za-z0-9_]{1,20}$"
MOST_KEYWORDS = 1000


def problems(profiles: DataFrame, territories: DataFrame, least: int = 20) -> DataFrame:
    """(user_id, problem): too few territories or answers, repeated ones, and unknown territories."""
    t = profiles.select("user_id", F.explode("territories").alias("name"))
    few = profiles.filter(F.size(F.coalesce("territories", F.array().cast("array<string>"))) < least).select("user_id", F.lit("few territories").alias("problem"))
    twice = t.groupBy("user_id", "name").count().filter("count > 1").select("user_id", F.concat(F.lit("repeated territory "), "name").alias("problem"))
    unknown = t.distinct().join(territories.select("name"), "name", "left_anti").select("user_id", F.concat(F.lit("unknown territory "), "name").alias("problem"))
    answers = profiles.select("user_id", F.explode("keywords").alias("question", "words"))
    short = answers.filter(F.size("words") < least).select("user_id", F.concat(F.lit("few answers to "), "question").alias("problem"))
    return few.unionByName(twice).unionByName(unknown).unionByName(short)


def overlap(profiles: DataFrame) -> DataFrame:
    """(user_a, user_b, shared): number of keywords that two users share; pairs without any are left out."""
    w = user_keywords(profiles).select("user_id", F.lower("keyword").alias("k")).distinct()
    a, b = w.select(F.col("user_id").alias("user_a"), "k"), w.select(F.col("user_id").alias("user_b"), "k")
    return a.join(b, "k").filter("user_a < user_b").groupBy("user_a", "user_b").agg(F.count(F.lit(1)).alias("shared"))


def input_rules(profiles: DataFrame) -> DataFrame:
    """(user_id, valid_name, one_word, distinct_words, within_limit)."""
    w = profiles.select("user_id", F.flatten(F.map_values("keywords")).alias("k"))
    each = F.forall("k", lambda x: F.size(F.filter(F.split(F.trim(x), " +"), lambda p: p != "")) == 1)
    return w.select("user_id", F.col("user_id").rlike(NAME_PATTERN).alias("valid_name"), each.alias("one_word"), (F.size(F.array_distinct(F.transform("k", F.lower))) == F.size("k")).alias("distinct_words"), (F.size("k") <= MOST_KEYWORDS).alias("within_limit"))
