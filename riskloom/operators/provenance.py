"""Why an article is in gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import keyword_tokens, row_tokens, stem, url_variants
from .matching import user_keywords


def geo_match(cameo: Column, fips: Column) -> dict[str, Column]:
    """System, code and field of all territory matches, each once and in order."""
    fields = [("CAMEO", "Actor1CountryCode", cameo), ("CAMEO", "Actor2CountryCode", cameo), ("FIPS", "ActionGeo_CountryCode", fips), ("FIPS", "Actor1Geo_CountryCode", fips), ("FIPS", "Actor2Geo_CountryCode", fips)]
    rows = []
    for system, name, codes in fields:
        value = F.upper(F.trim(F.coalesce(F.col(name), F.lit(""))))
        rows.append(F.when((value != "") & F.array_contains(codes, value), F.struct(F.lit(system).alias("system"), value.alias("code"), F.lit(name).alias("field"))))
    hits = F.filter(F.array(*rows), lambda r: r.isNotNull())
    return {f"geo_match_{n}": F.array_join(F.array_distinct(hits[n]), "|") for n in ("system", "code", "field")}


def keyword_match(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """pairs (user_id, doc_id, global_event_id, url, article_title, article_keywords) with the first keyword that matches: URLs first, then
    titles, then extracted keywords; keywords and variants in alphabetical order."""
    words = user_keywords(profiles).groupBy("user_id").agg(F.array_sort(F.collect_set("keyword")).alias("kw"))
    df = pairs.join(words, "user_id", "left")
    tokens, title = row_tokens(F.col("article_title"), F.col("article_keywords")), row_tokens(F.col("article_title"), F.lit(""))
    df = df.withColumns({"_tokens": tokens, "_title": title, "_url": F.lower("url")})
    none = F.lit(None).cast("struct<k:string,t:string,f:string>")
    by_url = F.flatten(F.transform("kw", lambda k: F.transform(F.filter(url_variants(k), lambda v: F.contains(F.col("_url"), v)), lambda v: F.struct(k.alias("k"), v.alias("t"), F.lit("url").alias("f")))))

    def by_words(k):
        stems = F.transform(keyword_tokens(k), stem)
        field = F.when(F.forall(stems, lambda s: F.array_contains("_title", s)), "article_title").otherwise("article_keywords")
        return F.when((F.size(stems) > 0) & F.forall(stems, lambda s: F.array_contains("_tokens", s)), F.struct(k.alias("k"), F.array_join(stems, " + ").alias("t"), field.alias("f")))

    in_text = F.filter(F.transform("kw", by_words), lambda r: r.isNotNull())
    hit = F.coalesce(F.try_element_at(by_url, F.lit(1)), F.try_element_at(in_text, F.lit(1)), none)
    unset = F.col("kw").isNull()
    pick = lambda field, without, stale: F.when(unset, without).otherwise(F.coalesce(F.col("_hit")[field], F.lit(stale)))
    out = df.withColumn("_hit", hit)
    return out.select(*pairs.columns, pick("k", NO_KEYWORDS, NO_MATCH).alias("keyword_matched"), pick("t", "", "").alias("keyword_tokens"), pick("f", UNFILTERED, STALE).alias("keyword_match_field"))


# What the provenance columns say where a row is missing.
GONE, PRESENT, NO_PROFILE = "(silver row gone)", "present", "(profile gone)"
NO_KEYWORDS, NO_MATCH, UNFILTERED, STALE = "(no keywords set)", "(no current keyword matches)", "(unfiltered)", "(stale gold row)"


def trace(links: DataFrame, articles: DataFrame, events: DataFrame, mentions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Links with their silver rows and their users' profiles; `silver` and `display_name` tell where one is gone."""
    e = events.groupBy(F.col("GLOBALEVENTID").cast("string").alias("global_event_id")).agg(F.max("EventCode").alias("EventCode"))
    m = mentions.select(F.col("GLOBALEVENTID").cast("string").alias("global_event_id"), F.col("MentionIdentifier").alias("url"), "article_title", "article_keywords", F.lit(1).alias("_m"))
    out = links.join(articles.select("doc_id", "global_event_id", "url"), ["doc_id", "global_event_id"]).join(e, "global_event_id", "left").join(m, ["global_event_id", "url"], "left")
    out = out.join(profiles.select("user_id", "display_name", "territories", "keywords"), "user_id", "left").withColumn("display_name", F.coalesce("display_name", F.lit(NO_PROFILE)))
    return out.withColumn("silver", F.when(F.col("EventCode").isNull() | F.col("_m").isNull(), GONE).otherwise(PRESENT)).drop("_m")


def distribution(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
