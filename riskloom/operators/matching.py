"""Articles to users: territories AND keywords; a user without one of them is not held back by it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..functions.text import has_all, keyword_tokens, keyword_tokens_literal, stem, stem_literal, url_variants, url_variants_literal

ACTOR_CODES = ("Actor1CountryCode", "Actor2CountryCode")
GRAM = 3
#: Users up to which one expression holds a branch for each.
FEW_USERS = 100
PLACE_CODES = ("country_code", "Actor1Geo_CountryCode", "Actor2Geo_CountryCode")


def user_codes(profiles: DataFrame, territories: DataFrame) -> DataFrame:
    """(user_id, cameo, fips): code sets of each user's known territories; empty for a user without any."""
    named = profiles.select("user_id", F.explode_outer("territories").alias("name")).join(territories, "name", "left")
    gather = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(c, F.array().cast("array<string>"))))))
    return named.groupBy("user_id").agg(gather("cameo").alias("cameo"), gather("fips").alias("fips"))


def user_keywords(profiles: DataFrame) -> DataFrame:
    """(user_id, keyword): distinct keywords of all questions."""
    return profiles.select("user_id", F.explode(F.array_distinct(F.flatten(F.map_values("keywords")))).alias("keyword")).filter(F.trim("keyword") != "")


def _any(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests, F.lit(False))


def geo_predicate(cameo: list[str], fips: list[str]) -> Column:
    if not cameo and not fips:
        return F.lit(True)
    tests = [F.coalesce(F.col(c).isin(codes), F.lit(False)) for names, codes in ((ACTOR_CODES, cameo), (PLACE_CODES, fips)) if codes for c in names]
    return _any(tests)


def keyword_predicate(keywords: list[str]) -> Column:
    if not keywords:
        return F.lit(True)
    url = F.lower("url")
    variants = sorted(set().union(*map(url_variants_literal, keywords)))
    groups = {tuple(sorted({stem_literal(t) for t in tokens})) for k in keywords if (tokens := keyword_tokens_literal(k))}
    tests = [url.contains(v) for v in variants] + [has_all(F.col("row_tokens"), F.array(*map(F.lit, g))) for g in sorted(groups)]
    return F.coalesce(_any(tests), F.lit(False))


def matched_users(catalogue: DataFrame, profiles: DataFrame, territories: DataFrame) -> DataFrame:
    """The catalogue's matched rows with `users`, the sorted ids of the users they match: one pass for all users.

    Each user is a branch of one expression, so more than FEW_USERS profiles are refused: match_relational takes any number.
    """
    if profiles.select("user_id").distinct().limit(FEW_USERS + 1).count() > FEW_USERS:
        raise ValueError(f"more than {FEW_USERS} users are matched by match_relational")
    codes = {r.user_id: r for r in user_codes(profiles, territories).collect()}
    words: dict[str, list[str]] = {}
    for r in user_keywords(profiles).collect():
        words.setdefault(r.user_id, []).append(r.keyword)
    tests = [F.when(geo_predicate(list(r.cameo), list(r.fips)) & keyword_predicate(sorted(words.get(user, []))), user) for user, r in sorted(codes.items())]
    users = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
    return catalogue.withColumn("users", users).filter(F.size("users") > 0)


def match_by_filter(catalogue: DataFrame, profiles: DataFrame, territories: DataFrame) -> DataFrame:
    """(user_id, doc_id, global_event_id), by one filter expression per user."""
    return matched_users(catalogue, profiles, territories).select(F.explode("users").alias("user_id"), "doc_id", "global_event_id")


def _url_hits(catalogue: DataFrame, words: DataFrame) -> DataFrame:
    """(user_id, url): URLs that hold a spelling of a user's keyword, by an equi-join on one run of letters and a substring test.

    A spelling of GRAM letters or more is looked for by whichever of its runs the fewest URLs have, so that runs like "com"
    make no pairs unless the whole spelling is that short; a spelling without any run that URLs have is in none of them.
    """
    variants = words.select("user_id", F.explode(url_variants(F.col("keyword"))).alias("variant")).distinct().filter("variant <> ''")

    def runs(text: str, n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))

    urls = catalogue.select("url").distinct().withColumn("low", F.lower("url")).filter(F.length("low") >= GRAM)
    grams = urls.select("url", "low", F.explode(F.array_distinct(F.concat(*(runs("low", n) for n in range(1, GRAM + 1))))).alias("gram"))
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    spelled = variants.select("variant").distinct()
    parts = spelled.select("variant", F.explode(F.when(F.length("variant") <= GRAM, F.array("variant")).otherwise(F.array_distinct(runs("variant", GRAM)))).alias("gram"))
    rarest = parts.join(often, "gram").groupBy("variant").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    hits = grams.join(rarest, "gram").filter(F.contains("low", F.col("variant"))).select("variant", "url")
    return hits.join(variants, "variant").select("user_id", "url").distinct()


def match_relational(catalogue: DataFrame, profiles: DataFrame, territories: DataFrame) -> DataFrame:
    """The same as equi-joins on codes and tokens: the plan does not grow with users and keywords.

    Keywords are looked for in distinct URLs only (of GRAM letters or more, as all URLs are); users without territories (or
    keywords) take part through the other half.  The catalogue is read several times: pass a stored one.  Users without any
    constraint match all rows, so that their part of the result is a product by definition.
    """
    pair = ["doc_id", "global_event_id"]
    codes = user_codes(profiles, territories)
    code_rows = codes.select("user_id", F.explode(F.concat(F.transform("cameo", lambda c: F.concat(F.lit("C:"), c)), F.transform("fips", lambda c: F.concat(F.lit("F:"), c)))).alias("code"))
    free_geo = codes.filter((F.size("cameo") == 0) & (F.size("fips") == 0)).select("user_id")
    tagged = [F.concat(F.lit("C:"), F.col(c)) for c in ACTOR_CODES] + [F.concat(F.lit("F:"), F.col(c)) for c in PLACE_CODES]
    places = catalogue.select(*pair, F.explode(F.array_distinct(F.array_compact(F.array(*tagged)))).alias("code"))
    folder = storage.working_folder(catalogue.sparkSession)
    # each half is read twice below: written once, so that its plan runs once
    geo = storage.stored(places.join(code_rows, "code").select("user_id", *pair).distinct(), f"{folder}/geo")

    words = user_keywords(profiles)
    users = profiles.select("user_id").distinct()
    free_text = users.join(words.select("user_id").distinct(), "user_id", "left_anti")
    stems = words.select("user_id", "keyword", F.array_distinct(F.transform(keyword_tokens(F.col("keyword")), stem)).alias("stems")).filter(F.size("stems") > 0)
    need = stems.select("user_id", "keyword", F.size("stems").alias("n"), F.explode("stems").alias("token"))
    have = catalogue.select(*pair, F.explode("row_tokens").alias("token"))
    text = have.join(need, "token").groupBy("user_id", "keyword", "n", *pair).agg(F.count(F.lit(1)).alias("found")).filter("found = n").select("user_id", *pair)
    url_hits = storage.stored(_url_hits(catalogue, words), f"{folder}/urls")
    by_url = catalogue.select("url", *pair).join(url_hits, "url").select("user_id", *pair)
    by_word = storage.stored(text.unionByName(by_url).distinct(), f"{folder}/words")

    every = catalogue.select(*pair)
    both = geo.join(by_word, ["user_id", *pair])
    geo_only = geo.join(free_text, "user_id")
    word_only = by_word.join(free_geo, "user_id")
    # users without any constraint match everything: this product is the result itself
    neither = every.crossJoin(free_geo.join(free_text, "user_id"))
    return both.unionByName(geo_only).unionByName(word_only).unionByName(neither.select("user_id", *pair)).distinct()


def matches_geography(codes: Column, wanted: Column | None) -> Column:
    """Older filter: an event's code set meets the wanted one; no wanted set lets all pass."""
    return F.lit(True) if wanted is None else F.coalesce(F.arrays_overlap(codes, wanted), F.lit(False))
