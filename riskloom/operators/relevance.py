"""Bronze to silver: which events matter for supply chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe_string

# Event codes, root codes, actor types, groups and words of the relevance rules.
EVENT_CODES = [
    "1721", "1722", "1723", "1724", "163", "1631", "1632", "1633", "141", "1411", "1412", "1413", "143", "145", "191", "1911",
    "1912", "180", "182", "1821", "1822", "1823", "171", "172", "173", "175", "1751", "1752", "193", "194", "195", "196",
]
ROOT_CODES = ["14", "15", "17", "18", "19", "20"]
ACTOR_TYPES = ["BUS", "GOV", "LAB", "MNC", "IGO"]
ACTOR_GROUPS = ["OPEC", "WTO", "IMF", "WORLDBANK", "EU", "ASEAN", "NATO", "UN"]
KEYWORDS = (
    "port", "harbor", "harbour", "shipping", "freight", "cargo", "cargoescustoms", "tariff", "logistics", "supply chain", "supply-chain",
    "supply-side", "warehouse", "storage", "refinery", "refineriesfactory", "factories", "plant", "semiconductor", "microchip", "oil", "gas",
    "pipeline", "railway", "railroad", "airport", "tanker", "container", "avalanche", "blizzard", "wildfire", "bushfire", "cold wave", "derecho",
    "drought", "earthquake", "flash flood", "haboob", "heat wave", "hurricane", "lahar", "landslide", "limnic eruption", "polar vortex event",
    "riverine flood", "sinkhole", "storm surge", "tornado", "tornadoes", "tropical cyclone", "tsunami", "typhoon", "volcanic eruption",
    "waterspout", "inflation", "deflation", "terrorist attack",
)
TYPE_COLUMNS = [f"Actor{a}Type{t}Code" for a in (1, 2) for t in (1, 2, 3)]
GROUP_COLUMNS = [f"Actor{a}KnownGroupCode" for a in (1, 2)]


def _column(df: DataFrame, name: str) -> Column:
    return safe_string(F.col(name)) if name in df.columns else F.lit("")


def has_event_code(df: DataFrame) -> Column:
    return _column(df, "EventCode").isin(EVENT_CODES) | _column(df, "EventRootCode").isin(ROOT_CODES)


def has_actor(df: DataFrame) -> Column:
    tests = [F.upper(_column(df, c)).isin(ACTOR_TYPES) for c in TYPE_COLUMNS if c in df.columns]
    tests += [F.upper(_column(df, c)).isin(ACTOR_GROUPS) for c in GROUP_COLUMNS if c in df.columns]
    return reduce(Column.__or__, tests, F.lit(False))


def combined_text(df: DataFrame) -> Column:
    return F.lower(F.concat_ws(" ", *(_column(df, c) for c in ("Actor1Name", "Actor2Name", "SOURCEURL"))))


def has_keyword(df: DataFrame, words=KEYWORDS) -> Column:
    """Any word anywhere in the names and the URL, inside other words too: one scan for all words."""
    import re

    return combined_text(df).rlike("|".join(map(re.escape, words)))


def has_url(df: DataFrame) -> Column:
    return _column(df, "SOURCEURL") != ""


def is_relevant(df: DataFrame, words=KEYWORDS) -> Column:
    return has_event_code(df) & (has_actor(df) | has_keyword(df, words)) & has_url(df)


def with_flags(df: DataFrame) -> DataFrame:
    """f1..f4 kept beside each event, so that provenance needs no second look at bronze."""
    return df.withColumns({"f1": has_event_code(df), "f2": has_actor(df), "f3": has_keyword(df), "f4": has_url(df)})


def explain(df: DataFrame) -> DataFrame:
    """What made each event relevant: the code, the first actor field, all words, and which branch."""
    code, root, text = _column(df, "EventCode"), _column(df, "EventRootCode"), combined_text(df)
    f1 = F.when(code.isin(EVENT_CODES), F.concat(F.lit("EventCode="), code)).when(root.isin(ROOT_CODES), F.concat(F.lit("EventRootCode="), root)).otherwise("")
    fields = [(c, ACTOR_TYPES) for c in TYPE_COLUMNS] + [(c, ACTOR_GROUPS) for c in GROUP_COLUMNS]
    f2 = F.coalesce(*(F.when(F.upper(_column(df, c)).isin(values), F.concat(F.lit(f"{c}="), _column(df, c))) for c, values in fields if c in df.columns), F.lit(""))
    f3 = F.array_join(F.filter(F.array(*(F.lit(w) for w in sorted(KEYWORDS))), lambda w: F.contains(text, w)), "|")
    out = df.withColumns({"f1": f1, "f2": f2, "f3": f3})
    return out.withColumn("branch", F.concat_ws("+", F.when(F.col("f2") != "", "F2"), F.when(F.col("f3") != "", "F3")))
