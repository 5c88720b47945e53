"""Text functions: cleaning, headlines, keyword compilation and row tokens.  Columns unless a name says `_literal`."""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
# Fixed value: characters that keywords may hold and URLs spell as a hyphen or drop.
MATH_MARKS = "+*/=<>%^~±×÷≤≥≠√∑∏∞¬∧∨→↔"
SHORT_TOKEN = 3
NO_TITLE = "(No article title) "


def safe_string(c: Column) -> Column:
    """Trimmed text; null and the text "nan" become empty."""
    trimmed = F.btrim(F.coalesce(c, F.lit("")), F.lit(WHITE))
    return F.when(F.lower(trimmed) == "nan", "").otherwise(trimmed)


def headline(title: Column, url: Column) -> Column:
    shown = F.trim(F.coalesce(title, F.lit("")))
    return F.when(shown != "", shown).otherwise(F.concat(F.lit(NO_TITLE), url))


def title_key(c: Column) -> Column:
    """Small letters and single spaces: titles with equal keys are the same story."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")))


def label_display(c: Column) -> Column:
    return F.regexp_replace(c, ", not specified below$", "")


def stem(c: Column) -> Column:
    """Without one final s, if the word has more than three letters."""
    return F.when((F.length(c) > SHORT_TOKEN) & c.endswith("s"), F.substring(c, 1, F.length(c) - 1)).otherwise(c)


def split_tokens(c: Column) -> Column:
    return F.split(F.lower(c), "[^a-z0-9]+")


def row_tokens(title: Column, keywords: Column) -> Column:
    """Distinct stemmed tokens of a title and its keywords; may hold one empty token."""
    return F.array_distinct(F.transform(split_tokens(F.concat_ws(" ", title, keywords)), stem))


def keyword_tokens(c: Column) -> Column:
    """A keyword's tokens in order; short ones leave a keyword of several tokens unless none would stay."""
    tokens = F.array_distinct(F.filter(split_tokens(F.coalesce(c, F.lit(""))), lambda t: t != ""))
    every = F.filter(split_tokens(F.coalesce(c, F.lit(""))), lambda t: t != "")
    longer = F.filter(tokens, lambda t: F.length(t) >= SHORT_TOKEN)
    return F.when((F.size(every) > 1) & (F.size(longer) > 0), longer).otherwise(tokens)


def keyword_tokens_literal(keyword: str | None) -> list[str]:
    every = [t for t in re.split("[^a-z0-9]+", (keyword or "").lower()) if t]
    longer = [t for t in every if len(t) >= SHORT_TOKEN]
    return list(dict.fromkeys(longer if len(every) > 1 and longer else every))


def stem_literal(token: str) -> str:
    return token[:-1] if len(token) > SHORT_TOKEN and token[-1] == "s" else token


def url_variants_literal(keyword: str | None) -> set[str]:
    """How a keyword may be spelt in a URL: marks as hyphen or nothing, & as nothing or "and", spaces as hyphens."""
    text = re.sub(rf"\s*([{re.escape(MATH_MARKS)}])\s*", r"\1", (keyword or "").lower().strip())
    ands = ("", " and ") if "&" in text else ("",)
    out = set()
    for amp, mark in itertools.product(ands, ("-", "")):
        spelt = text.replace("&", amp).translate({ord(m): mark for m in MATH_MARKS})
        out.add(re.sub("[^a-z0-9-]", "", re.sub(" +", " ", spelt).strip(" ").replace(" ", "-")))
    return out - {""}


def url_variants(c: Column) -> Column:
    """The same as a sorted array column."""
    marks = "[" + re.escape(MATH_MARKS) + "]"
    text = F.regexp_replace(F.lower(F.btrim(F.coalesce(c, F.lit("")), F.lit(WHITE))), rf"\s*({marks})\s*", "$1")
    spelt = []
    for amp, mark in itertools.product(("", " and "), ("-", "")):
        plain = F.regexp_replace(F.replace(text, F.lit("&"), F.lit(amp)), marks, mark)
        spelt.append(F.regexp_replace(F.replace(F.trim(F.regexp_replace(plain, " +", " ")), F.lit(" "), F.lit("-")), "[^a-z0-9-]", ""))
    return F.array_sort(F.array_distinct(F.filter(F.array(*spelt), lambda v: v != "")))


def light_normalise(c: Column) -> Column:
    return F.regexp_replace(F.btrim(F.coalesce(c, F.lit("")), F.lit(WHITE)), " +", " ")


def has_all(tokens: Column, stems: Column) -> Column:
    return F.forall(stems, lambda s: F.array_contains(tokens, s))
