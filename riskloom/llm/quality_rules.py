"""Quality rules as weak supervision, in DataFrame operations only.

Every rule votes good (1), bad (-1) or abstains (0) on a document.  Expectation-maximisation over the counts of vote
patterns (at most 3**9 rows, whatever the number of documents, fetched once) estimates the share of good documents and each
rule's accuracy on good and on bad ones; the posterior probability of "good" then replaces an all-rules-must-pass filter.
Signals are computed inside each row with built-in and higher-order functions: nothing is exploded or shuffled but the
pattern counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernel as K

WS = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
WINDOW = 8
#: Frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "a an and are as at be by for from he in is it of on or that the this to was were with "
    "de des du elle en est et il la le les ou par pas pour que qui un une "
    "auch auf das dem den der die ein eine ist mit nicht sich und von zu "
    "con del el los las más no para por se su una y o lo al"
).split()
RULES = ("length", "word_length", "symbols", "dup_lines", "repeats", "capitals", "sentences", "function_words", "marks")
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
KEEP_FROM = 0.5
ROUNDS, SETTLED = 60, 1e-7
#: Starting values of the share of good documents and of a rule's accuracy on good and on bad documents, and the weight, in
#: documents, with which they stay in the estimates.  A bad document mostly has one defect, so most rules call it good.
PRIOR_GOOD, PRIOR_ACCURACY, PRIOR_WEIGHT = 0.85, (0.97, 0.4), 20.0


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _windows(words: Column) -> Column:
    """A hash for each 8-word window: of two windows of 4 words, of 2, of 1, so that no window is copied."""

    def pairs(half: int):
        return lambda a: F.transform(a, lambda x, i: F.xxhash64(x, F.get(a, i + half)))

    whole = _let(_let(_let(F.transform(words, lambda w: F.xxhash64(w)), pairs(1)), pairs(2)), pairs(4))
    return F.slice(whole, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))  # the last ones lack a half


def _covered(hashes: Column) -> Column:
    """Words in the windows whose hash is found twice or more."""
    ordered = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def positions(s):
        same = lambda e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
        marked = F.transform(s, lambda e, k: F.when(same(e, k - 1) | same(e, k + 1), e["i"]))
        return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("end"))
    return _let(ordered, lambda s: F.aggregate(
        positions(s), start,
        lambda a, p: F.struct((a["total"] + p + WINDOW - F.greatest(p, a["end"])).cast("long").alias("total"), (p + WINDOW).alias("end")),
        lambda a: a["total"],
    ))


def signals(docs: DataFrame, carry: list[str], text_col: str = "text") -> DataFrame:
    """carried (a struct of the `carry` columns; none without any), SIGNALS, base_failed, and a vote per rule (columns vote_<rule>)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    trimmed = F.btrim(text, F.lit(WS))
    carried = [F.struct(*(F.col(f"`{c}`") for c in carry)).alias("carried")] if carry else []
    df = docs.select(*carried, text.alias("_text"), F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK)).alias("_words"))
    carried = ["carried"] if carry else []
    df = df.select(
        *carried,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(WS)) != "").alias("_lines"),
        _windows(F.col("_words")).alias("_windows"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).alias("_upper"),
        F.regexp_count("_text", F.lit("[.!?]")).alias("_stops"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(FUNCTION_WORDS))).alias("_function"),
        F.size(F.filter("_words", lambda w, i: w == F.get("_words", i - 1))).alias("_again"),
        F.regexp_count("_text", F.lit(r"[^\p{L}\s]")).alias("_marks"),
    )
    df = df.withColumn("_full", F.size("_lines")).withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    df = df.withColumn("n_repeat_words", F.when(F.size(F.array_distinct("_windows")) == F.size("_windows"), F.lit(0).cast("long")).otherwise(_covered(F.col("_windows"))))
    n = F.greatest(F.col("n_words"), F.lit(1))
    ratio = lambda x: F.col(x) / n
    vote = lambda good, bad: F.when(bad, -1).when(good, 1).otherwise(0).cast("int")
    size = F.col("word_chars") / n
    lines = F.col("n_dup_lines") / F.greatest(F.col("_full"), F.lit(1))
    votes = {
        "length": vote(F.col("n_words") >= 50, F.col("n_words") < 20),
        "word_length": vote(size.between(3.0, 9.0), (size < 2.5) | (size > 12.0)),
        "symbols": vote(ratio("n_symbols") <= 0.02, ratio("n_symbols") > 0.1),
        "dup_lines": vote(lines <= 0.1, lines > 0.3),
        "repeats": vote((ratio("n_repeat_words") <= 0.05) & (ratio("_again") <= 0.03), (ratio("n_repeat_words") > 0.3) | (ratio("_again") > 0.1)),
        "capitals": vote(F.col("_upper") <= 0.2 * F.col("word_chars"), F.col("_upper") > 0.4 * F.col("word_chars")),
        "sentences": vote(ratio("_stops").between(0.02, 0.4), (ratio("_stops") < 0.005) | (ratio("_stops") > 0.8)),
        "function_words": vote(ratio("_function") >= 0.05, ratio("_function") < 0.01),
        "marks": vote(ratio("_marks") <= 0.4, ratio("_marks") > 0.8),
    }
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return df.select(*carried, *SIGNALS, failed.alias("base_failed"), *(votes[r].alias(f"vote_{r}") for r in RULES))


def _likelihoods(model: dict) -> tuple[Column, Column]:
    good, bad = F.lit(model["good"]), F.lit(1 - model["good"])
    for r in RULES:
        v, (a, b) = F.col(f"vote_{r}"), model["accuracy"][r]
        good = good * F.when(v == 1, a).when(v == -1, 1 - a).otherwise(1.0)
        bad = bad * F.when(v == -1, b).when(v == 1, 1 - b).otherwise(1.0)
    return good, bad


def posterior(model: dict) -> Column:
    """Probability that the document is good, from its votes."""
    good, bad = _likelihoods(model)
    return good / (good + bad)


def fit(votes: DataFrame) -> dict:
    """Share of good documents, and each rule's accuracy on good and on bad ones, by expectation-maximisation."""
    names = [f"vote_{r}" for r in RULES]
    # one row for each pattern of votes: bounded by the rules
    patterns = sorted((tuple(r[v] for v in names), r["n"]) for r in votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect())
    model = {"good": PRIOR_GOOD, "accuracy": {r: PRIOR_ACCURACY for r in RULES}}
    every, w = sum(n for _, n in patterns), PRIOR_WEIGHT
    for _ in range(ROUNDS if patterns else 0):
        good_total = 0.0
        # documents by vote and rule: those that are good, and those that are bad, in the share that the model gives them
        good_by, bad_by = ({v: [0.0] * len(RULES) for v in (-1, 0, 1)} for _ in range(2))
        factors = [({1: a, -1: 1 - a, 0: 1.0}, {1: 1 - b, -1: b, 0: 1.0}) for a, b in (model["accuracy"][r] for r in RULES)]
        for pattern, n in patterns:
            good, bad = model["good"], 1 - model["good"]
            for v, (if_good, if_bad) in zip(pattern, factors, strict=True):
                good *= if_good[v]
                bad *= if_bad[v]
            share = n * good / (good + bad)
            good_total += share
            for i, v in enumerate(pattern):
                good_by[v][i] += share
                bad_by[v][i] += n - share
        after = {"good": (good_total + w * PRIOR_GOOD) / (every + w), "accuracy": {}}
        for i, r in enumerate(RULES):
            a = (good_by[1][i] + w * PRIOR_ACCURACY[0]) / (good_by[1][i] + good_by[-1][i] + w)
            b = (bad_by[-1][i] + w * PRIOR_ACCURACY[1]) / (bad_by[-1][i] + bad_by[1][i] + w)
            after["accuracy"][r] = (a, b)
        change = max(abs(after["good"] - model["good"]), *(abs(x - y) for r in RULES for x, y in zip(after["accuracy"][r], model["accuracy"][r], strict=True)))
        model = after
        if change < SETTLED:
            break
    return model


def rate(docs: DataFrame, carry: list[str], text_col: str = "text") -> DataFrame:
    """`carry` columns, SIGNALS, base_failed, kept, quality (posterior probability) and the votes.

    base_failed: fewer than 20 words, or over 30 % of the words in 8-word windows that the text repeats.  kept: not
    base_failed, and quality at least KEEP_FROM.  A null or empty text has no words and is not kept; ties at KEEP_FROM are
    kept; equal texts get equal results; rows with null or repeated ids are judged like others; an empty table gives an empty
    table.  Names in `carry` that clash with columns made here are left out; any other name is carried as it is.  The signals
    (with `carry`) are written once to the shared folder and read twice.
    """
    made = {*SIGNALS, "base_failed", "kept", "quality", *(f"vote_{r}" for r in RULES)}
    carry = [c for c in carry if c.lower() not in made]
    found = K.stored(signals(docs, carry, text_col), "signals")
    quality = posterior(fit(found))
    rated = found.withColumn("quality", quality).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM))
    return rated.select(*(["carried.*"] if carry else []), *SIGNALS, "base_failed", "kept", "quality", *(f"vote_{r}" for r in RULES))


def query(spark, sf_dir):
    """Every document rated; odd texts as in rate()."""
    return rate(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
