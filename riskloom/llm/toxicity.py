"""Toxicity: cumulative-link ordinal regression on sparse word features.

Features: which of 2**FEATURE_BITS hashed words (small letters, without the marks around them) and word beginnings of
PREFIX_BYTES bytes a document has.
Grades: 0 not toxic, 1 toxic, 2 severely toxic.  The labels say only toxic or not.  The second step is therefore derived, not
observed: a toxic document is severe if the number of its different words that speak for toxicity in the labelled sample is
above the sample's median of toxic documents.  Held-out labels can confirm p_toxic; p_severe only repeats this rule.
Model: P(grade <= j) = sigmoid(threshold_j - w . x), one weight vector for all ordered thresholds, fitted by proximal
gradient with an L1 term and weights of 0 or more on a bounded sample of labelled documents (SAMPLE_ROWS, taken by hash of the id, half of it from each
label at most).  Scoring covers every document: expected severity is the sum of P(grade > j).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K
from .tokens import cores, folded

FEATURE_BITS = 20
PREFIX_BYTES = 6
#: Labelled documents that the model is fitted on, at most.
SAMPLE_ROWS = 6000
GRADES = 3
ROUNDS = 400
#: L1 weight of a feature, in standard deviations of its gradient when it says nothing about the grade.
L1_SIGMAS = 0.5
#: Sample rows that a feature must be found in.
LEAST_ROWS = 3
#: Standard deviations by which a feature must be more frequent in toxic rows to enter the fit.
SCREEN_SIGMAS = 3.5
TOXIC_FROM = 0.5


def _features(data, offsets):
    """(document, feature) of every different word of each document, and words per document."""
    s, e, _, _, first, h = cores(data, offsets)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    longer = np.flatnonzero(e - s > PREFIX_BYTES)
    (begin,) = K.span_hashes(folded(data), s[longer], s[longer] + PREFIX_BYTES, (52,))
    doc, h = np.concatenate([doc, doc[longer]]), np.concatenate([h, begin])
    key = np.unique((doc.astype(np.int64) << FEATURE_BITS) | (h >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
    return key >> FEATURE_BITS, key & ((1 << FEATURE_BITS) - 1), np.diff(first)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(y, features, words) of the labelled sample, written; features: sorted numbers of 32 bits."""
    own = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")).filter("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    picked = own.filter("y = 1").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS // 2).unionByName(own.filter("y = 0").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS // 2))

    def take(batches):
        for batch in batches:
            for lo, hi, data, offsets in K.blocks(batch.column(1)):
                doc, feature, words = _features(data, offsets)
                parts = np.split(feature.astype(np.int32), np.searchsorted(doc, np.arange(1, hi - lo)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), K.binaries(parts), pa.array(words)], ["y", "features", "words"])

    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # the sample is bounded: broadcasting it leaves the texts where they are
    return K.stored(F.broadcast(picked).join(texts, "id").select("y", "text").mapInArrow(take, "y int, features binary, words long"), "sample")


def _counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by label; rows with each feature, by label; and the labels of all rows in the order of ordered()."""
    hits, labels = np.zeros((2, 1 << FEATURE_BITS), np.int64), []
    for r in ordered(sample):
        hits[r.y, np.frombuffer(r.features, np.int32)] += 1
        labels.append(r.y)
    labels = np.array(labels, np.int64)
    return np.bincount(labels, minlength=2), hits, labels


def ordered(sample: DataFrame):
    """The rows one after another, in an order that does not depend on the cluster; at most SAMPLE_ROWS."""
    return sample.orderBy("y", F.xxhash64("features"), "features").toLocalIterator()


def _telling(n: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Whether each feature speaks for toxicity strongly: the severity rule counts these."""
    speaks = np.log((hits[1] + 0.5) / (max(1, n[1]) + 1)) - np.log((hits[0] + 0.5) / (max(1, n[0]) + 1))
    return (speaks > 2) & (hits[1] >= 5)


def _grades(toxic: np.ndarray, strong: np.ndarray) -> np.ndarray:
    """0, 1 or 2 for each sample row, from its label and its number of strongly telling words."""
    middle = np.median(strong[toxic == 1]) if (toxic == 1).any() else 0.0
    return np.where(toxic == 1, 1 + (strong > middle), 0)


def _screened(n: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Features that enter the fit: found in LEAST_ROWS rows, and more frequent in toxic ones by SCREEN_SIGMAS."""
    if not n.all():
        return np.zeros(hits.shape[1], bool)
    every = hits.sum(0)
    share = every / n.sum()
    apart = hits[1] / n[1] - hits[0] / n[0]
    return (every >= LEAST_ROWS) & (apart > SCREEN_SIGMAS * np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1])))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(start: np.ndarray, feature: np.ndarray, grade: np.ndarray, size: int, grades: int = GRADES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the cumulative-link model, by accelerated proximal gradient."""
    n = len(grade)
    share = np.clip(np.cumsum(np.bincount(grade, minlength=grades)[:-1] + 0.5) / (n + 0.5 * grades), 1e-3, 1 - 1e-3)
    cuts = np.log(share / (1 - share))
    w = np.zeros(size)
    if not 0 < (grade > 0).sum() < n:
        return w, cuts
    row = np.repeat(np.arange(n), np.diff(start))
    # each grade counts alike, so that rare grades move the weights too
    per = np.maximum(np.bincount(grade, minlength=grades), 1)
    mass = 1 / per[grade] / len(np.unique(grade))
    l1 = L1_SIGMAS * np.sqrt(np.bincount(feature, weights=(mass * mass)[row], minlength=size)) / 2
    # steps by feature: a diagonal bound on the curvature
    bound = np.bincount(feature, weights=(mass * np.bincount(row, minlength=n))[row], minlength=size) / 2
    step = 1 / np.maximum(bound, 1e-6)
    z, t, before = w, 1.0, w
    for _ in range(rounds):
        score = np.bincount(row, weights=z[feature], minlength=n)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        upper, lower = _sigmoid(edges[grade + 1] - score), _sigmoid(edges[grade] - score)
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        back = (du - dl) * mass  # derivative of -log p by the score
        gradient = np.bincount(feature, weights=back[row], minlength=size)
        w = z - step * gradient
        w = np.maximum(w - step * l1, 0)  # words speak for toxicity or say nothing
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, before, t = w + (t - 1) / after * (w - before), w, after
        slope = np.array([-(mass * du)[grade == j].sum() + (mass * dl)[grade == j + 1].sum() for j in range(grades - 1)])
        cuts = np.maximum.accumulate(cuts - 2.0 * slope + 1e-9 * np.arange(grades - 1))
    return w, cuts


def calibrate(start, feature, grade, weights: np.ndarray, cuts: np.ndarray, mass: np.ndarray, rounds: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """The weights times a scale, and thresholds, that fit rows counted by `mass` best (L1 shrinks, and the fit counts grades alike)."""
    n = len(grade)
    score = np.bincount(np.repeat(np.arange(n), np.diff(start)), weights=weights[feature], minlength=n)
    if not score.any():
        return weights, cuts
    grades = len(cuts) + 1
    x = np.concatenate([[1.0], cuts])
    m, v = np.zeros(grades), np.zeros(grades)
    for t in range(1, rounds + 1):  # Adam on a few numbers
        edges = np.concatenate([[-np.inf], np.maximum.accumulate(x[1:]), [np.inf]])
        upper, lower = _sigmoid(edges[grade + 1] - x[0] * score), _sigmoid(edges[grade] - x[0] * score)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = mass * upper * (1 - upper) / p, mass * lower * (1 - lower) / p
        g = np.array([((du - dl) * score).sum(), *(-du[grade == j].sum() + dl[grade == j + 1].sum() for j in range(grades - 1))])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x -= 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return weights * x[0], np.maximum.accumulate(x[1:])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds.  Every word of every sampled document counts; the driver keeps the features that pass the screen."""
    sample = _sample(docs, labels, id_col, text_col, label_col)
    n, hits, toxic = _counts(sample)
    telling, keep = _telling(n, hits), _screened(n, hits)
    strong, parts = np.zeros(len(toxic)), []
    for i, r in enumerate(ordered(sample)):
        feature = np.frombuffer(r.features, np.int32)
        strong[i] = telling[feature].sum()
        parts.append(feature[keep[feature]])
    start = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    feature = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    grade = _grades(toxic, strong)
    weights, cuts = fit_ordinal(start, feature, grade, 1 << FEATURE_BITS)
    share = labels.filter(F.col(f"`{label_col}`").isin(0, 1)).agg(F.avg(F.col(f"`{label_col}`"))).first()[0] or 0.0
    n = np.maximum(n, 1)
    return calibrate(start, feature, grade, weights, cuts, np.where(toxic == 1, share / n[1], (1 - share) / n[0]))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, p_toxic, p_severe, expected_severity, grade, is_toxic) of every row.

    grade is the most probable one (the lower one at a tie); is_toxic: expected_severity >= TOXIC_FROM.  A null or empty text
    has no features and severity 0.  Equal texts get equal scores; rows with null or repeated ids each have a row, and a label
    without an id is not used; an id with several labels counts as toxic if one of them says so; without documents or labels
    of both kinds all weights are 0; an empty table gives an empty table.  The model has
    2**FEATURE_BITS weights whatever the input, and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(c, T.DoubleType()) for c in ("p_toxic", "p_severe", "expected_severity")), T.StructField("grade", T.IntegerType()), T.StructField("is_toxic", T.BooleanType())])

    def run(batches):
        weights, cuts = shared.value
        for batch in batches:
            for lo, hi, data, offsets in K.blocks(batch.column(1)):
                doc, feature, words = _features(data, offsets)
                x = np.bincount(doc, weights=weights[feature], minlength=hi - lo)
                above = _sigmoid(x[:, None] - cuts[None, :])
                above[words == 0] = 0
                p = np.concatenate([np.ones((hi - lo, 1)), above], 1) - np.concatenate([above, np.zeros((hi - lo, 1))], 1)
                expected = above.sum(1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(above[:, 0]), pa.array(above[:, 1]), pa.array(expected), pa.array(p.argmax(1).astype(np.int32)), pa.array(expected >= TOXIC_FROM)], schema.fieldNames())

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, schema)


def query(spark, sf_dir):
    """Every document scored by a model of the labelled sample; odd texts as in score()."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score(docs, fit(docs, labels))
