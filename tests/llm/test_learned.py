"""Operators that learn: held-out accuracy, gradients, and defined results for odd input."""

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import lm_score, quality_rules, toxicity

SF = "/root/testdata/sf0.1"


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter("doc_id % 5 <> 0"))
    rows = toxicity.score(docs.join(labels.filter("doc_id % 5 = 0").select("doc_id"), "doc_id"), model).join(labels, "doc_id").collect()
    caught = [r.is_toxic for r in rows if r.toxic]
    alarms = [r.is_toxic for r in rows if not r.toxic]
    assert np.mean(caught) > 0.85 and np.mean(alarms) < 0.04
    assert all(0 <= r.expected_severity <= 2 and r.p_severe <= r.p_toxic + 1e-9 for r in rows)


def test_ordinal_fit_orders_grades():
    r = np.random.default_rng(0)
    grade = r.integers(0, 3, 600)
    rows = [np.unique(np.concatenate([r.integers(10, 60, 8), np.arange(3 * g)])) for g in grade]
    start = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    w, cuts = toxicity.fit_ordinal(start, np.concatenate(rows), grade, 64)
    score = np.array([w[x].sum() for x in rows])
    assert cuts[0] < cuts[1] and score[grade == 0].mean() < score[grade == 1].mean() < score[grade == 2].mean()
    assert (np.digitize(score, cuts) == grade).mean() > 0.95


def test_toxicity_odd_input(spark, odd, empty):
    docs, df = odd
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score(df, toxicity.fit(df, none)).collect()
    assert len(rows) == len(docs) and all(r.expected_severity == 0 for r in rows if not (docs[r.doc_id] or "").strip())
    assert toxicity.score(empty, toxicity.fit(df, none)).count() == 0


def test_toxicity_null_ids_and_empty_tables(spark, empty):
    docs = spark.createDataFrame([(None, "a b"), (None, None), (1, "a b"), (1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, 0), (1, 1), (7, None)], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == 4 and len({r.expected_severity for r in rows if r.doc_id == 1}) == 1
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(empty, toxicity.fit(empty, none)).count() == 0


def test_toxicity_uses_every_word_of_a_long_sample_text(spark):
    many = " ".join(f"f{i}" for i in range(20_000))
    docs = spark.createDataFrame([(i, f"{many if i % 2 else 'plain'} {'zzbad' if i % 2 else 'zzgood'} w{i}") for i in range(200)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    model = toxicity.fit(docs, labels)
    data = np.frombuffer(b"zzbad", np.uint8)
    _, feature, _ = toxicity._features(data, np.array([0, 5]))
    assert model[0][feature].min() > 0


def plain_loss(w, cuts, rows, grade, mass, l1):
    total = 0.0
    for x, g, m in zip(rows, grade, mass, strict=True):
        z = sum(w[i] for i in x)
        above = lambda j: 1.0 if j < 0 else 0.0 if j >= len(cuts) else 1 / (1 + np.exp(cuts[j] - z))
        total -= m * np.log(max(above(g - 1) - above(g), 1e-12))
    return total + float((l1 * w).sum())


def test_ordinal_fit_is_a_minimum_of_the_plain_loss():
    r = np.random.default_rng(3)
    grade = r.integers(0, 3, 240)
    rows = [np.unique(np.concatenate([r.integers(6, 14, 3), r.choice(6, 2 * g, replace=False)])) for g in grade]
    start = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    w, cuts = toxicity.fit_ordinal(start, np.concatenate(rows), grade, 14, rounds=4000)
    per = np.bincount(grade)
    mass = 1 / per[grade] / 3
    l1 = np.array([toxicity.L1_SIGMAS * np.sqrt(sum(m * m for x, m in zip(rows, mass, strict=True) if i in x)) / 2 for i in range(14)])
    best = plain_loss(w, cuts, rows, grade, mass, l1)
    for i in range(14):
        for step in (0.05, -0.05):
            other = w.copy()
            other[i] = max(0, other[i] + step)
            assert plain_loss(other, cuts, rows, grade, mass, l1) > best - 1e-4
    for j in range(2):
        for step in (0.05, -0.05):
            other = cuts.copy()
            other[j] += step
            assert plain_loss(w, other, rows, grade, mass, l1) > best - 1e-4


def test_toxicity_scores_by_brute_force(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    weights, cuts = toxicity.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.limit(200).collect()}
    assert weights.any()
    for r in toxicity.score(docs, (weights, cuts)).filter(F.col("doc_id").isin(list(texts))).collect():
        data = np.frombuffer((texts[r.doc_id] or "").encode(), np.uint8)
        _, feature, words = toxicity._features(data, np.array([0, len(data)]))
        z = sum(float(np.float32(weights[i])) for i in feature)
        above = [1 / (1 + np.exp(c - z)) if words[0] else 0.0 for c in cuts]
        assert abs(r.expected_severity - sum(above)) < 1e-6 and abs(r.p_toxic - above[0]) < 1e-6
        assert r.grade == int(np.argmax([1 - above[0], above[0] - above[1], above[1]])) and r.is_toxic == (sum(above) >= toxicity.TOXIC_FROM)


def test_quality_keeps_clean_and_drops_junk(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.rate(docs, ["doc_id"]).join(labels.withColumnRenamed("quality", "label"), "doc_id").filter("not base_failed").collect()
    assert np.mean([r.kept for r in rows if r.label == 1]) > 0.98 and np.mean([r.kept for r in rows if r.label == 0]) < 0.1


def test_lm_gradient_lowers_loss():
    r = np.random.default_rng(0)
    vocab = {"bias": np.zeros(lm_score.CLASSES, np.float32)}
    around = r.integers(0, lm_score.CLASSES, (4000, 4))
    own = around[:, 1]  # the word before: learnable
    p = lm_score.initial(vocab)
    before = lm_score.log_probabilities(lm_score.prepared(p), own, around).mean()
    state = [(np.zeros_like(a), np.zeros_like(a)) for a in p]
    t = 0
    for _ in range(60):
        t = lm_score.train(p, own, around, state, t)
    ready = lm_score.prepared(p)
    assert lm_score.log_probabilities(ready, own, around).mean() > before + 1
    total = np.exp([lm_score.log_probabilities(ready, np.full(3, k), around[:3]) for k in range(lm_score.CLASSES)]).sum(0)
    assert np.allclose(total, 1, atol=1e-4)


def test_lm_network_is_the_plain_network():
    r = np.random.default_rng(1)
    vocab = {"bias": r.standard_normal(lm_score.CLASSES).astype(np.float32)}
    p = lm_score.initial(vocab)
    around, own = r.integers(0, lm_score.CLASSES + 1, (50, 4)), r.integers(0, lm_score.CLASSES, 50)
    got = lm_score.log_probabilities(lm_score.prepared(p), own, around)
    embed, w, b, outer, group, inner, within = (a.astype(np.float64) for a in p)
    members = inner.shape[2]
    for i in range(50):
        h = np.tanh(np.concatenate([embed[c] for c in around[i]]) @ w + b)
        g = h @ outer + group
        k, j = divmod(int(own[i]), members)
        x = h @ inner[k] + within[k]
        assert abs(got[i] - (g[k] - np.log(np.exp(g).sum()) + x[j] - np.log(np.exp(x).sum()))) < 0.05  # rounded weights
    many = np.tile(around, (200, 1))[3:], np.tile(own, 200)[3:]
    for step in (8192, 1000, 77):  # not a bit depends on a token's place in a block
        again = lm_score.log_probabilities(lm_score.prepared(p), many[1], many[0], step)
        assert (np.concatenate([got[:3], again]).reshape(200, 50) == got).all()


def test_lm_takes_one_exponential_for_each_output(monkeypatch):
    class Counting:
        taken = 0

        def __getattr__(self, name):
            return getattr(np, name)

        def exp(self, z, **more):
            self.taken += z.size
            return np.exp(z, **more)

    r = np.random.default_rng(4)
    p = lm_score.initial({"bias": np.zeros(lm_score.CLASSES, np.float32)})
    around, own = r.integers(0, lm_score.CLASSES + 1, (3000, 4)), r.integers(0, lm_score.CLASSES, 3000)
    outputs = 3000 * (p[5].shape[0] + p[5].shape[2])
    ready = lm_score.prepared(p)
    monkeypatch.setattr(lm_score, "np", counted := Counting())
    lm_score.log_probabilities(ready, own, around)
    assert counted.taken == outputs
    lm_score.train(p, own, around, [(np.zeros_like(a), np.zeros_like(a)) for a in p], 0)
    assert counted.taken == 2 * outputs


def test_lm_scores(spark, sf, odd, empty):
    docs, df = odd
    rows = {r.doc_id: r for r in lm_score.score_documents(df).collect()}
    assert len(rows) == len(docs)
    for i, t in docs.items():
        if not (t or "").strip():
            assert rows[i].n_tokens == 0 and rows[i].pseudo_log_likelihood == 0 and rows[i].mean_log_probability is None
        else:
            assert rows[i].n_tokens == 0 or rows[i].pseudo_log_likelihood < 0
    assert rows[8].pseudo_log_likelihood == rows[9].pseudo_log_likelihood
    assert lm_score.score_documents(empty).count() == 0


def test_lm_scores_do_not_depend_on_partitions_or_place(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.filter("doc_id < 20").withColumn("doc_id", F.lit(None).cast("long")))  # null ids, repeated rows
    small = lm_score.GROUP_TOKENS
    lm_score.GROUP_TOKENS = 20_000
    try:
        runs = []
        for parts in (1, 7):
            rows = lm_score.score_documents(docs.repartition(parts)).collect()
            runs.append(sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.pseudo_log_likelihood) for r in rows))
    finally:
        lm_score.GROUP_TOKENS = small
    assert runs[0] == runs[1] and len(runs[0]) == docs.count()


def plain_scores(docs, vocab, p, counts):
    """The same scores word by word, with every document's own words left out of the counts."""
    from collections import Counter

    from riskloom.llm import kernel as K
    from riskloom.llm.tokens import cores

    ready, out = lm_score.prepared(p), {}
    for i, text in docs.items():
        data = np.frombuffer((text or "").encode(), np.uint8)
        s, e, _, _, _, words = cores(data, np.array([0, len(data)]))
        own = lm_score._classes(words, vocab).tolist()
        tokens, times, inside, total = K.signed(words).tolist(), Counter(K.signed(words).tolist()), Counter(own), 0.0
        for j, (w, k) in enumerate(zip(tokens, own, strict=True)):
            around = [own[j + d] if 0 <= j + d < len(own) else len(vocab["bias"]) for d in lm_score.STEPS]
            total += float(lm_score.log_probabilities(ready, np.array([k]), np.array([around]))[0])
            if k >= vocab["frequent"]:
                left = counts[w] - times[w]
                total += np.log(left) if left else -(int(e[j] - s[j]) + 1) * lm_score.SPELL
                total -= np.log(vocab["total"][k] - inside[k] + 1)
        out[i] = (len(own), total)
    return out


def test_lm_scores_by_brute_force(spark, sf, odd, monkeypatch):
    monkeypatch.setattr(lm_score, "KNOWN", 64)  # most words' counts are joined
    docs, df = odd
    own = df.select("doc_id", "text")
    vocab = lm_score.vocabulary(own)
    p = lm_score.fit(own, vocab)
    counts = {r.word: r.n for r in spark.read.parquet(vocab["counts"]).collect()}
    want = plain_scores(docs, vocab, p, counts)
    for r in lm_score.score(own, vocab, p, counted=True).collect():
        n, total = want[r.doc_id]
        assert r.n_tokens == n and abs(r.pseudo_log_likelihood - total) < 1e-4 * max(1, n) ** 0.5


def test_lm_tells_documents_that_occur_twice(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = lm_score.score_documents(docs).join(docs.groupBy("text").agg(F.count(F.lit(1)).alias("copies")).join(docs, "text").select("doc_id", "copies"), "doc_id").filter("n_tokens > 0").collect()
    once, twice = ([r.mean_log_probability for r in rows if r.copies == n] for n in (1, 2))
    assert np.mean(np.array(twice) > np.quantile(once, 0.9)) > 0.4


def test_lm_training_helps_on_unseen_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    seen, unseen = docs.filter("doc_id % 5 <> 0"), docs.filter("doc_id % 5 = 0")
    vocab = lm_score.vocabulary(seen)
    mean = lambda p: lm_score.score(unseen, vocab, p).agg(F.sum("pseudo_log_likelihood") / F.sum("n_tokens")).first()[0]
    assert mean(lm_score.fit(seen, vocab)) > mean(lm_score.initial(vocab)) + 0.05


def test_lm_statistics_grow_with_the_corpus(spark):
    # 400 words seen 50 times and 90,000 seen once: a bucket's words must not share one probability, with or without a broadcast count
    common, rare = [f"c{i}x" for i in range(400)], [f"r{i}y" for i in range(90_000)]
    rows = [(i, " ".join(common)) for i in range(50)] + [(100 + i, " ".join(rare[i::100])) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocab = lm_score.vocabulary(docs)
    assert len(vocab["bias"]) == lm_score.class_number(90_400) > lm_score.class_number(1000)
    assert len(vocab["known"]) == 400  # the rare words' counts are joined
    got = {r.doc_id: r for r in lm_score.score(docs, vocab, lm_score.initial(vocab)).collect()}
    assert len(got) == 150 and got[0].mean_log_probability > got[100].mean_log_probability + 2
    # over all words and the unseen ones of each bucket, P(word | class) is 1
    n = {r.word: r.n for r in spark.read.parquet(vocab["counts"]).collect()}
    words = np.array(list(n), np.int64)
    own = lm_score._classes(words.view(np.uint64), vocab)
    mass = np.bincount(own, weights=list(n.values()), minlength=len(vocab["bias"]))
    assert np.allclose(mass, vocab["total"])
