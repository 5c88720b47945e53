"""Operators with one right answer, against brute force: over the test tables and over odd texts."""

import sys

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import components, decontaminate, jaccard_join, license_scan, line_dedup, pieces, quality_rules, registry, substring_dedup, training_order
from riskloom.llm.perfect_hash import Shard

from . import reference as R


def both(spark, sf, texts, odd):
    yield spark.read.parquet(f"{sf}/documents.parquet"), texts
    yield odd[1], odd[0]


def test_quality_signals(spark, sf, texts, odd):
    for df, docs in both(spark, sf, texts, odd):
        rows = quality_rules.rate(df, ["doc_id", "kept"]).collect()
        assert len(rows) == len(docs)
        for r in rows:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == R.quality_base(docs[r.doc_id])
            assert 0 <= r.quality <= 1 and not (r.kept and r.base_failed) and (r.base_failed or r.kept == (r.quality >= quality_rules.KEEP_FROM))


def test_quality_windows_are_not_copied(odd):
    plan = quality_rules.signals(odd[1], ["doc_id"])._jdf.queryExecution().analyzed().toString()
    assert "xxhash64(" in plan and "xxhash64(slice(" not in plan


def test_quality_em_is_plain_em(spark, sf):
    votes = quality_rules.signals(spark.read.parquet(f"{sf}/documents.parquet"), ["doc_id"]).cache()
    model = quality_rules.fit(votes)
    x = np.array([[r[f"vote_{n}"] for n in quality_rules.RULES] for r in votes.collect()])
    good, (a0, b0), w = quality_rules.PRIOR_GOOD, quality_rules.PRIOR_ACCURACY, quality_rules.PRIOR_WEIGHT
    a, b = np.full(x.shape[1], a0), np.full(x.shape[1], b0)
    for _ in range(quality_rules.ROUNDS):
        lg = good * np.where(x == 1, a, np.where(x == -1, 1 - a, 1)).prod(1)
        lb = (1 - good) * np.where(x == -1, b, np.where(x == 1, 1 - b, 1)).prod(1)
        p = (lg / (lg + lb))[:, None]
        good = (p.sum() + w * quality_rules.PRIOR_GOOD) / (len(x) + w)
        a = ((p * (x == 1)).sum(0) + w * a0) / ((p * (x != 0)).sum(0) + w)
        b = (((1 - p) * (x == -1)).sum(0) + w * b0) / (((1 - p) * (x != 0)).sum(0) + w)
    assert model["good"] == pytest.approx(good, abs=1e-4)
    for n, u, v in zip(quality_rules.RULES, a, b, strict=True):
        assert model["accuracy"][n] == pytest.approx((u, v), abs=1e-3)


def test_substring_dedup(spark, sf, texts, odd):
    for df, docs in both(spark, sf, texts, odd):
        want = R.substring_dedup(docs)
        got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(df).collect()}
        assert got == want


@pytest.mark.parametrize("window", [1, 4, 36, 45])
def test_substring_dedup_with_other_windows(odd, window):
    docs, df = odd
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(df, window).collect()}
    assert got == R.substring_dedup(docs, window)
    with pytest.raises(ValueError, match="one word"):
        substring_dedup.remove_repeats(df, 0)


def test_substring_dedup_of_hot_windows(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 8)  # bitmaps are built on the driver's setting
    passage = " ".join(f"p{i}" for i in range(30))
    docs = {i: f"{' '.join(f'w{i}x{j}' for j in range(10))} {passage if i % 3 else passage[:80]} end{i}" for i in range(60)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup.remove_repeats(df).collect()}
    assert got == R.substring_dedup(docs)


def test_suffix_automaton():
    a = substring_dedup.SuffixAutomaton()
    strings = {"abcabcd": 5, "xbcabq": 3, "cab": 1, "bcab": 9}
    for s, owner in strings.items():
        a.add(s, owner)
    a.settle()
    for n in (1, 2, 3, 4):
        for text in (*strings, "zzbcabcz"):
            for end, got in enumerate(a.least_owners(text, n)):
                part = text[end - n + 1 : end + 1] if end >= n - 1 else None
                owners = [o for s, o in strings.items() if part and part in s]
                assert got == (min(owners) if owners else None)


@pytest.mark.parametrize("k, num, den", [(4, 85, 100), (5, 4, 5)])
def test_jaccard_components(spark, sf, texts, odd, k, num, den):
    for df, docs in both(spark, sf, texts, odd):
        got = {r.id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, k, num, den).collect()}
        assert got == R.jaccard_components(docs, k, num, den)


def test_jaccard_components_when_names_clash(odd):
    docs, df = odd  # three bits: many sets have the first half of their digest in common
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, 5, 4, 5, name_bits=3).collect()}
    assert got == R.jaccard_components(docs, 5, 4, 5)


def test_jaccard_components_of_large_stars(spark, monkeypatch):
    import random

    monkeypatch.setattr(jaccard_join, "TREE_SETS", 8)
    monkeypatch.setattr(jaccard_join, "UNIT_SHINGLES", 400)
    r, vocab = random.Random(5), [f"v{i}" for i in range(3000)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    passage, docs = say(30), {}
    for base in range(4):  # families that share a passage, at different lengths
        words = (passage + " " + say(20 + 5 * base)).split()
        for _ in range(40):
            w = list(words)
            for _ in range(r.randrange(3)):
                w[r.randrange(len(w))] = r.choice(vocab)
            docs[len(docs)] = " ".join(w)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    got = {x.id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(df, 3, 6, 10).collect()}
    assert got == R.jaccard_components(docs, 3, 6, 10)


def test_prefix_tree():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 40)).astype(np.uint64)) for _ in range(80)]
    sets += [sets[0], sets[1][:-1]]
    tree = jaccard_join.PrefixTree(sets)
    for s in sets:
        for num, den in ((85, 100), (1, 2)):
            want = [i for i, t in enumerate(sets) if den * len(np.intersect1d(s, t)) >= num * len(np.union1d(s, t))]
            assert sorted(tree.similar(s, num, den)) == want


def test_prefix_tree_of_a_dense_family():
    """Array operations for a probe do not grow with the nodes it has keys in; sets of one family, just below the similarity."""
    r = np.random.default_rng(4)
    base = np.arange(0, 40_000, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[r.random(400) > 0.08], r.integers(0, 1 << 60, 6).astype(np.uint64)])) for _ in range(200)]
    tree = jaccard_join.PrefixTree(sets)
    calls = []

    def count(frame, event, arg):
        if event in ("call", "c_call"):
            calls.append(event)

    sys.setprofile(count)
    found = [tree.similar(s, 85, 100) for s in sets]
    sys.setprofile(None)
    want = [[i for i, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= 85 * len(np.union1d(s, t))] for s in sets]
    assert [sorted(f) for f in found] == want
    assert len(calls) < 100 * len(sets)


def test_components(spark):
    links = [(5, 4), (4, 3), (9, 8), (3, 5), (7, 7), (12, 11), (11, 10), (10, 20)] + [(i, i + 1) for i in range(100, 140)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long"), jaccard_join.K.shared_folder(spark)).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 8: 8, 9: 8, 10: 10, 11: 10, 12: 10, 20: 10} | {i: 100 for i in range(100, 141)}


@pytest.mark.parametrize("least", [2, 10])
def test_line_dedup(spark, sf, texts, odd, least, monkeypatch):
    monkeypatch.setattr(line_dedup, "PART_DOCS", 20)
    for df, docs in both(spark, sf, texts, odd):
        ids = sorted(docs)
        want = dict(zip(ids, R.line_dedup([docs[i] for i in ids], least), strict=True))
        for limit, keys in ((32 << 20, 5), (0, 5), (0, 500_000)):  # shards broadcast, and probes sent to them; one shard, and many
            got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_common_lines(df, least, broadcast_bytes=limit, shard_keys=keys).collect()}
            assert got == want


def test_line_dedup_keeps_any_column(spark):
    rows = [(i, "same line\nown " + str(i), "a", 1.5, 3) for i in range(12)] + [(None, "same line", None, None, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, `te.xt` string, d1 string, `x y` double, drop int")
    for limit in (32 << 20, 0):
        out = line_dedup.drop_common_lines(df, 10, "te.xt", broadcast_bytes=limit)
        assert out.columns == ["doc_id", "d1", "x y", "drop", "te.xt", "n_lines", "n_dropped"]
        out = out.select("doc_id", "d1", "`x y`", "drop", "`te.xt`", "n_lines", "n_dropped")
        got = sorted((tuple(r) for r in out.collect()), key=str)
        assert got == sorted(((i, a, x, d, t.removeprefix("same line").removeprefix("\n"), t.count("\n") + 1, 1) for i, t, a, x, d in rows), key=str)


def test_columns_of_any_name(spark):
    rows = [(1, "one two three " * 6, "a", "b"), (2, "one two three " * 6, None, "c"), (None, None, "d", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, `riskloom 0` string")
    for out in (substring_dedup.remove_repeats(df), pieces.encode_documents(df, pieces.default_model())):
        got = [tuple(r) for r in out.select("doc_id", "`a.b`", "`riskloom 0`").collect()]
        assert sorted(got, key=str) == sorted(((i, a, b) for i, _, a, b in rows), key=str)


def test_perfect_hash():
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 2**63, 20000).astype(np.uint64))
    shard = Shard.from_bytes(Shard.build(keys, keys + np.uint64(5), np.arange(len(keys))).to_bytes())
    assert sorted(shard.slots(keys).tolist()) == list(range(len(keys)))
    assert (shard.lookup(keys, keys + np.uint64(5)) == np.arange(len(keys))).all()
    assert not shard.lookup(keys + np.uint64(2**62), keys).any()


def test_pieces(spark, sf, texts, odd):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    for df, docs in both(spark, sf, texts, odd):
        for r in pieces.encode_documents(df, pieces.default_model()).collect():
            ids = sp.encode(docs[r.doc_id] or "", add_bos=True, add_eos=True)
            assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids and r.n_tokens == len(ids)
            assert r.decoded == sp.decode(ids) and r.decoded_sha256 == R.sha(r.decoded)


def test_pieces_on_random_strings():
    import random

    import sentencepiece

    sp, vocab, r = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model()), pieces.Vocabulary(open(pieces.default_model(), "rb").read()), random.Random(2)
    bits = ["ha", "the", "   ", "▁", "ing", " ", "tion", "aaaa", "\n", "🙂", "漢", "é", "\x00", "."]
    for _ in range(1500):
        text = "".join(r.choice(bits) for _ in range(r.randrange(40)))
        ids, n = vocab.encode([text])
        assert ids.tolist() == sp.encode(text) and vocab.decode(ids, n) == [sp.decode(ids.tolist())]
    noise = [[r.randrange(vocab.size) for _ in range(12)] for _ in range(300)]
    assert vocab.decode(np.concatenate(noise), np.array([12] * 300)) == [sp.decode(x) for x in noise]


def test_training_order(spark, sf, texts, odd, tmp_path):
    for n in (1, 2, 3, 5, 100, 4097):
        slots = training_order.feistel(np.arange(n), n, 11)
        assert sorted(slots.tolist()) == list(range(n)) and (training_order.feistel_inverse(slots, n, 11) == np.arange(n)).all()
    for df, docs in both(spark, sf, texts, odd):
        sequences = []
        for i in sorted(docs):
            raw = (docs[i] or "").encode()
            if raw:
                raw += b"\xff"
                raw += b"\xfe" * (-len(raw) % 64)
                sequences += [(i, k // 64, raw[k : k + 64]) for k in range(0, len(raw), 64)]
        slots = training_order.feistel(np.arange(len(sequences)), len(sequences), 3)
        want = dict(zip(slots.tolist(), sequences, strict=True))
        shards = training_order.materialise(df, 64, 100, 3).cache()
        for r in shards.collect():
            for k in range(r.n_sequences):
                assert (r.doc_ids[k], r.places[k], bytes(r.payload[64 * k : 64 * k + 64])) == want.pop(r.first_slot + k)
        assert not want
        for r in training_order.write_shards(shards, f"file://{tmp_path}").collect():
            data = open(r.path, "rb").read()
            assert len(data) == 64 * r.n_sequences and training_order.hashlib.sha256(data).hexdigest() == r.sha256
    with pytest.raises(Exception, match="same id"):
        training_order.materialise(df.unionByName(df)).collect()


def test_training_order_of_repeated_and_null_ids(spark, tmp_path):
    texts = [(1, "a" * 100), (1, "b" * 10), (1, "b" * 10), (2, "c"), (None, "d" * 70), (None, "d" * 70), (None, None), (3, "")]
    want = sorted((i if i is not None else -1, k // 64, (t + "\xff")[k : k + 64]) for i, t in texts if t for k in range(0, len(t) + 1, 64))
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def rows(shards):
        return [(r.first_slot + k, i if i is not None else -1, p, bytes(r.payload[64 * k : 64 * k + 64])) for r in shards.collect() for k, (i, p) in enumerate(zip(r.doc_ids, r.places, strict=True))]

    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = rows(training_order.materialise(df, 64, 4, 3, repeated=True))
    assert sorted(g[0] for g in got) == list(range(len(want)))
    assert sorted((i, p, t.rstrip(b"\xfe").decode("latin-1")) for _, i, p, t in got) == want
    assert sorted(got) == sorted(rows(training_order.materialise(df.orderBy(F.desc("text")).repartition(5), 64, 4, 3, repeated=True)))
    assert sum(r.n_sequences for r in training_order.query(spark, str(tmp_path)).collect()) == 6  # the query itself does not refuse


def test_training_order_of_token_ids(spark, odd):
    docs, df = odd
    encoded = pieces.encode_documents(df.select("doc_id", "text"), pieces.default_model()).select("doc_id", "ids").cache()
    rows = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4") for r in encoded.collect()}
    got = {}
    for r in training_order.materialise(encoded, 32, 50, 9, text_col="ids", token_bytes=4).collect():
        part = np.frombuffer(bytes(r.payload), "<u4").reshape(-1, 32)
        assert len(part) == r.n_sequences
        for i, place, ids in zip(r.doc_ids, r.places, part, strict=True):
            got.setdefault(i, {})[place] = ids
    assert set(got) == set(rows)
    for i, ids in rows.items():
        whole = np.concatenate([got[i][k] for k in range(len(got[i]))])
        assert whole[: len(ids)].tolist() == ids.tolist() and whole[len(ids)] == 2**32 - 1 and (whole[len(ids) + 1 :] == 2**32 - 2).all()
    with pytest.raises(Exception, match="whole numbers"):
        training_order.materialise(spark.createDataFrame([(1, bytearray(b"abc"))], "doc_id long, ids binary"), text_col="ids", token_bytes=2).collect()


def test_license_scan(spark):
    lines = ["Released under the MIT License.", "released UNDER -- the MIT license", "Released under the MIT", None, "", "x", "This work is licensed under the GNU General Public License,\nversion 3.", "Licensed under CC BY-NC 4.0."]
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert {(r.doc_id, r.block, r.license, round(r.dice, 3)) for r in rows} == {(0, "0", "MIT", 1.0), (1, "0", "MIT", 1.0), (2, "0", "MIT", 0.857), (6, "0", "GPL-3.0", 0.9), (6, "p0", "GPL-3.0", 1.0), (7, "0", "CC-BY-NC-4.0", 1.0)}


def test_license_scan_inside_longer_blocks(spark):
    gpl3 = "This work is licensed under the GNU General Public License,\n# version 3."
    header = license_scan.MORE_TEMPLATES
    texts = ["A note to all readers of this page. Released under the MIT License. And more text follows here on the very same line.", f"# A tool that counts\n# all words of a page\n# {gpl3}\n# More on the tool is\n# in the other file", header[0][1], header[2][1], "No license here at all.", None, ""]
    rows = license_scan.scan_all(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license) for r in rows} == {(0, "MIT"), (1, "GPL-3.0"), (2, "LGPL-2.1-or-later"), (3, "AGPL-3.0-or-later")}


def test_decontamination(spark, sf):
    items = ["A train from Oslo covers 120 km in 3 hours; how fast does it go on average over the whole trip?", "tiny item of five words", None, ""]
    docs = [
        "Intro text. " + items[0] + " The end.",
        "So then: A train from Bergen covers 90 km in 2 hours; how fast does it go on average over the whole trip? Next.",
        "A train from Oslo covers 120 km", "Nothing at all here that is alike", None, "", items[0].upper(), "here is a tiny item of FIVE words indeed",
    ]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_changed for r in decontaminate.contaminated(d, b).collect()}
    assert got[(0, 0)] == 0 and got[(1, 0)] > 0 and (7, 1) in got and {i for i, _ in got} <= {0, 1, 6, 7}


def test_decontamination_finds_every_whole_item(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    flat = lambda x: " ".join((x or "").lower().split())
    text, item = {r.doc_id: flat(r.text) for r in docs.collect()}, {r.item_id: flat(r.text) for r in items.collect()}
    want = {(i, j) for i, x in text.items() for j, t in item.items() if t and t in x}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert want <= got and len(got - want) <= 1


def pairs_found(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.n_changed for r in decontaminate.contaminated(d, b).collect()}


def test_decontamination_judges_each_occurrence(spark):
    ask = "A train covers {} km in {} hours; how fast does it go on average over the whole long trip?"
    fruit = "There are {} apples and {} pears in a basket; how many fruits are in the basket in the end?"
    items = [ask.format(120, 3), fruit.format(3, 3)]
    docs = [ask.format(90, 2) + " Then this. " + ask.format(80, 5), fruit.format(5, 4), ask.format(90, 2), "A train covers some of the way."]
    got = pairs_found(spark, docs, items)
    assert set(got) == {(0, 0), (1, 1), (2, 0)} and min(got.values()) > 0


def test_decontamination_takes_opening_words_as_names(spark):
    ask = "{0} buys {1} pens at 3 euros each. {0} pays with 20 euros. How much does {0} get back?"
    items = [ask.format("Maria", 4), "Anna walks to the old mill and back again before the evening rain comes"]
    docs = [ask.format("Jonas", 6), "He said that Peter walks to the old mill and back again before the evening rain comes", "Today we had rain."]
    assert set(pairs_found(spark, docs, items)) == {(0, 0), (1, 1)}


def test_decontamination_finds_exact_copies_of_few_words(spark):
    items = ["1 2 3 5 8 13 21 34 55 89 144 233 377 which number is next", "every small child in our quiet little town knows an old song about the river boats"]
    docs = ["See: " + items[0] + "?", "So " + items[1].replace("knows", "heard") + " now.", "Which number is next in 1 2 3 4 5 6 7 8 9 10?"]
    assert set(pairs_found(spark, docs, items)) == {(0, 0), (1, 1)}


def reparameterised(r, item):
    """The item with other numbers, each value replaced by one new value."""
    import re

    new = {}
    return re.sub(r"\d+", lambda m: new.setdefault(m[0], str(r.randrange(100, 999))), item)


def test_decontamination_recall_on_reparameterised_items(spark):
    import random

    r = random.Random(4)
    words = [f"{a}{b}" for a in ("br", "kl", "st", "tr", "pl", "gr") for b in ("ame", "ode", "int", "ulk", "est", "arn", "ool")]
    items = []
    for _ in range(60):
        w = [r.choice(words) for _ in range(r.randrange(14, 40))]
        for _ in range(r.randrange(1, 4)):
            w[r.randrange(len(w))] = str(r.randrange(2, 90))
        items.append(" ".join(w))
    filler = lambda n: " ".join(r.choice(words) for _ in range(n))
    docs, want = [], set()
    for i, item in enumerate(items):
        want.add((len(docs), i))
        docs.append(f"{filler(20)} {reparameterised(r, item)} {filler(9)} {reparameterised(r, item)}")  # two instances
        want.add((len(docs), i))
        docs.append(f"{filler(5)} {item}")
        docs.append(filler(60))
    got = set(pairs_found(spark, docs, items))
    assert len(want & got) >= 0.95 * len(want) and len(got - want) <= 1


def test_decontamination_of_shared_phrases(spark):
    """A phrase that all items and many documents share finds nothing by itself, and hides nothing."""
    phrase = "read the following text and answer the question in one short word please"
    own = [" ".join(f"{a}{i}{b}" for b in "abcdefghijklmnop") for i, a in enumerate(["ka", "mo", "ti", "su"] * 5)]
    items = [f"{phrase} {o}" for o in own]
    docs = [phrase] * 30 + [f"{phrase} {o}" for o in own] + [o for o in own]
    got = set(pairs_found(spark, docs, items))
    assert got == {(30 + i, i) for i in range(20)} | {(50 + i, i) for i in range(20)}


def test_decontamination_odd_input(spark, odd):
    docs, df = odd
    item = docs[8]
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(i, t, "clash") for i, t in docs.items()] + [(None, item, None), (900, long + " " + item, "c"), (901, item, "c"), (901, item, "c")]
    d = spark.createDataFrame(rows, "doc_id long, text string, hash string").repartition(3)
    b = spark.createDataFrame([(1, item), (1, item), (2, item), (3, None), (4, ""), (5, "..."), (None, item)], "item_id long, text string")
    out = decontaminate.contaminated(d, b).collect()
    got = {(r.doc_id, r.item_id) for r in out}
    same = {i for i, t in docs.items() if t and item.lower() in " ".join(t.lower().split())}
    assert len(out) == len(got) and {(i, j) for i in same | {900, 901} for j in (1, 2)} <= got and {j for _, j in got} == {1, 2}


def test_license_scan_odd_input(spark):
    notice = "Released under the MIT License."
    long = ("word " * 50_000) + "\n" + notice
    rows = [(None, notice, "a"), (None, None, "b"), (1, notice, None), (1, notice, None), (2, long, "c"), (3, "\n".join([notice] * 3), "d"), (4, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = [(r.doc_id, r.block, r.license, r.dice) for r in license_scan.scan(df).collect()]
    lines = [(i, b, n, dice) for i, b, n, dice in got if not b.startswith("p")]
    assert sorted(lines, key=str) == sorted([(None, "0", "MIT", 1.0), (1, "0", "MIT", 1.0), (1, "0", "MIT", 1.0), (2, "1", "MIT", 1.0), *((3, str(i), "MIT", 1.0) for i in range(3))], key=str)
    assert {i for i, b, _, _ in got if b.startswith("p")} == {3}
    whole = {(r.doc_id, r.license) for r in license_scan.scan_all(df).collect()}
    assert whole == {(None, "MIT"), (1, "MIT"), (2, "MIT"), (3, "MIT")}
    tie = license_scan.scan(df.filter("doc_id = 1"), templates=[("ONE", notice), ("TWO", notice)]).collect()
    assert {r.license for r in tie} == {"ONE"}


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracles(spark, sf, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    df, want = registry.QUERIES[name](spark, sf), con.sql(registry.ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    got = sorted(str([r[c] for c in order]) for r in df.collect())
    assert got == sorted(str([r[want.columns.index(c)] for c in order]) for r in want.fetchall())


def test_empty_tables(spark, empty):
    b = spark.createDataFrame([], "item_id long, text string")
    assert quality_rules.rate(empty, ["doc_id"]).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert jaccard_join.jaccard_components(empty).count() == 0
    assert line_dedup.drop_common_lines(empty).count() == 0
    assert pieces.encode_documents(empty, pieces.default_model()).count() == 0
    assert training_order.materialise(empty).count() == 0
    assert license_scan.scan(empty).count() == 0
    assert decontaminate.contaminated(empty, b).count() == 0


def test_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (None, text), (1, text), (2, text)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup.remove_repeats(df).collect()) == [(0, 0), (0, 0), (1, 0), (2, 40)]
    assert sorted((r.id, r.component_id) for r in jaccard_join.jaccard_components(df).collect()) == [(1, 1), (2, 1)]
    assert line_dedup.drop_common_lines(df, 4).filter(F.col("text") == "").count() == 4
    assert quality_rules.rate(df, ["doc_id"]).count() == 4
    rows = pieces.encode_documents(df, pieces.default_model(), with_ids=False).collect()
    assert len(rows) == 4 and len({r.ids_sha256 for r in rows}) == 1


def test_quality_carries_any_column(spark):
    rows = [(1, "some words here", "a", "b", 5, 7, "c"), (None, None, None, None, None, None, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, _words string, `a.b` string, n_lines_full int, N_WORDS int, carried string")
    out = quality_rules.rate(df, df.columns).collect()
    carried = [tuple(r[c] for c in ("doc_id", "text", "_words", "a.b", "n_lines_full", "carried")) for r in out]
    assert sorted(carried, key=str) == sorted(((*r[:5], r[6]) for r in rows), key=str)
    assert {r.n_words for r in out} == {3, 0} and not any(r.kept for r in out)
    assert quality_rules.rate(df, []).count() == 4


def test_folders_are_swept(spark, odd):
    from pathlib import Path

    K = jaccard_join.K
    before = K.folders_made()
    jaccard_join.jaccard_components(odd[1]).count()
    made = [Path(f.removeprefix("file:")) for f in K._folders[before:]]
    assert made and all(f.exists() for f in made)
    K.sweep(spark, before)
    assert not any(f.exists() for f in made) and K.folders_made() == before


def test_clusters_need_a_shared_folder(spark):
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "spark://somewhere:7077", "spark.sql.warehouse.dir": "file:/tmp/x"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="checkpoint"):
        jaccard_join.K.shared_folder(Session())
