"""The pipeline's stages, each against brute force on its own input."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from riskloom.llm import pieces

from . import reference as R


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = {}
    for name, stage in P.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        held[name] = ({r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in after.collect()})
        docs = after
        if name != "pieces":
            assert after.columns == list(P.COLUMNS)
    before, after = held["quality_rules"]
    assert all(R.quality_base(before[i].text)[-1] is False for i in after) and 0.6 * len(before) < len(after) < len(before)
    before, after = held["line_dedup"]
    want = dict(zip(before, R.line_dedup([r.text for r in before.values()], 10), strict=True))
    assert {i: r.text for i, r in after.items()} == {i: w[2] for i, w in want.items()} and all(r.n_chars == len(r.text) for r in after.values())
    before, after = held["jaccard_join"]
    groups = R.jaccard_components({i: r.text for i, r in before.items()}, 5, 4, 5)
    assert set(after) == {i for i, (_, group) in groups.items() if i == group}
    before, after = held["decontamination"]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaks = {i for i, r in before.items() if any(t in " ".join(r.text.lower().split()) for t in items)}
    assert set(after) <= set(before) - leaks and len(before) - len(after) <= len(leaks) + 1
    before, after = held["pieces"]
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    assert set(after) == set(before)
    for i, r in after.items():
        ids = sp.encode(before[i].text, add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and r.text == sp.decode(ids)


def test_run_on_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_stages_with_null_ids_and_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    some = docs.limit(40)
    extra = some.withColumn("doc_id", F.lit(None).cast("long")).unionByName(some.withColumn("text", F.lit(None).cast("string")))
    rows = docs.unionByName(extra).withColumns({"hash": F.lit("clash"), "kept": F.lit(1)})
    nulls = {"quality_rules": None, "line_dedup": 40, "jaccard_join": 40, "decontamination": 40, "pieces": 40}
    for name, stage in P.STAGES:
        out = stage(spark, rows, sf).select("doc_id", "text").collect()
        found = sum(r.doc_id is None for r in out)
        assert 0 < found <= 40 and nulls[name] in (None, found)
        if name == "quality_rules":
            assert all(r.text is not None for r in out)


def test_run_removes_what_it_wrote(spark, sf):
    K = pieces.K
    before = K.folders_made()
    rows = P.run(spark, sf).count()
    assert rows > 0 and K.folders_made() - before <= 2  # the last stage's input, and its own folder
    K.sweep(spark, before)
