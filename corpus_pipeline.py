"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns what it keeps of docs.

Every stage but the last returns the columns of documents.  Other columns of the input do not come along.  Rows with a null
doc_id are judged by their text alone: quality rules, line dedup and encoding treat them like others, near duplicates and
decontamination leave them in.  Rows with a null text are dropped by the quality rules, as documents without words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, jaccard_join, line_dedup as lines, pieces, quality_rules
from riskloom.llm.kernel import folders_made, remove, shared_folder, sweep

#: SQL cannot express the stages that learn or search (rule accuracies, similarity join, templates, subword merges).
ORACLE_SQL = None

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars as the text now has them."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules' posterior keeps."""
    return quality_rules.rate(docs.select(*COLUMNS), list(COLUMNS)).filter("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten or more documents have; every document stays."""
    return _documents(lines.drop_common_lines(docs.select(*COLUMNS), min_docs=10))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard similarity 0.8): the least id."""
    groups = jaccard_join.jaccard_components(docs, k=5, num=4, den=5)
    others = groups.filter("component_id <> id").select(F.col("id").alias("doc_id"))
    return docs.join(others, "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    hits = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(hits.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as subword ids (32-bit little-endian), with the decoded text in place of the text."""
    out = pieces.encode_documents(docs, pieces.default_model())
    return out.select("doc_id", F.col("decoded").alias("text"), "lang", "source", "n_chars", "n_tokens", "ids", "ids_sha256")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("pieces", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are removed when the next one's are written, and so are its working tables."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (name, stage) in enumerate(STAGES):
        folder = shared_folder(spark)
        made = folders_made()
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(path := f"{folder}/{i}-{name}")
            sweep(spark, made)
            if before:
                remove(spark, before)
            docs, before = spark.read.parquet(path), folder
    return docs
