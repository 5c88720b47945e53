import pytest
from pyspark.sql import functions as F

from riskloom.functions import scalars as S
from riskloom.functions import text as T

VARIANTS = {
    "oil & gas": {"oil-gas", "oil-and-gas"}, "R&D": {"rd", "r-and-d"}, "C++": {"c--", "c"}, "price > cost!": {"price-cost", "pricecost"},
    "A & B + C": {"a-b-c", "a-bc", "a-and-b-c", "a-and-bc"}, "": set(), "  ": set(), None: set(), "two  words": {"two-words"},
}
TOKENS = {"silicon wafers": ["silicon", "wafers"], "burn-in boards": ["burn", "boards"], "TSMC": ["tsmc"], "R&D": ["r", "d"], "": [], None: [], "a a a": ["a"]}


@pytest.mark.parametrize("keyword", VARIANTS)
def test_url_variants(spark, keyword):
    assert T.url_variants_literal(keyword) == VARIANTS[keyword]
    df = spark.createDataFrame([(keyword,)], "k string")
    assert set(df.select(T.url_variants(F.col("k"))).first()[0]) == VARIANTS[keyword]


@pytest.mark.parametrize("keyword", TOKENS)
def test_keyword_tokens(spark, keyword):
    assert T.keyword_tokens_literal(keyword) == TOKENS[keyword]
    df = spark.createDataFrame([(keyword,)], "k string")
    assert df.select(T.keyword_tokens(F.col("k"))).first()[0] == TOKENS[keyword]


def test_stem(spark):
    for word, want in {"chips": "chip", "gas": "gas", "class": "clas", "s": "s", "": ""}.items():
        assert T.stem_literal(word) == want
        assert spark.createDataFrame([(word,)], "w string").select(T.stem(F.col("w"))).first()[0] == want


@pytest.mark.parametrize(
    "title, want",
    [
        ("Novo Nordisk’s owner", {"novo", "nordisk", "s", "owner"}), ("it's", {"it", "s"}), ("“quoted” words", {"", "quoted", "word"}), ("a–b—c", {"a", "b", "c"}),
        ("well-known", {"well", "known"}), ("wait…", {"wait", ""}), ("no break", {"no", "break"}), ("café", {"caf", ""}), ("MiXeD", {"mixed"}), ("2024 plans", {"2024", "plan"}),
    ],
)
def test_row_tokens(spark, title, want):
    df = spark.createDataFrame([(title, None)], "t string, k string")
    assert set(df.select(T.row_tokens(F.col("t"), F.col("k"))).first()[0]) == want


def test_scalars(spark):
    df = spark.createDataFrame([("85.5", "20240131094500", "20240131", "x"), ("", "20261316133000", "20261332", None)], "n string, t string, d string, s string")
    a, b = df.select(S.whole(F.col("n")).alias("w"), S.stamp(F.col("t")).cast("string").alias("t"), S.day(F.col("d")).cast("string").alias("d"), T.safe_string(F.col("s")).alias("s")).collect()
    assert (a.w, a.t, a.d, a.s) == (85, "2024-01-31 09:45:00", "2024-01-31", "x")
    assert (b.w, b.t, b.d, b.s) == (None, None, None, "")


def test_doc_id_is_32_bytes(spark):
    df = spark.createDataFrame([("http://a",), (None,)], "u string").select(S.doc_id(F.col("u")).alias("d"))
    a, b = df.collect()
    assert len(a.d) == 32 and b.d is None
