import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_words string, kept string, text_col string"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def odd_texts():
    """Null, empty and blank texts, ties, repeats, odd spaces, a very long text, a common passage, near copies."""
    r = random.Random(7)
    vocab = [f"{a}{b}" for a in ("ka", "lo", "mi", "té", "zu", "漢") for b in ("ra", "na", "so", "pi", "")]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base, passage = say(120), say(40)
    out = [None, "", "   ", "\n", "\n\n a \n", "one", "ONE", "one\ttwo\x0bthree", base, base, base.upper(), " ".join("the" for _ in range(300)), "the " * 200 + base]
    out += [base.replace(" ", "\n"), base.replace(" ", "  "), "x" * 3000, say(4000), "Common line here.\n" + say(30), " common LINE here. \n" + say(30)]
    for i in range(14):
        w = base.split(" ")
        for _ in range(i % 5):
            w[r.randrange(len(w))] = r.choice(vocab)
        out.append(" ".join(w))
        out.append(f"{say(20 + i)}\nCommon line here.\n{passage} {say(15)}")
    for n in range(1, 10):
        out += [say(n), say(n)]
    out += [passage, passage, "▁▁ x  y 🙂 \x00", "ends with newline\n", "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3]
    return out


@pytest.fixture(scope="session")
def odd(spark):
    """{id: text}, and the table with columns whose names clash with the operators' own."""
    docs = dict(enumerate(odd_texts()))
    df = spark.createDataFrame([(i, t, "clash", "clash", None) for i, t in docs.items()], SCHEMA).repartition(3)
    return docs, df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
