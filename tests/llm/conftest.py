import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def prose(seed: int, n: int) -> str:
    """Made-up words; equal seeds give equal texts."""
    rng = random.Random(seed)
    syllables = ["ta", "ri", "no", "sel", "mo", "ku", "vand", "ep", "lir", "os"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


def rows_of(texts, first: int = 0):
    return [(first + k, t, "en", "src0", None if t is None else len(t)) for k, t in enumerate(texts)]


#: Null and empty texts, only blanks, one word, one very long word, a long text, odd characters.
ODD_TEXTS = [None, "", "  \n\t ", "word", "x" * 5000, prose(7, 30_000), "é́ \x00 ▁ 日本語\u2028 Ü", "a\r\nb\n\nb\nb", prose(8, 60), prose(8, 60)]


@pytest.fixture(scope="session")
def documents(spark):
    def make(texts, first=0):
        return spark.createDataFrame(rows_of(texts, first), DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def odd_documents(spark):
    """The odd texts under null and repeated ids, with columns whose names operators use."""
    rows = rows_of(ODD_TEXTS) + [(None, prose(9, 80), None, None, None), (3, "word", "en", "src0", 4)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    for name in ("label", "score", "component", "bucket", "part", "spans", "ids", "host", "block"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df
