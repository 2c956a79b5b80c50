import random

import pytest

SMALL = "/root/testdata/sf0.001"

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, token string, label int, n int, h int, "
          "range int, key string, copy int, shard int, score double, rep bigint")


def odd_rows():
    """Nulls, empties, ties, repeated rows, a very long text, a null id; and
    columns whose names the operators use inside."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    long = " ".join(word() for _ in range(30_000))
    base = [word() for _ in range(200)]
    near = base[:100] + ["changed"] + base[101:]
    texts = [
        (10_000, None), (10_001, ""), (10_002, " \n\t "), (10_003, "word"), (10_004, "One two three"), (10_005, long), (10_006, long),
        (10_007, " ".join(base)), (10_008, " ".join(near)), (10_007, " ".join(base)), (None, " ".join(base)), (None, None),
        (10_009, "é ü 😀 ÀÉ\u2003x\x0by 12 km"), (10_010, "Word"), (10_011, "word"), (10_012, "😀" * 50), (10_013, "1234 !!! 5678"),
        (10_014, "line\n" * 400), (10_015, " ".join(["same"] * 300)), (10_016, " ".join(["same"] * 300) + " end"),
    ]
    return [(i, t, None if k % 3 else "en", None if k % 4 == 0 else "odd", None, "x", 1, 2, 3, 4, "k", 5, 6, 0.5, 7) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    from pyspark.sql import functions as F

    odd = spark.createDataFrame(odd_rows(), SCHEMA)
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    for f in odd.schema.fields:
        if f.name not in given.columns:
            given = given.withColumn(f.name, F.lit(None).cast(f.dataType))
    return given.select(*odd.columns).unionByName(odd).cache()


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
