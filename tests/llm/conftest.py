import random

import pytest

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: Columns whose names operators use themselves.
CLASHES = [
    "row", "keys", "name", "height", "node", "bucket", "bands", "component", "score", "found", "spans", "t1",
    "cell", "place", "mentions", "pattern", "lang_pred", "language", "encoding", "__encoded", "label", "kept", "size",
]


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows, repeated and missing ids."""
    rng = random.Random(11)
    base = prose(rng, 300)
    near = base.replace("w1 ", "zz ", 1)
    passage = prose(rng, 120)
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, "ONE"),
        (6, "a b c d"),
        (7, "a B c d"),
        (8, base),
        (9, base),
        (10, near),
        (11, base.upper()),
        (12, "x" * 200_000),
        (13, prose(rng, 40_000, 50_000)),
        (14, "é" * 900 + " Ünïcode ÉÀ " + "é" * 900),
        (15, passage + " " + prose(rng, 50)),
        (16, prose(rng, 30) + " " + passage),
        (17, "ab" * 500),
        (17, "other text of the same id"),
        (18, "same row twice"),
        (18, "same row twice"),
        (None, "no id"),
        (None, base),
        (None, None),
        (-5, "\x00\x1f null signs   <|endoftext|> 1.2.3.4 a@b.cd"),
        (19, "0" * 5000 + "@" * 500 + "+1" * 500),
    ]
    return rows


@pytest.fixture(scope="session")
def hard(spark, hard_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(hard_rows, "doc_id long, text string").repartition(3)
    return docs.withColumns({c: F.lit(7) for c in CLASHES} | {"lang": F.lit("xx"), "source": F.lit("s")})


@pytest.fixture(scope="session")
def empty(hard):
    return hard.limit(0)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def null_first(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))
