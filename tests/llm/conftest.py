import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("score", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("block", T.StringType()),
        T.StructField("key", T.StringType()),
    ]
)
LONG = " ".join(f"word{k % 977}x{k}" for k in range(20_000))
PASSAGE = "this passage of well over fifty bytes stands in several documents, word for word. "
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the hounds that follow it across the wide fields."),
    (2, "The quick brown fox jumps over the lazy dog and runs away from the hounds that follow it across the wide fields."),
    (2, "The quick brown fox jumps over the lazy dog and runs away from the hounds that follow it across the wide fields."),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, "a"),
    (7, LONG),
    (8, PASSAGE + "Then something of its own follows, with enough words to pass the rules of length and so on and on."),
    (9, "An opening that nobody else has. " + PASSAGE + "And an end é漢 of its own."),
    (10, "x y " * 60),
    (11, "one line\none line\n\none line\n*** $$$ |"),
    (None, "A text without an id, which is long enough to be looked at by all operators of this package, we hope so."),
    (12, "<|endoftext|> in a text\x00 with\r\nodd   blanks  and é, ß, 漢字 and 😀 "),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", None, None, "s", None, "b", "k") for i, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, 1 if i % 3 else 0, 0, "x") for i in range(1, 13)] + [(None, 1, 0, "x"), (1, None, None, "x"), (1, 1, 0, "x")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, score string")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
