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

#: Names that operators use for their own columns, given to columns of the input.
CLASHES = ["size", "target", "copies", "turn", "weight", "n", "bucket", "ws", "body", "key", "names", "spans", "_key", "_doc", "ids", "decoded", "toxicity", "fingerprint", "component", "kept", "n_words", "failed", "hash", "take"]

SENTENCE = "the quick brown fox jumps over a lazy dog while seven green birds watch from an old stone wall near the river"


def prose(n, seed):
    """Words that hardly repeat."""
    import random

    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))


ROWS = [
    (1, f"{prose(60, 1)} {SENTENCE} {prose(30, 2)}", "en", "a", 1),
    (2, f"{prose(20, 3)}\n{SENTENCE} {prose(70, 4)}", "en", "a", 2),
    (2, f"{prose(20, 3)}\n{SENTENCE} {prose(70, 4)}", "en", "a", 2),  # a repeated row
    (2, prose(40, 5), "de", "b", None),  # another text of the same id
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \t\n ", "en", "b", 4),
    (6, prose(12, 6), "fr", None, 70),
    (None, f"{SENTENCE} {prose(25, 7)}", "fr", "c", 9),
    (None, None, None, "c", None),
    (7, prose(30_000, 8), "es", "a", 9),  # long
    (8, "x" * 200_000, "es", "c", 200_000),  # one long word
    (9, "na " * 3000, "es", "d", 9),  # one run
    (10, "é" * 60 + " 日本語 😀 " + "ab " * 40, "ja", "d", 9),
    (11, f"{prose(60, 1)} {SENTENCE} {prose(30, 2)}", "en", "a", 1),  # a copy
    (12, f"{prose(60, 1)} {SENTENCE} {prose(29, 2)} end", "en", "e", 1),  # a near copy
    (13, " " * 150_000 + "tail", "en", "e", None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties and repeated rows."""
    return spark.createDataFrame(ROWS, DOCUMENTS).repartition(3).persist()


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with more columns, of names that operators use."""
    from pyspark.sql import functions as F

    return odd.withColumns({c: F.lit("mine") for c in CLASHES})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 0), (2, 1), (None, 1), (4, None), (7, 0), (6, 1), (6, 0), (99, 1)], "doc_id long, toxic int")


@pytest.fixture
def folder(odd, labels, tmp_path):
    """A folder of tables with the odd documents."""
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)
