import pytest

from pyspark.sql import types as T

SF = "/root/testdata/sf0.01"

LONG = " ".join(f"word{i % 977} filler{i}" for i in range(60_000))

ROWS = [
    (None, None, None, None, None),
    (1, "", "en", "a", 0),
    (1, "", "en", "a", 0),
    (2, " \n\t ", None, "b", 4),
    (3, LONG, "en", None, None),
    (3, LONG, "en", None, None),
    (4, "one two three", "en", "a", 13),
    (5, "one  two\nthree", "fr", "a", 14),
    (6, None, "fr", "c", None),
    (7, "one two three four five six seven eight nine ten", "en", "c", 48),
    (8, "one two three four five six seven eight nine ten", "en", "c", 48),
    (None, "no id here", "en", "c", 10),
    (9, "▁odd é\U0001f600 \x00 text", "en", "c", 10),
]

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: names that the operators use themselves
CLASHING = ["score", "n", "node", "digest", "size", "label", "ids", "votes", "hash", "k", "cid", "copies", "rank"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing extra columns."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def some_labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (4, 0, 1), (7, 1, None), (None, 1, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int"
    )


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def docs(spark):
    from matchlake.llm.common import documents

    return documents(spark, SF)


@pytest.fixture(scope="session")
def labels(spark):
    from matchlake.llm.common import labels

    return labels(spark, SF)
