import pytest

#: Nulls, empty and very long texts, ties, repeated rows, columns that clash with the operators' own names.
LONG = " ".join(f"w{i % 977} v{i % 331}." + ("\n" if i % 40 == 0 else "") for i in range(120_000))
EDGES = [
    (1, "", "en", "a"), (2, None, "en", "a"), (3, "one", "fr", None), (4, "one", None, None),
    (5, "one two three", "de", "b"), (5, "one two three", "de", "b"), (6, LONG, "en", "b"),
    (7, "A shared line of text\nand another one here", "en", "c"), (8, "a shared LINE of text \n\n\nother", "en", "c"),
    (9, "123 456 --- !!!", "en", "d"), (None, "A shared line of text", None, None), (10, "é中🙂 x\x00y   z\r\n", "fr", "é"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def edges(spark):
    df = spark.createDataFrame(EDGES, SCHEMA)
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(
        ("size", "row", "lost", "n_lines", "copies", "score", "block", "linked", "component", "at", "n", "gone_id", "key"))])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
