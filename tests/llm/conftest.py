import pytest


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like the operators' own."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, component_id int, shard string, h int, fp string, n int"
    more = ("x", 1, "y", 2, "z", 3)
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, "   \n", "de", "a", 4), (None, "the cat and the dog", "en", "b", 19), (4, "12 34 !?", "en", "b", 8),
            (5, "der Hund und die Katze " * 3000, "de", "a", 69000), (6, "der Hund und die Katze", "de", "a", 22), (7, "der Hund und die Katze", "de", None, 22),
            (8, "the cat and the dog <|endoftext|> it's", "en", "c", 38), (8, "the cat and the dog <|endoftext|> it's", "en", "c", 38), (9, "é" * 400, "fr", "c", 400)]
    return spark.createDataFrame([r + more for r in rows], schema)


@pytest.fixture(scope="session")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)
