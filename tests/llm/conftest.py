import pytest
from pyspark.sql import Row

ODD = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, fp string, label string, node string, _mark string, keep string"
SEA = "the boat went over the sea and the wind was in the sails all day long until night"
HILL = "der hund lief ueber den berg und die katze schlief im haus neben dem alten baum"


def row(i, text, lang="en", source="a"):
    return (i, text, lang, source, None if text is None else len(text), "x", "x", "x", "x", "x", "x", "x")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and very long texts, ties,
    repeated rows and extra columns whose names the operators use inside."""
    rows = [row(1, SEA), row(1, SEA), row(2, SEA), row(3, None), row(4, ""), row(5, " \t\n"), row(6, "123 !! 456"),
            row(7, SEA + " " + HILL, None, None), row(8, HILL, "de", "b"), row(9, HILL.upper(), "de", "b"), row(10, "x", "en", "c"),
            row(None, "no id at all here", "en", "c"), row(11, "word " * 60_000, "en", "c"), row(12, "é ü ñ", "fr", "d"),
            row(13, SEA + " idiot", "en", "a"), (14, None, None, None, None) + (None,) * 7]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, q, t, "x") for i, q, t in [(1, 1, 0), (1, 1, 0), (2, 1, 0), (7, 1, 0), (8, None, 0), (9, 0, None),
                                  (10, 0, 0), (13, 0, 1), (None, 1, 1), (99, 1, 1)]], "doc_id long, quality int, toxic int, text string")
