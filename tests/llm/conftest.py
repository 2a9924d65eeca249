import pytest

#: Nulls, empty and blank texts, repeated rows, ties, accents, and a column that clashes with names used inside.
ROWS = [
    (1, "The cat sat on the mat and the dog sat on the log", "en", "x"),
    (1, "The cat sat on the mat and the dog sat on the log", "en", "x"),
    (2, None, "en", None),
    (3, "", None, "x"),
    (4, " \n\t ", "fr", "x"),
    (5, "été où ça n’est-ce pas? L'été\nété où", "fr", "y"),
    (None, "no id here at all but some words", "en", "y"),
    (6, "### 12345 !!! ---", "en", "y"),
    (7, "the the the the the the the", "en", "x"),
    (8, "one", "en", "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture()
def docs(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(ROWS, SCHEMA)
    for clash in ("key", "size", "n", "node", "shard", "tokens", "letters", "digest", "body", "spans"):
        frame = frame.withColumn(clash, F.lit("clash"))
    return frame


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def by_key(frame, *columns):
    """Rows as sorted tuples, with nulls first."""
    rows = [tuple(r) for r in (frame.select(*columns) if columns else frame).collect()]
    return sorted(rows, key=lambda r: tuple((x is not None, str(type(x)), x if not isinstance(x, bool) else int(x)) if not isinstance(x, list) else (True, "list", str(x)) for x in r))
