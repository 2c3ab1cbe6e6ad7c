import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def docs_of(spark):
    """Rows (doc_id, text[, source]) as a documents table in a few partitions."""
    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)
    return make


#: Nulls in the id, the text and both, an empty text, white space alone, repeated rows and ids.
ODD_ROWS = [(1, "The cat sat on the mat and the dog sat on the rug.", "a"), (2, None, None), (3, "", "b"),
            (None, "A text without an id.", "c"), (None, None, None), (4, " \n\t ", "a"),
            (5, "Twice the same row.", "b"), (5, "Twice the same row.", "b"), (6, "Twice  the same row. ", None),
            (7, "x" * 50_000, "a"), (8, "wörd " * 3000, "z"), (8, "another text of id eight", "z")]


@pytest.fixture()
def odd_docs(docs_of):
    return docs_of(ODD_ROWS)


@pytest.fixture()
def clashing(odd_docs):
    """Extra columns named like those the operators make themselves."""
    from pyspark.sql import functions as F
    names = ["score", "row", "digest", "kept", "size", "taken", "print", "bucket", "key", "data", "start", "order",
             "id", "normal", "component_id", "word", "tokens", "rule", "verdict", "host", "path", "arrival", "_id"]
    return odd_docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
