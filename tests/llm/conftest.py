import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("score", T.StringType()), T.StructField("n", T.StringType()), T.StructField("found", T.StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, lang)"""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None if r[1] is None else len(r[1]), "x", None, "y")
                for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty texts, blanks, one word, a long text, repeated rows."""
    long = " ".join(f"word{k % 977}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"), (6, long), (7, long + " end"),
            (8, "Éa ö. it's\x0b12 x y"), (8, "Éa ö. it's\x0b12 x y"), (None, "no id here"), (9, "a b c"),
            (10, "A  B\nC")]
    return rows
