import pytest

from pyspark.sql import functions as F, types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """`documents((doc_id, text), ...)` as the documents table, with extra columns whose names clash with inner ones."""

    def make(*rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCS)
        if extra:
            for name in ("rep", "component", "key", "spans", "score", "label", "row", "length", "block", "file", "n_words"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return make


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], DOCS)


#: Nulls, blanks, odd white space, one word, repeated rows, ties, a null id, odd characters, and a very long text.
ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one"), (5, "one"), (6, "a b"), (None, "a b"), (7, "A b"),
    (8, "  two  blanks \n\n and lines\n"), (9, "日本 語 😀 é   \x85 \x1c x"), (10, "<|endoftext|> </s> <s> ▁ ▁▁ <0x0A> \x00"),
    (11, "word " * 30_000), (12, "x" * 100_000), (13, "word " * 30_000), (14, "end\x00of"), (15, "123  456.789 it's we'll I'M"),
]


def by_id(df, *columns):
    """Rows as tuples, sorted, of the columns named or all."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


LONG = T.LongType()
