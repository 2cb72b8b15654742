import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from texts or (id, text) or (id, text, source), with columns whose names the
    operators use inside."""

    def make(items, extra=True):
        rows = []
        for i, x in enumerate(items):
            x = x if isinstance(x, tuple) else (i, x)
            rows.append((x[0], x[1], None, x[2] if len(x) > 2 else "s", None))
        df = spark.createDataFrame(rows, DOCS)
        if extra:
            for name in ("id", "fp", "size", "rep", "score", "key", "h", "label", "copies", "hash", "cell", "u", "first"):
                from pyspark.sql import functions as F

                df = df.withColumn(name, F.lit("x"))
        return df

    return make
