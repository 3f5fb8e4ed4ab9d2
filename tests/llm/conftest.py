import pytest
from pyspark.sql import DataFrame

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sp(spark):
    from stayrisk.session import ship_package

    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def documents(sp):
    """``documents`` rows from (doc_id, text) pairs, with columns whose names the operators use themselves."""

    def make(rows, extra: bool = False) -> DataFrame:
        df = sp.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
        if extra:
            from pyspark.sql import functions as F

            for c in ("block", "part", "row", "key", "fp", "node", "word", "rest", "hits", "copy_id", "again_id", "leak_id", "score", "rate"):
                df = df.withColumn(c, F.lit(c))
        return df

    return make
