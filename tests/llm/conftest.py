import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents of (doc_id, text, lang, source) rows, with columns that operators add themselves already there."""

    def build(rows, clash=()):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        df = spark.createDataFrame([(*r[:4], None if r[1] is None else len(r[1])) for r in full], SCHEMA)
        for c in clash:
            df = df.selectExpr("*", f"'x' AS {c}")
        return df

    return build
