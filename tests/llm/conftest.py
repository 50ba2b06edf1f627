import pytest

ODD = "doc_id long, text string, k1 string, places string, node string, n_chars long, `a b` int"


@pytest.fixture
def odd_rows(spark):
    """Builds documents with more columns, some named as operators name their own."""

    def build(rows):
        return spark.createDataFrame([(i, t, "x", "y", None, None if t is None else len(t), 7) for i, t in rows], ODD)

    return build
