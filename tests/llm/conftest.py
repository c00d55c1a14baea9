import pytest
from pyspark.sql import functions as F

# Every table gets columns whose names the operators use inside or return.
CLASHING = {"score": 7.5, "spans": "s", "_row": 1, "length": 3, "offset": 9, "node": "n", "list": 2, "matches": "m"}


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows) of (doc_id, text), with clashing extra columns."""

    def make(rows, lang="en", source="s"):
        df = spark.createDataFrame(
            [(*r[:2], *(r[2:] or (lang, source))) for r in rows], "doc_id bigint, text string, lang string, source string"
        )
        return df.withColumns({k: F.lit(v) for k, v in CLASHING.items()})

    return make


@pytest.fixture(scope="session")
def awkward():
    """Null, empty, blank, very long and repeated texts; null and repeated ids."""
    long = "abc déf " * 40_000
    return [(1, None), (2, ""), (3, "  \n\t "), (4, long), (5, "x" * 300_000), (None, "no id"), (7, "same row"), (7, "same row"), (8, None), (9, "日本 ... 123")]
