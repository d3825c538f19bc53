import datetime as dt

import pytest

#: Columns whose names clash with those that operators make on the way.
EXTRA = "doc string, th string, pos long, node long, cell long, size long, score double, row string"


def documents(spark, rows):
    """documents rows (doc_id, text[, source]) with clashing extra columns."""
    out = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""),
            "d", "t", 1, 2, 3, 4, 0.5, "r") for r in rows]
    return spark.createDataFrame(
        out, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


EDGES = [(1, None), (2, ""), (None, "no id at all here"), (3, " \n\t "), (4, "one"),
         (5, "same words in two rows of it"), (5, "same words in two rows of it"),
         (6, "same words in two rows of it"), (7, "long " * 30_000), (8, "é漢字 ünïcode\r\nline\n\n\nend")]


@pytest.fixture(scope="session")
def edges(spark):
    return documents(spark, EDGES)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def llm_spark(spark):
    from txnlake.llm.common import ready
    return ready(spark)


NOW = dt.datetime(2024, 1, 1)
