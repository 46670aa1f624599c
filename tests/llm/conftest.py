import pytest
from pyspark.sql import Row


@pytest.fixture(scope="session")
def documents(spark):
    """Edge rows: nulls, blanks, copies, near copies, repeats, a long text; with a clashing extra column."""
    base = " ".join(f"word{k} and" for k in range(60)) + "."
    near = base.replace("word7 ", "changed ")
    long = " ".join(f"long{k % 7001}x" for k in range(20_000))
    rows = [
        (1, base, "a"), (2, base, "a"), (3, near, "b"), (4, None, "a"), (5, "", None), (6, " \n\t ", "b"), (7, "one two", "b"), (8, "One TWO", None), (9, long, "c"), (None, "null id has a text of its own here", "c"),
        (10, "é\x85è ü", "c"), (10, "é\x85è ü", "c"), (11, "a b c d e", "a"), (12, "a b c d e f", "a"),
    ]
    return spark.createDataFrame([Row(doc_id=i, text=t, source=s, node=k, n=k, key="k", count=1) for k, (i, t, s) in enumerate(rows)], "doc_id long, text string, source string, node long, n long, key string, count long")


@pytest.fixture(scope="session")
def empty(documents):
    return documents.where("false")
