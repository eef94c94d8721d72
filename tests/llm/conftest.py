from __future__ import annotations

import pytest

SMALLEST = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside; as extra columns of the input they must not disturb.
CLASHES = ("data", "node", "score", "spans", "tie", "line", "new_text", "share_left", "run_spans", "toxic_score", "gone_id", "found_values", "row", "code", "words")


@pytest.fixture(scope="session")
def folder() -> str:
    return SMALLEST


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([(*r, None, None, None)[:5] if len(r) < 5 else r for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def clashing(make_docs):
    """Odd rows: nulls everywhere, an empty text, one very long text, repeated rows, clashing columns."""
    from pyspark.sql import functions as F

    long_text = "\n".join(" ".join(f"w{(i * 7 + j) % 997}" for j in range(30)) for i in range(2000))
    same = "one two three four five six seven\neight nine ten"
    rows = [(None, None), (1, None), (2, ""), (3, long_text), (4, same), (4, same), (5, same), (6, "  \n \n"), (None, same)]
    docs = make_docs(rows)
    for name in CLASHES:
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    return docs
