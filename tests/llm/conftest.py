import random

import pytest


@pytest.fixture(scope="session")
def docs_rows():
    """(doc_id, text): copies, shared passages, nulls, empties, repeats and a long text."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    base = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            b = rng.choice(base)
            a = rng.randint(0, len(b) - 1)
            parts.append(b[a : a + rng.randint(1, 250)])
            parts.append(" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))))
        text = "\n".join(parts)
        rows.append((i, text))
    rows += [(200, None), (201, ""), (202, " \t\n"), (None, base[0]), (None, base[0]), (203, "ab" * 300), (204, "x" * 120)]
    rows += [(205, " ".join(base) * 30), rows[5], rows[5], (7, base[3])]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, docs_rows):
    """The rows, with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(docs_rows, "doc_id long, text string").repartition(3)
    extra = ("id", "part", "score", "kept", "n_words", "fp", "key", "rest", "bucket", "start")
    return df.select("doc_id", "text", *(F.lit(1).alias(c) for c in extra)).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
