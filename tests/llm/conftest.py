import random

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text) with the awkward cases, and clashing extra columns."""
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "and", "ñandú", "épée", "x1", "42", "Zeta"]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))

    base = prose(300)
    rows = [(0, None), (1, ""), (2, "   \n"), (3, "one"), (4, "one two"), (5, base), (6, base),
            (7, base.replace("alpha", "alphas", 1)), (8, base + " tail"), (9, "one two"), (None, base), (None, None),
            (10, "long " * 700_000), (10, "long " * 700_000), (11, prose(50)), (11, prose(50)), (12, "\u0000 　 ퟿")]
    rows += [(i, prose(rng.randrange(1, 400))) for i in range(20, 60)]
    return rows


CLASHING = ("n", "start", "token", "key", "unit", "rid", "kind", "score", "row", "all", "s", "_key", "component", "items")


@pytest.fixture(scope="session")
def docs(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
