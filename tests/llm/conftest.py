import random

import pytest

EXTRA = "bucket role key id hash size label score n cid sig at own gone_0 of_0 rate_0 x y".split()


def frame(spark, rows, lang=False):
    """Rows (doc_id, text, source?) with extra columns whose names operators use inside."""
    full = [(*(r + ("s",) * (3 - len(r))), *(["z"] * len(EXTRA))) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in EXTRA))


def sentence(seed, n):
    rng = random.Random(seed)
    syllables = "ka lo mi ren tu vas por ith ola nem sur del quo bin far wex".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and blank texts, repeated rows, ties, accents, one word, a long text, a null id."""
    long = sentence(99, 30_000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "Été übung"), (5, "Été übung"), (7, sentence(1, 40)), (8, sentence(1, 40)), (9, long), (None, "no id here at all"), (11, "no id here at all"), (12, "😀" * 50)]
    return rows, frame(spark, rows)
