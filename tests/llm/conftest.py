import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, words=400):
    vocabulary = [f"w{k}x{k % 7}" for k in range(words)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def awkward_rows():
    """Nulls, empty, white space, very long texts, ties, repeated rows, near copies, shared passages."""
    rng = random.Random(11)
    passage = prose(rng, 40)
    base = prose(rng, 120)
    rows = [
        (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \t\n", "en", "a", 3), (4, "one two", "en", "b", 7),
        (5, "One  TWO", "en", "b", 8), (6, base, "de", "a", 1), (7, base, "de", "c", 1), (8, base.upper(), "de", None, 1),
    ]
    for k in range(9, 30):
        words = base.split()
        for _ in range(rng.randrange(0, 12)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(1000)}"
        rows.append((k, " ".join(words), "en", rng.choice("abc"), 1))
    for k in range(30, 40):
        rows.append((k, f"{prose(rng, rng.randrange(1, 90))} {passage} {prose(rng, 30)}", "en", "a", 1))
    rows.append((40, prose(rng, 60_000, 5000), "en", "d", 1))
    rows.append((41, "x" * 20_000 + " é日本 " + prose(rng, 20), "fr", "d", 1))
    for k in range(42, 60):
        rows.append((k, prose(rng, rng.randrange(0, 200)), "en", rng.choice("abcd"), 1))
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward rows with extra columns whose names the operators use themselves."""
    return spark.createDataFrame(awkward_rows(), SCHEMA).selectExpr(
        "*", "1 as id", "2 as key", "'x' as bucket", "3 as size", "4 as sig", "5 as score", "6 as keep_id", "7 as epochs", "8 as name"
    )


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
