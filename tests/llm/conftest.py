import random

import pytest

LETTERS = "abcdefghijklmnopqrstuvwxyz"


@pytest.fixture()
def words():
    """A seeded vocabulary."""
    r = random.Random(5)
    return ["".join(r.choice(LETTERS) for _ in range(r.randint(2, 9))) for _ in range(400)]


@pytest.fixture()
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, sid long, rest string, shards string, row int, token string, n long, grp long, block int"
    extra = (7, 7, "x", "y", 3, "z", 1, 2, 3)
    long = " ".join(f"word{i % 977} token" for i in range(30_000))
    rows = [
        (1, "Same text here, twice over.", "en", "a", 1),
        (2, "Same text here, twice over.", None, None, None),
        (3, None, "en", "b", 0),
        (4, "", "en", None, 0),
        (5, long, "en", "a", len(long)),
        (6, long + " end", "en", "a", 1),
        (7, "x", "en", "b", 1),
        (7, "x", "en", "b", 1),
        (8, " \t\n ", "en", "b", 1),
        (9, "é ñ ß 汉字 password=abcd1234efgh i d i o t m0r0n", "xx", "b", 1),
        (None, "no id at all in this row", "en", "c", 1),
    ]
    return spark.createDataFrame([(*r, *extra) for r in rows], schema)


@pytest.fixture()
def no_docs(odd_docs):
    return odd_docs.limit(0)
