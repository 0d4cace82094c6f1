import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, bucket string, score string, gram string, node string, "
          "_words string, hits string, row string, size string, part string")


def prose(n, seed, words=400):
    draw = random.Random(seed)
    names = ["w" + "".join(draw.choices("abcdefgh", k=4)) for _ in range(words)]
    return " ".join(draw.choices(names, k=n))


def documents(spark, rows):
    """Documents of (id, text), with columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), *["x"] * 9) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    """Missing ids and texts, blank and very long texts, repeated rows."""
    return [(None, "no id here at all"), (1, None), (2, ""), (3, " \n\t "), (4, prose(30_000, 1)), (5, prose(80, 2)), (5, prose(80, 2)),
            (6, "one"), (7, "été naïve 日本語 ünïcode blank\x1cmark"), (8, prose(80, 2)), (9, "Damn  <|endoftext|> it's\r\n\r\n  odd ")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return documents(spark, odd_rows)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])
