"""Fixtures of the training-data operators: odd rows and brute-force helpers."""

import random

import pytest
from pyspark.sql import DataFrame, SparkSession

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, k long, key string, n int, hash string, "
          "row string, spans string, fp string, root string, a string, word string, name string")


def odd_rows() -> list[tuple]:
    """Texts with nulls, empties, repeats, ties, one long text and columns whose names the operators use inside."""
    rnd = random.Random(7)
    words = [f"{a}{b}" for a in ("ba", "co", "di", "fu", "ge") for b in ("la", "mo", "ni", "ro", "st", "ve")]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage = say(70)
    block = "\n".join(say(9) for _ in range(12))
    texts = [(1, say(40)), (2, passage + " " + say(30)), (3, say(25) + " " + passage), (4, block), (5, block + "\nmore " + say(5)),
             (6, ""), (7, None), (8, "   \n\t "), (9, "one"), (10, "One  TWO"), (None, say(12)), (None, None), (11, passage),
             (11, passage), (12, "be " * 400), (13, "be " * 300), (14, say(3000)), (15, "é ü ß " * 60), (16, "x" * 450)]
    return [(i, t, "en" if (i or 0) % 3 else None, "src0", None if t is None else len(t),
             5, "key", 1, "h", "r", "s", "f", "o", "a", "w", "m") for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
