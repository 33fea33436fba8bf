from __future__ import annotations

import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeats, and clashing columns."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abdeilmnorst") for _ in range(rng.randint(2, 9)))
    prose = [" ".join(word() for _ in range(60)) + ".\n" + " ".join(word() for _ in range(40)) for _ in range(12)]
    long = " ".join(word() for _ in range(6000))
    rows = [(k, t, "en", f"s{k % 3}", len(t)) for k, t in enumerate(prose)]
    rows += [(20, prose[0], None, "s0", 1), (21, prose[1].upper(), "en", None, 2), (22, prose[2] + " one more word", "en", "", 3)]
    rows += [(23, None, "en", "s1", None), (24, "", "en", "s1", 0), (25, " \n\t ", "en", "s2", 4), (26, "two words", "en", "s2", 9)]
    rows += [(27, "two  Words", "en", "s2", 9), (28, long, "de", "s1", len(long)), (29, "x " + long, "de", "s1", 5), (None, prose[3], "en", "s0", 6)]
    rows += [(5, prose[5], "en", "s2", len(prose[5]))]  # a row twice
    frame = spark.createDataFrame(rows, COLUMNS)
    # names that the operators use inside
    return frame.selectExpr("*", "1 AS n", "'a' AS row", "2 AS node", "'b' AS key", "3 AS bucket", "4 AS size", "5 AS place", "6 AS hits")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
