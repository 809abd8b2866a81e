import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))


#: NULLs, empty and very long texts, ties, repeated rows, non-ASCII and copies.
LONG = " ".join(f"w{i % 977} {i}" for i in range(20_000))
PASSAGE = "the quick brown fox jumps over the lazy dog while seven sly wizards vex a bold knight " * 2
TEXTS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "alpha BETA gamma delta  epsilon\nzeta eta theta iota kappa lambda mu"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one two three"),
    (7, "One two three"),
    (8, LONG),
    (9, LONG + " end"),
    (10, "début " + PASSAGE + " ñandú"),
    (11, "other start " + PASSAGE + "éé"),
    (12, "aaaa" * 100),
    (13, "aaaa" * 90),
    (14, "write to jane.doe@mail.example.com or +1 (555) 555-0101, card 4111 1111 1111 1111, from 10.0.0.1"),
    (15, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda nu"),
]


@pytest.fixture(scope="session")
def texts():
    return list(TEXTS)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The texts with a repeated row, rows without doc_id, and further columns whose names clash."""
    rows = [(i, t, "en", "s", None, "k", 1) for i, t in [*TEXTS, TEXTS[0]]]
    rows += [(None, "no id at all but some words here", "en", None, 1, None, 2), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, n int"
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
