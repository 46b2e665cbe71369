import pytest

WORDS = [a + b for a in ("al", "be", "co", "du", "en", "fi", "go", "ha") for b in ("ra", "ti", "mon", "sel", "ver", "quo", "lin", "pes")]


def prose(n: int, seed: int = 0) -> str:
    """n words in an order that repeats no five of them."""
    x, out = seed * 7919 + 1, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 16) % len(WORDS)])
    return " ".join(out)


# NULLs in every column, empty and blank texts, repeated rows, one id twice, a long text, odd characters
ODD = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n\x0b ", None),
    (None, prose(40, 1), "en"),
    (None, None, None),
    (4, prose(40, 2), "en"),
    (4, prose(40, 2), "en"),
    (5, prose(40, 2), None),
    (6, "one two", "de"),
    (6, "three four", "de"),
    (7, prose(30_000, 3), "en"),
    (8, "Ünï çóde ☃ 漢字 \U0001f600 \x00 ▁", "de"),
    (9, "...!!! ### 123", "de"),
]


@pytest.fixture
def odd(rows):
    return rows(ODD, "doc_id bigint, text string, lang string")


@pytest.fixture
def clashing(odd):
    """Extra columns named like what operators add or use inside."""
    from pyspark.sql import functions as F

    names = "kept n_lines n_dropped row drop doc t1 t2 h1 ids decoded n_tokens n_words lang_pred score member label item shingles base_failed Text2"
    return odd.select("*", *[F.lit("x").alias(n) for n in names.split()])


@pytest.fixture
def no_rows(odd):
    return odd.limit(0)
