import pytest

NASTY = "zeta eta theta iota kappa lambda mu nu xi omicron pi rho"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows, and a clashing extra column."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 1.0),
        (2, None, "en", "a", 2.0),
        (3, "", None, "b", None),
        (4, "  \n\t ", "de", None, 4.0),
        (5, long, "en", "a", 5.0),
        (6, "!!! ... ???", "fr", "a", 6.0),
        (7, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 7.0),
        (7, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 7.0),
        (8, "two words", "es", "a", 8.0),
        (9, "two words", "es", "a", 9.0),
        (10, f"before {NASTY} after and then some more text", "en", "a", 10.0),
        (None, "a row without an id but with some words in it", "en", "a", 11.0),
        (11, long + " tail", "en", "a", 12.0),
        (12, "Été à l'œil ñandú straße 漢字 🙂 <|endoftext|> don't", "fr", "a", 13.0),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
