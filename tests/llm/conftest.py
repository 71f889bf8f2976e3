import pytest

from pressmill.llm import catalog


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    kinds = (
        "doc_id long, text string, lang string, source string, n_chars long, "
        "key string, row int, rank_ long, score double, task string, prediction int"
    )
    long = " ".join(f"word{i % 977} and" for i in range(30_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. Again and again."),
        (1, "The quick brown fox jumps over the lazy dog. Again and again."),
        (1, "Another text under one id."),
        (None, "No id here at all, but some words."),
        (None, None),
        (2, None),
        (3, ""),
        (4, " \n\n \t"),
        (5, long),
        (6, "tiny"),
        (7, "ends in a line break\n"),
        (8, "\U0001f600 ñ ß Σ ΑΣ \x00 \x1c <|endoftext|> <|im_end|>"),
        (9, "a" * 50_000),
        (10, "mail x@y.org and +1 (988) 555-2485"),
    ]
    full = [(i, t, None, None, None, "k", 1, 2, 3.0, "t", 4) for i, t in rows]
    return spark.createDataFrame(full, kinds).repartition(3)


@pytest.fixture(scope="session")
def queries():
    return catalog.QUERIES
