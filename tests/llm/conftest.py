import pytest

ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs on and on."),
    (2, "The quick brown fox jumps over the lazy dog and runs on and on."),
    (2, "The quick brown fox jumps over the lazy dog and runs on and on."),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one"),
    (7, "one"),
    (None, "a row without an id but with quite a few words in it"),
    (8, "x" * 50_000 + " " + "word " * 20_000),
    (9, "naïve café — ünïcödé 漢字 \U0001f600 don't  stop\n\nnow  "),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and very long texts, ties and repeated rows, and columns with clashing names."""
    rows = [(i, t, "en" if k % 2 else None, "src", len(t) if t else None, "x", 1) for k, (i, t) in enumerate(ODD_TEXTS)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, removed int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
