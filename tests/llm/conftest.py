import pytest

FIELDS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, keys string, ids string, n int, _row int"


@pytest.fixture(scope="module")
def strange(spark):
    """Nulls in every column, empty and blank texts, a long one, repeated rows, equal ids, columns with clashing names."""
    plain = "The quick brown fox jumps over the lazy dog while seven bright stars watch the silent river below them tonight "
    rows = [
        (1, plain, "en", "a"),
        (2, plain, "en", "a"),
        (2, plain, "en", "a"),
        (2, plain, "en", "b"),
        (3, plain * 9 + "#", None, "b"),
        (4, "", "en", None),
        (5, None, None, ""),
        (None, plain, "en", "b"),
        (None, None, None, None),
        (6, " \n\t ", "de", "b"),
        (7, "wort " * 30000, "de", "a"),
        (8, "NO <P> MIDDLE <|endoftext|>", "en", "a"),
        (9, "a  b 　c\n\n d\x1c e 'll don't \U0001f600é" * 3, "fr", "c"),
        (10, "\U0001f600é中x" * 50, "fr", "c"),
    ]
    return spark.createDataFrame([(*r, None, 7, "k", None, 3, 1) for r in rows], FIELDS)
