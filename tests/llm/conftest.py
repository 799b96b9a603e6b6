import pytest

EDGE = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, component_id long, removed_id long, _gone string, slot long, hash string, key string, part int, joined_id long"


@pytest.fixture(scope="session")
def edge(spark):
    """Null ids, texts and sources, blank and very long texts, repeated rows, columns whose names results use too."""
    long_text = " ".join(f"word{k % 977}x{k}" for k in range(30_000))
    rows = [
        (1, None, "en", "a", None, 7, 0.5, 9), (2, "", "en", None, 0, 7, 0.5, 9), (3, " \t\n ", None, "b", 4, 7, 0.5, 9), (4, long_text, "en", "a", len(long_text), 7, 0.5, 9),
        (5, "the cat sat on the mat and looked at the dog.\nthe cat sat on the mat and looked at the dog.", "en", "a", 91, 7, 0.5, 9), (6, "the cat sat on the mat and looked at the dog.", "en", "b", 45, 7, 0.5, 9),
        (6, "the cat sat on the mat and looked at the dog.", "en", "b", 45, 7, 0.5, 9), (None, "no id at all here in this row", "fr", "c", 29, 7, 0.5, 9), (8, "one", "en", "c", 3, 7, 0.5, 9), (9, "12345 678", "de", "c", 9, 7, 0.5, 9),
    ]
    return spark.createDataFrame([(*r, 1, "g", 2, "h", "k", 3, 4) for r in rows], EDGE)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], EDGE)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
