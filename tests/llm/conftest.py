import pytest

from eventcraft.session import ship_package

LONG = "wordy " * 40_000


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def ugly(spark):
    """Nulls everywhere, empty and long texts, repeated rows and ids, clashing extra columns."""
    same = "the same text of a few more than five words, twice"
    rows = [
        (1, same, "en", "a", 1, 5, "x"), (2, same, "en", "a", 2, 6, None),
        (3, None, None, None, None, None, None), (4, "", "en", "b", 0, 0, ""),
        (5, " \t\n ", "en", "b", 4, 0, ""), (6, "...!!! 123", None, "b", 9, 0, ""),
        (7, LONG, "en", "c", len(LONG), 0, "y"), (7, LONG, "en", "c", len(LONG), 0, "y"),
        (8, "x" * 60_000, "de", "c", 60_000, 0, "y"), (8, "another text under this id", "de", "c",
                                                      26, 0, "y"),
        (None, "a row without an id has these words", "fr", "d", 1, 1, "z"),
        (None, None, None, None, None, None, None),
        (9, "Écrire à jean.dupont@mail.example.fr ou +33 6 12 34 56 78 99, 4111 1111 1111 1111",
         "fr", "d", 3, 1, "z"),
    ]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "start bigint, kept string")


@pytest.fixture(scope="session")
def empty(ugly):
    return ugly.where("false")
