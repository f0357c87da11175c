import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, slot int, target string, score string, "
    "label int, part int, kind string, row int, doc string, fp string, root int, key string, count int, body string"
)


def document(doc_id, text, source="s"):
    """A row with every extra column that an operator might use itself."""
    return (doc_id, text, "en", source, None, 7, "x", 1, "t", "s", 3, 4, "k", 5, "d", "f", 6, "key", 8, "b")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, ties, repeated rows, strange characters, clashing columns."""
    words = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        document(1, "the quick brown fox jumps over the lazy dog and runs far away from it all"),
        document(2, "the quick brown fox jumps over the lazy dog and runs far away from it all", None),
        document(2, "the quick brown fox jumps over the lazy dog and runs far away from it all", None),
        document(3, None),
        document(4, ""),
        document(5, " \t\n "),
        document(6, words, "long"),
        document(7, "one"),
        document(8, "nul \x00 and emoji \U0001f600 é ß   end" * 3, "ü"),
        document(None, "a text without an id that is quite long enough to be of use to any operator here", "s"),
        document(None, "another text without an id, of another length, that differs from the one before it", None),
        document(None, None, None),
        document(9, "x" * 5000),
        document(10, "same same same same same same same same same same same same same same same same"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_documents(spark, odd_documents):
    return spark.createDataFrame([], odd_documents.schema)


@pytest.fixture(scope="session")
def duck():
    from checks import runner

    con = runner.connect("/root/testdata/sf0.01")
    yield con
    con.close()
