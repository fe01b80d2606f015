import pytest

SF = "/root/testdata/sf0.01"
CLASHING = "score string, kept string, digest string, n_words string, held_out string, tree string, shard string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, wordless, very long and repeated texts, null ids, and columns named like results."""
    long_text = "Der der die ungö chäer eingesch als ensttz zu chpfzu und die keit. " * 4000
    texts = [(1, "The cat sat on the mat. It was a good day for the cat and the dog of the house."), (2, None), (3, ""), (4, " \n\t "),
             (5, "1234 !!"), (6, long_text), (7, "x" * 30_000), (8, "The cat sat on the mat. It was a good day for the cat and the dog of the house."),
             (8, "The cat sat on the mat. It was a good day for the cat and the dog of the house."), (None, "null id"), (None, None),
             (9, "Straße ïé \U0001F642 日本語 \x00 end"), (10, "one"), (11, "one")]
    rows = [(i, t, None if i == 1 else "en", "s", *(["x"] * 7)) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + CLASHING)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
