import pytest

#: Names that the operators use inside: an input may have columns of these names too.
CLASHING = "label long, score string, node string, size string, shard string, part string, x string, n string, ids string, row string"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table, with columns of clashing names, from (doc_id, text, lang, source)."""

    def make(rows):
        extra = (7, "s", "n", "z", "h", "p", "x", "9", "i", "r")
        full = [(i, t, lang, src, None if t is None else len(t), *extra) for i, t, lang, src in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")

    return make


LONG = " ".join(f"word{i % 977} of{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def awkward(documents):
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows."""
    return documents([
        (1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "en", "a"), (4, "one two", "en", None), (5, "one two", "de", "b"),
        (None, "a text without an id but with a few words", "en", "a"), (None, None, None, None), (6, LONG, "en", "a"),
        (7, "same row", "en", "a"), (7, "same row", "en", "a"), (8, "same id one", "en", "a"), (8, "same id two", "en", "a"),
        (9, "ünï çødé 中文 😀 \x0b vertical", "fr", "c"), (10, "<|endoftext|> a|b #### <x>", "en", "a")])


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])
