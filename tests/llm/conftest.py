import pytest

CLASHING = ("row", "k1", "n", "lines", "print", "size", "at", "key", "spots", "grp", "w", "gone", "batch", "root")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)

PROSE = "the quick brown fox jumps over the lazy dog while nobody in the small town looks at it for long because rain falls"


def rows(texts):
    """Document rows for (doc_id, text, lang, source)."""
    return [(i, t, lang, source, None if t is None else len(t), *[c.upper() for c in CLASHING]) for i, t, lang, source in texts]


def odd():
    """Nulls in every column, empty and blank and very long texts, repeated rows, and rows that share a doc_id."""
    long = " ".join(f"word{k % 977} and{k}" for k in range(30_000))
    texts = [
        (1, PROSE, "en", "a"), (1, PROSE, "en", "a"), (1, PROSE + " again", "en", "b"), (2, None, "en", "a"), (3, "", None, "a"), (4, " \t\n\v\f\r ", "en", None),
        (None, PROSE, None, None), (None, None, None, None), (5, long, "en", "a"), (6, "one", "de", "c"), (7, "Über\nÜber\n\nÜber", "de", "c"), (8, "\x00 \u2028 ſK İ", "de", "c"),
    ]
    return rows(texts)


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A document table of (doc_id, text) pairs."""

    def make(texts):
        return spark.createDataFrame(rows([(i, t, "en", "a") for i, t in texts]), SCHEMA)

    return make
