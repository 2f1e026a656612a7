import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, k string, t string, fp string, hash string, component string"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (doc_id, text[, lang, source]) as a documents table with further columns of clashing names."""

    def make(rows, partitions=3):
        full = [(i, t, *(rest or ("en", "src0")), len(t or ""), "k", "t", "fp", "h", "c") for i, t, *rest in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd():
    """Texts that every operator must take: null, empty, blank, one word, signs, many scripts, very long, and repeats."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "word"), (5, "!!! ... 123"), (6, "日本語 中文 ελληνικά עברית 🙂"), (7, long), (8, "x" * 300_000), (9, "same text here again and again"), (10, "same text here again and again"), (10, "same text here again and again"), (None, "no key"), (11, "\x00\x1c odd   signs")]
