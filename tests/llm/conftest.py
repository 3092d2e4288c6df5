import pytest

#: doc_id, text, lang, source, n_chars and columns whose names clash with results or helpers.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_tokens string, kept string, "
          "node string, key string, size string, spans string, score string, shard string, `ids` string, __x map<string,int>")


@pytest.fixture(scope="session")
def table(spark):
    """A documents table of (doc_id, text[, lang, source]) rows with clashing columns."""
    def make(rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, *[None] * (4 - len(r)))
            full.append((doc_id, text, lang, source, len(text or ""), "a", "b", "c", "d", "e", "f", "g", "h", "i", {"z": 1}))
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty and long texts, repeated rows."""
    return [(None, None), (None, "x"), (1, None), (2, ""), (3, " "), (4, "word"), (4, "word"), (5, "\n\t "),
            (6, "long " * 60_000), (7, "y" * 70_000), (8, "漢字 \U0001f600 é ▁ \x00")]
