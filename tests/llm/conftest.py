import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, shard int, digest string, doc string, spans int, foreign string"


@pytest.fixture
def make_docs(spark):
    """Documents with extra columns whose names the operators use inside; rows are (doc_id, text, lang, source)."""

    def make(rows):
        extra = ("r", 9, "d", "x", 4, "f")
        data = [(i, t, lang, source, len(t or ""), *extra) for i, t, lang, source in rows]
        return spark.createDataFrame(data, DOCS)

    return make


LONG = "The quick brown fox isn't lazy; 12345 jumps over   dogs.\n" * 3000


@pytest.fixture
def messy_docs(make_docs):
    """Nulls, empty and very long texts, repeated rows, repeated ids, odd scripts."""
    return make_docs(
        [
            (1, None, "en", "a"),
            (2, "", "en", None),
            (3, LONG, "en", "a"),
            (4, LONG, "en", "a"),
            (5, "Ein Haus und noch ein Haus,\n\n   steht   am See\t!", "de", "b"),
            (5, "Ein Haus und noch ein Haus,\n\n   steht   am See\t!", "de", "b"),
            (5, "gleiche Nummer, anderer Text", None, "b"),
            (None, "no id at all, but a text of some words", "en", "c"),
            (None, "no id at all, but a text of some words", "en", "c"),
            (6, "<|endoftext|> <|ENDOFTEXT|> don't DON'T we'll 3.14 ½ ² ª", None, "b"),
            (7, "ＦＵＬＬ   J̌ ǰ ǰ İstanbul Σίσυφος ΣΑΣ 漢字 😀😀 é é \x1c\x1d", "xx", None),
            (8, "12345 67890 !!! ???", "en", "b"),
            (9, " \n \t \n", "en", "a"),
        ]
    )
