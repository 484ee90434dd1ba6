import pytest

TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two three four. "),
    (6, "The same line of several plain words here.\nA line of its own with other words in it."),
    (7, "The same line of several plain words here.\nAnother ending that nobody else has written down."),
    (7, "The same line of several plain words here.\nAnother ending that nobody else has written down."),
    (None, "No id but some words that end well, as they should."),
    (None, None), (9, "x" * 70_000), (10, "ab " * 9_000 + "end."), (11, "ÄÖ ü　é \U0001F600 <|endoftext|> z"),
    (12, "menu | home | about | contact\nclick here to read more"), (13, "##### $$$ %%% &&& ***\n" * 6),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, clashing columns."""
    rows = [(i, t, "de", None, 5, 1, "k") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "`key` int, `_doc` string")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
