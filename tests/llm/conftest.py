import pytest

#: Nulls, empty and blank texts, ties, repeated rows, long and unspaced texts.
AWKWARD = [
    (1, "the cat sat on the mat and looked at the moon all night long, it did"),
    (2, "The CAT sat on the mat and looked at the moon all night long, it did"),
    (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "one"), (8, "two words"),
    (9, "x" * 5000), (10, "word " * 3000), (11, "Ünïcödé straße 漢字 \U0001F600 don't <|endoftext|> İ ß"),
    (12, 'token = "0123456789abcdef0123456789abcdef01234567" end'), (13, "a\xa0b\x1cc\x85d"),
    (14, "the cat sat on the mat and looked at the moon all night long, it did"),
    (6, "one"), (None, "nobody's text that has no number at all but is long enough to have thirteen words in it"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with extra columns whose names clash with the operators' own."""
    rows = [(i, t, "en", f"src{n % 3}", None if t is None else len(t), n, "kept", n) for n, (i, t) in enumerate(AWKWARD)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, item int, score string, row int").repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
