import pytest

#: Names that operators use inside, as columns of the input.
CLASHING = ("row size kept key h norm prefix salt place group bin open component_id position target nth start path part").split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, copies in other letters, odd characters."""
    long = "word " * 30_000 + "x" * 40_000
    prose = "The end of the long day was near and all the people of the town went home to rest, as they did. "
    rows = [
        (1, prose * 3, "a"),
        (2, prose.upper() * 3, "a"),
        (3, prose * 3, None),
        (3, prose * 3, None),
        (4, "", "b"),
        (5, None, "b"),
        (6, " \t\n", "b"),
        (7, long, "é"),
        (8, long + " tail", "é"),
        (9, "Ärger İst ΣΑΣ 日本語　text \x00 \x1c end", "zz"),
        (10, "<|endoftext|> a <|endoftext|>", "zz"),
        (None, "no id here", "b"),
        (None, None, None),
        (12, "one", "b"),
        (13, "One", "b"),
        (14, "%%% &&& ### " * 40, "junk"),
        (15, "again " * 200, "junk"),
        (-5, prose * 2 + "and then more " * 4, "a"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    full = [(i, t, "en", s, None if t is None else len(t), *CLASHING) for i, t, s in odd_rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
