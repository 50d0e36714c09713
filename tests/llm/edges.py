"""Fixtures of the tests in this folder."""
import pytest

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

#: Columns whose names the operators use inside; they must pass by untouched.
CLASH = "id string, h string, k string, block string, chunk string, unit string, size string, target string, _row string, key string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with nulls in any column, empty and very long texts, repeated rows and clashing extra columns."""
    long_text = " ".join(f"the word{i % 977} of it" for i in range(60_000))
    rows = [
        (1, "Plain words stand here, and more of them follow after that.", "en", "a"),
        (2, None, "en", "a"),
        (3, "", "en", "b"),
        (4, " \t\n ", None, "b"),
        (5, long_text, "en", None),
        (6, "Plain words stand here, and more of them follow after that.", "en", "b"),
        (7, "Plain words stand here, and more of them follow after that.", "en", "b"),
        (7, "Plain words stand here, and more of them follow after that.", "en", "b"),
        (7, "quite another text under the same id, released under the MIT License", "de", "c"),
        (None, "no id at all but some words to read", "en", "a"),
        (None, None, None, None),
        (8, "l'été à Paris ☃ 漢字", None, "c"),
        (9, "\x00\x02 control \x03 characters \ud7ff here", "en", ""),
        (10, "1234 5678 !!", "fr", "c"),
    ]
    full = [(i, t, lang, s, None if t is None else len(t), *["x"] * 10) for i, t, lang, s in rows]
    return spark.createDataFrame(full, f"{DOCS}, {CLASH}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], f"{DOCS}, {CLASH}")
