import os

import pytest

SF = "/root/testdata/sf0.001"
VOCABULARY = None
try:
    import public_tokenizers

    VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
except ModuleNotFoundError:
    pass


def pytest_collection_modifyitems(items):
    for item in items:
        if "sf_dir" in getattr(item, "fixturenames", ()) and not os.path.isdir(SF):
            item.add_marker(pytest.mark.skip(reason="the given tables are not here"))


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def vocabulary():
    if VOCABULARY is None:
        pytest.skip("no vocabulary file here")
    return VOCABULARY


PROSE = "The quick brown fox jumps over the lazy dog and runs far away into the deep green forest tonight"
SCHEMA = "doc_id bigint, text string, lang string, n_chars bigint, digest string, keep_id int, component string, key string"
CASES = [
    (1, PROSE, "en"),
    (2, None, "en"),
    (3, "", None),
    (4, " \n\t ", "en"),
    (5, ("lorem ipsum dolor " * 40 + "\n") * 60, "la"),
    (6, PROSE.replace(" ", "  \n"), "en"),
    (7, PROSE.replace("tonight", "today"), "en"),
    (7, PROSE.replace("tonight", "today"), "en"),
    (8, "x" * 30_000, "en"),
    (9, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and <|endoftext|> é 日本', "en"),
    (10, "word", "en"),
    (11, "word", "en"),
    (None, PROSE, "en"),
    (None, "an orphan of its own", None),
]


@pytest.fixture(scope="session")
def cases(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns named like the operators' own."""
    rows = [(i, t, lang, None if t is None else len(t), "extra", 5, None, "k") for i, t, lang in CASES]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
