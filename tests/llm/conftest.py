import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id int, text_id string, __digest string, row long, copy string, value string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and names that operators use themselves."""
    words = " ".join(f"word{i % 977}x{i % 31}" for i in range(20_000))
    texts = [
        None, "", " \n\t ", "a", "one two three", "the same text of some words here", "the same text of some words here", words,
        "mail a.b@c.example.org or +1 (212) 555-0100, password = Zx81aaaBBBcc99 ok", "ü" * 5_000, "x" * 300_000, "12345",
    ]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, None if t is None else len(t), "k", i, None, "d", 7, "c", "v") for i, t in enumerate(texts)]
    rows += [rows[5], (None, "no key", "en", "s1", 6, None, None, None, None, None, None, None), (None,) * 12]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(12)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
