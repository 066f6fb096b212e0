import pytest

LONG = " ".join(f"word{i % 977} und{i % 13}." for i in range(30_000))

ROWS = [
    (1, "The cat sat on the mat. It purred, idiot that it was!\nA second line.", "en"),
    (2, "The  cat\tsat on the mat. It purred, idiot that it was! A second line.", "en"),
    (3, "The cat sat on the mat. It purred, idiot that it was!\nA second line.", "en"),
    (4, None, None),
    (5, "", "en"),
    (6, "   \n\t ", None),
    (7, "Wort", "de"),
    (8, "1234 5678 !!!", "de"),
    (9, LONG, "de"),
    (10, LONG + " tail", "de"),
    (11, "Straße ÄÖÜ 中文 😀 it's we'll 'tis ﬁ é", "fr"),
    (12, "Straße ÄÖÜ 中文 😀 it's we'll 'tis ﬁ é", "fr"),
    (13, " ".join(["same"] * 500), "es"),
    (13, " ".join(["same"] * 500), "es"),
    (14, "\n".join(["a line. another one."] * 40), "en"),
    (15, "zwei Wörter", None),
]
#: Names that the operators use inside, to clash with.
EXTRA = ["n", "h", "k", "norm", "bucket", "row", "token", "node", "shard", "score", "keys", "at", "word"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, blanks, long texts, ties, repeated rows and columns with clashing names."""
    rows = [(i, t, lang, "src0", len(t or ""), *(["x"] * len(EXTRA))) for i, t, lang in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def nulls(spark):
    """Rows in which every column is null, beside one that is not."""
    rows = [(None, None, None, None, None, *([None] * len(EXTRA)))] * 2 + [(None, "some words here", None, None, None, *([None] * len(EXTRA)))]
    return spark.createDataFrame([*rows, (1, "some words here", "en", "s", 15, *(["x"] * len(EXTRA)))], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, 1, i % 2, "x") for i in range(1, 16)] + [(3, 0, None, "x"), (None, 1, 1, "x")], "doc_id long, quality int, toxic int, text string")
