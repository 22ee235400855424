import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, block string, tail int"
WORDS = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x" for i in range(400)]


def passage(start: int, count: int) -> str:
    return " ".join(WORDS[(start + i * 7) % 400] for i in range(count))


@pytest.fixture(scope="session")
def rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, names that clash."""
    shared = passage(3, 40)
    texts = [
        passage(0, 60), passage(0, 60), passage(0, 60) + " end", "", None, " \t\n ", "one", "same " * 90,
        passage(11, 30) + "\n" + shared + "\n" + passage(50, 30), passage(90, 10) + "\n" + shared, shared,
        passage(5, 3000), "Ünïcode ñandú. Straße, éa " * 8, "a, b. c... d e <|endoftext|> 3.5\r\n", "HELLO World. THE END",
    ]
    out = [(i, t, ["en", "de", None][i % 3], "s", None if t is None else len(t), 0.5, "b", 1) for i, t in enumerate(texts)]
    return out + [out[0], (None, passage(0, 60), None, None, None, None, None, None), (40, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
