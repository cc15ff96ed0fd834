import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " row long, kept boolean, size string, _row string, place int, start string"
)
LONG = " ".join(f"w{i % 977}x{i % 61}" for i in range(60_000))
PASSAGE = "the quick brown fox jumps over one lazy dog and then it sleeps well all day long"


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeats, clashing names."""
    texts = {
        1: "same text\nhere and there",
        2: "same  text here\nand there",
        3: "sametexthereandthere ",
        4: None,
        5: "",
        6: " \t\n",
        7: LONG,
        8: LONG,
        9: LONG + " end",
        10: PASSAGE,
        11: PASSAGE.upper(),
        12: PASSAGE + " again",
        13: "Straße ÉTÉ niño 漢字 😀",
        14: "12 34 !!",
        15: "a\n\nb a\na b",
        16: "one two three four",
        17: "ONE two three FOUR",
    }
    rows = [
        (i, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "S"][i % 4], len(t or ""))
        for i, t in texts.items()
    ]
    rows += [rows[0], rows[0], rows[3], (None, PASSAGE, None, None, None), (None, None, None, None, None)]
    clash = (7, True, "x", "y", 3, "z")
    return [r + clash for r in rows]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """The odd rows as a stored table."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(odd_rows(), SCHEMA).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
