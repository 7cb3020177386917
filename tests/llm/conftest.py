import pytest

DOCS = "doc_id long, text string, th string, id int, pos int"


@pytest.fixture(scope="session")
def make(spark):
    """Documents with columns whose names the operators use themselves."""
    def build(rows):
        return spark.createDataFrame([(i, t, "x", 7, 3) for i, t in rows], DOCS)
    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and white texts, ties, repeats, one long text."""
    line = "The quick brown fox jumps over the lazy dog near the old river bank today"
    long = "\n".join(f"line {i} of a very long text with word{i % 977} and more" for i in range(20_000))
    return [(1, None), (2, ""), (3, "   \n\t\n"), (4, line), (5, line), (5, line), (6, line.upper()),
            (7, line + "\n" + line), (None, "an id is missing here"), (8, long), (9, "one"), (9, "two words")]
