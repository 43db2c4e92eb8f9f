import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and columns whose names clash with the operators' own."""
    long = " ".join(f"w{i % 997}x{i % 31}" for i in range(6000))
    base = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega end of it all."
    rows = [
        (0, base), (1, base), (1, base), (2, None), (3, ""), (4, base.replace("omega", "OMEGA!")), (5, base + " More words here."), (6, long),
        (7, long + " tail"), (8, "one"), (9, "one two three"), (10, "Ünïcode ñandú 日本語 text, and  double  spaces\n\nand lines\t."), (None, "no id at all"),
        (11, "a <|endoftext|> special string"), (12, base[:60] + "x" + base[60:]),
    ]
    return spark.createDataFrame([(i, t, "src", 1, 2) for i, t in rows], "doc_id long, text string, row string, n long, v int")


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
