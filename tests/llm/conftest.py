import pytest

#: Nulls, empty and blank texts, repeated rows, equal texts, a long text, and columns that clash with working names.
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(6000))
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
ROWS = [
    (1, BASE), (2, BASE), (2, BASE), (3, BASE + " end"), (4, BASE.upper()), (5, None), (6, ""), (7, " \t\n"), (8, "one"),
    (9, "one"), (None, BASE), (None, None), (10, LONG), (11, LONG + " tail"), (12, "äöü ß 字字字 " * 30), (13, "aaaa" * 200),
    (14, "Only one. " + BASE.replace("gamma", "GAMMA!") + " " + "z" * 150), (15, "z" * 150), (16, BASE.replace("mu", "MOO")),
]


@pytest.fixture(scope="session")
def rows():
    return ROWS


@pytest.fixture(scope="session")
def docs(spark):
    schema = "doc_id long, text string, tie string, kept string, node string, d string, label string, ids string"
    return spark.createDataFrame([(i, t, "a", "b", "c", "d", "e", "f") for i, t in ROWS], schema)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("doc_id < 0")
