import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, ref string, places long"


@pytest.fixture(scope="session")
def table(spark):
    """Documents with extra columns whose names the operators use inside."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t), "r", "k", None, 7) for i, t in rows], SCHEMA)
    return make


def words(n, seed):
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


BASE = words(120, 1)
PASSAGE = words(60, 2)
EDGE_ROWS = [
    (0, BASE), (1, BASE), (1, BASE), (2, BASE.replace("a", "A", 3)), (3, None), (4, ""), (5, "  \t\n"),
    (6, "one two"), (7, "one two"), (8, words(300, 3) + " " + PASSAGE + " " + words(20, 4)),
    (9, words(10, 5) + "\n" + PASSAGE), (10, "x " * 90), (11, "é日本語🙂 " * 40), (None, words(40, 6)), (None, None),
    (12, words(30000, 7)), (13, " ".join(BASE.split()[:110] + words(8, 8).split())),
]
