import pytest

from trawl.session import ship_package


@pytest.fixture(scope="session")
def lspark(spark):
    ship_package(spark)
    return spark


WORDS = "the of river stone and lamp green door winter paper glass moon field copper rain bridge".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x // 65536 % len(WORDS)] + str(x // 97 % 50))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_docs(lspark):
    """Nulls, empty texts, copies, repeated rows, a long text, and columns whose names clash with results."""
    long = prose(1, 3000)
    rows = [
        (1, prose(2, 60), "a"), (2, prose(2, 60), "a"), (3, prose(3, 40) + "\n" + prose(4, 30), "b"),
        (4, prose(3, 40) + "\n" + prose(5, 30), None), (5, "", "b"), (6, None, None), (7, "   \n\t ", "c"),
        (8, long, "a"), (9, long + " tail", "a"), (10, "ñandú über " + prose(6, 20), "c"),
        (None, prose(7, 25), "c"), (11, prose(8, 25), "b"), (11, prose(8, 25), "b"), (12, "x", "é"),
    ]
    data = [(d, t, s, "en", 0, "clash", 1, 2) for d, t, s in rows]
    return lspark.createDataFrame(
        data, "doc_id long, text string, source string, lang string, n_chars long, key string, component long, score int")
