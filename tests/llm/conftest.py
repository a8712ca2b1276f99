import pytest

from tests.conftest import *  # noqa: F403

WORDS = "the quick brown fox jumps over a lazy dog while seven grey geese fly south at dawn".split()


def prose(seed: int, words: int) -> str:
    """Text that depends on the seed, without repeats of length."""
    out, x = [], seed * 7919 + 1
    for _ in range(words):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x >> 8 & 15] + str(x >> 12 & 63))
    return " ".join(out)


EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "Ümläut ÉÀ 語 ½  x y"), (6, prose(6, 20_000)),
    (7, "same text twice"), (8, "same text twice"), (9, "<|endoftext|> it's\r\n\n  done </w>"), (10, "x" * 3_000),
    (7, "same text twice"), (None, "no id"), (11, None),
]


@pytest.fixture(scope="session")
def edges(spark):  # noqa: F811
    """Rows of every odd kind, in a table with clashing extra columns."""
    rows = [(i, t, "en", "s", 0, 1, 2, "x", -1) for i, t in EDGES]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars int, start int, shard int, part string, size int"
    ).repartition(3)
