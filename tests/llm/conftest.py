import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, row string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(start: int, length: int = 30) -> str:
    return " ".join(f"{WORDS[(start * 7 + k * (start + 3)) % len(WORDS)]}{(start + k) % 5}" for k in range(length))


def hostile_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows, other white space, clashing names."""
    long = " ".join(f"w{k}" for k in range(30_000))
    copy = sentence(1)
    near = copy + " extra"
    rows = [(1, copy), (2, copy), (3, copy), (4, near), (5, ""), (6, None), (7, " \t\n"), (8, "one"), (9, "One"), (10, long), (11, long + " end"),
            (12, sentence(2)), (12, sentence(2)), (13, "naïve café\tx  y\u00a0z 中文"), (14, "a\n\nb c"), (15, "<|endoftext|> x"), (None, sentence(3)), (None, None)]
    rows += [(20 + k, sentence(4 + k, 20 + k)) for k in range(20)]
    sources = ["s1", "s2", None]
    return [(i, t, None if k % 4 == 0 else "en", sources[k % 3], None if k % 5 == 0 else 7, "x", None, "r") for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def hostile(spark):
    return spark.createDataFrame(hostile_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
