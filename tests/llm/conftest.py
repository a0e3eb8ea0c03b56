import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def prose(seed: int, n: int, stems=("alo", "beri", "cado", "dun", "esk", "fomi", "gra")) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(stems) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts, null and repeated ids, repeated rows, ties, a long text, and extra
    columns whose names the operators use themselves."""
    long = prose(9, 20_000)
    base = prose(1, 60)
    rows = [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, " \n\t "), (6, long),
            (None, base), (None, None), (7, "é́😀 日本 token"), (8, "a" * 400), (9, "b a" * 100),
            (10, prose(2, 40) + " " + base), (10, prose(3, 30)), (11, "A\x00B Z"), (12, long + " x")]
    extra = ("score", "fp", "fingerprint", "block", "id", "__text", "spans", "part", "n_tokens")
    data = [(i, t, *(["x"] * len(extra))) for i, t in rows]
    return spark.createDataFrame(
        data, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in extra)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
