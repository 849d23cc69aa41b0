import random

import pytest

SF = "/root/testdata/sf0.001"

#: Names that the operators use inside, as columns of the caller's.
EXTRA = ["key", "id", "rest", "score", "shard", "slot", "lang_pred", "rejected", "length", "component", "ranges", "size"]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    parts = "the of and to in er tion ing an re on ea th ed nd ha st en at ou".split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))


def messy_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty and very long texts, ties, repeated rows, near copies."""
    base, other = prose(1, 300), prose(2, 120)
    texts = [
        (1, base), (2, base), (3, base + " tail"), (4, None), (5, ""), (6, "   \n\t"), (7, "one"), (8, "one two"),
        (9, other), (10, prose(3, 40) + " " + other + " " + prose(4, 50)), (11, prose(5, 30) + "\n" + other),
        (12, "é" * 900), (13, "!!! ??? 123"), (14, prose(6, 30_000)), (None, "a row without an id " + prose(7, 80)),
        (15, prose(8, 60)), (15, prose(8, 60)), (16, "aaaa " * 300), (17, "ONE two"), (18, "x" * 1500),
    ]
    return [(i, t, "en" if t else None, "src0" if i != 9 else None, len(t) if t else None) for i, t in texts]


@pytest.fixture(scope="session")
def messy(spark):
    """Messy documents with extra columns whose names clash with the operators' own."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    from pyspark.sql import functions as F

    return spark.createDataFrame(messy_rows(), schema).withColumns({c: F.lit("x") for c in EXTRA})


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
