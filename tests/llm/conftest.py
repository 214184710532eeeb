import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from eventlens.llm.common import ship

    ship(spark)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of (doc_id, text[, source])."""
    def make(*rows):
        return spark.createDataFrame(
            [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(docs, words):
    """Nulls in each column, empty and long texts, ties, repeated rows, clashing extra columns."""
    from pyspark.sql import functions as F

    long = " ".join(words(1, 30_000))
    plain = " ".join(words(2, 60))
    return docs(
        (1, plain), (1, plain), (2, plain, None), (3, None), (4, ""), (5, " \n\t "), (None, plain),
        (None, "short text"), (6, long), (7, "x" * 50_000), (8, "a"), (8, "another text of this id"),
    ).withColumns({n: F.lit("clash") for n in (
        "key", "node", "n", "row", "shard", "text_key", "found_id", "kept_id", "places", "component",
        "family", "host", "element", "anchor", "label", "features", "prediction", "candidate", "_n")})


@pytest.fixture(scope="session")
def words():
    """A seeded list of invented words."""
    import random

    def make(seed, n):
        rng = random.Random(seed)
        return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
                for _ in range(n)]

    return make


@pytest.fixture(scope="session")
def table(spark):
    from pathlib import Path

    folder = Path("/root/testdata/sf0.001")
    if not folder.is_dir():
        pytest.skip("no test tables")
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
