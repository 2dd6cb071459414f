import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def texts():
    """Texts with the cases every operator has to bear: null, blank, very long, tied and repeated."""
    plain = "the quick brown fox jumps over the lazy dog and runs back to the old barn at night. "
    return [
        (1, plain * 3), (2, plain * 3), (3, plain * 3 + "More words follow here.\nA line.\nA line.\nA line.\n"),
        (4, None), (5, ""), (6, " \n\t "), (7, "one two"), (8, "ünï cödé ☃ <|endoftext|> it's 42!"),
        (9, " ".join(f"word{i % 97}x{i % 13}" for i in range(30_000))), (10, "x" * 5000), (11, "-" * 400),
        (2, plain * 3), (None, plain * 3), (12, "The QUICK brown fox jumps over the lazy dog"),
    ]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with further columns whose names operators use themselves."""
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    clash = ["_id", "_text", "kept", "digest", "fp", "chunk", "rows", "start", "length", "piece", "key", "hash", "path", "n"]
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
