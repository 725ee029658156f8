import pytest

LONG = " ".join(f"word{i % 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and very long texts, repeated rows, copies, and columns named
    like the operators' own."""
    texts = [
        (1, "The quick brown fox jumps over the lazy dog."), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, LONG + " end"),
        (7, "The quick brown fox jumps over the lazy dog."), (7, "The quick brown fox jumps over the lazy dog."),
        (None, "no id"), (None, None), (8, "x"), (9, "  double  spaces\n\nand\ttabs "), (10, "Ünïcödé ñ 日本語 \U0001F600 مرحبا 'tis 12.5%"),
    ]
    clash = ("fp", "shard", "part", "ids", "tokens", "margin", "words", "key", "row", "train", "dev", "spans", "items", "host", "path", "rank", "__row", "__was", "__spans", "__cut", "word", "h", "n")
    rows = [(i, t, "en", "s", None if t is None else len(t), *["odd"] * len(clash)) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clash)).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
