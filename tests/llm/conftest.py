import pytest

from tallywell.session import ship_package, table

SF_DIR = "/root/testdata/sf0.001"
LONG = "the quick brown fox number {} jumps over the lazy dog again\n"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")


@pytest.fixture(scope="session")
def documents(spark):
    return table(spark, SF_DIR, "documents").cache()


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, kept boolean, n_words long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, columns with clashing names."""
    long_text = "".join(LONG.format(i) for i in range(20_000))
    texts = [
        (1, "One line of some length.\nAnother line, also long."), (1, "One line of some length.\nAnother line, also long."),
        (2, None), (3, ""), (4, " \t\n "), (None, "One line of some length.\nsecond"), (None, None), (5, long_text),
        (6, long_text + "end"), (7, "short"), (8, "x" * 300_000), (9, "été \U0001f600 <|endoftext|>"), (9, "été \U0001f600 <|endoftext|>"),
    ]
    rows = [
        (i, t, None if n % 3 == 0 else "en", None if n % 2 else f"s{n % 3}", None, -1, 99, None, None)
        for n, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
