import pytest

SF = "/root/testdata/sf0.001"
# Names that operators use inside, as extra columns of their input.
CLASHES = [
    "content", "rank", "salt", "fp", "row", "shard", "keys", "label", "tokens", "bucket", "score", "kept", "piece", "component_id",
    "dedup_key", "near_place", "mix_times", "copies", "rate", "held_out", "n_words", "line", "FINGERPRINT",
]


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    base = "One two three four five six seven eight nine ten eleven twelve"
    long = " ".join(f"word{i} und{i % 13}." for i in range(60_000))
    return [
        (1, base, "en", "s1", 1), (2, None, "en", "s1", None), (3, "", None, None, 0), (4, " \t\n\r\x0b\x0c ", "en", "s2", 7),
        (5, long, "en", "s1", 9), (6, base + "  ", "en", "s2", 2), (7, base + " \n", "en", "s1", 3), (7, base + " \n", "en", "s1", 3),
        (None, "lost and found", "en", "s1", 4), (None, None, None, None, None), (8, "x", "en", None, 1),
        (9, "Größe é à la naïve\nline\nline", "de", "s3", 5), (10, "\U0001f600 emoji \U0001f600", "en", "s3", 6), (11, long, "en", "s2", 9),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    docs = spark.createDataFrame(edge_rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("clash").alias(c) for c in CLASHES]).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (3, None, 1), (5, 1, 1), (5, 0, 0), (None, 1, 1), (99, 1, 0), (9, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def values(df, *columns):
    """Sorted rows; null sorts first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
