import pytest

from millrace.llm.common import prepare


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Clashing and further columns, NULLs, empty and long texts, ties, repeated rows."""
    rows = [
        (1, "a b c d e f g h i j", "en"), (2, "a b c d e f g h i j", "en"), (3, "A B\tc d\ne f g h i j", None),
        (4, None, "en"), (5, "", "de"), (6, " \n\t ", ""), (7, "One", "en"), (8, "one", "en"), (9, "two words", "xx"),
        (None, "a b c d e f g h i j", "en"), (None, None, None), (10, "x y z " * 7000, "en"), (11, "É é ß́ \U0001f600 q", "fr"),
        (12, "mail a.b@c.example.com, ip 10.0.0.256 or 10.0.0.25.", "en"), (12, "mail a.b@c.example.com, ip 10.0.0.256 or 10.0.0.25.", "en"),
        (13, "card 4111 1111 1111 1111 phone +1 (555) 010-9999 <|endoftext|> it's...", "en"), (14, "w" * 5000, "en"),
    ]
    return spark.createDataFrame([(*r, "t", 1, "b", 7) for r in rows], "doc_id long, text string, lang string, block string, row long, n string, start int")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
