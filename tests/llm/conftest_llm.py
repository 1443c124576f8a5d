import string

import pytest

WS = " \t\n\x0b\x0c\r"


def words(text):
    """``[^\\x20\\x09-\\x0D]+`` of a text, by hand."""
    out, cur = [], ""
    for ch in text or "":
        if ch in WS:
            if cur:
                out.append(cur)
            cur = ""
        else:
            cur += ch
    return out + [cur] if cur else out


def fold(text):
    return (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
ODD = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "  \t\n", None, "a", 4),
    (4, "One two THREE", "en", "b", 13), (5, "one TWO three", "en", None, 13), (6, "one two three", "en", None, 13),
    (7, LONG, "en", "b", len(LONG)), (8, "head " + PASSAGE + " tail of eight", "en", "b", 9),
    (9, PASSAGE + " " + PASSAGE, "fr", "c", 9), (10, "x " * 45, "fr", "c", 9),
    (11, LONG + " more", "en", "d", 9), (12, "É é ß Σ́ 漢字 <|endoftext|> don't 12ab34 İ", "de", "d", 9),
    (13, "z" * 70_000, "de", "é", 9), (14, "zero\x00byte \x1c odd\x85space", "de", "é", 9),
    (4, "One two THREE", "en", "b", 13), (8, "head " + PASSAGE + " tail of eight", "en", "b", 9), (None, "no id " + PASSAGE, "en", "a", 9), (None, "one two three", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ODD, SCHEMA)
    extra = ("size", "key", "rank", "kept", "shard", "length", "weight", "_id", "_t", "pos", "id", "state", "target")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(extra)])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df):
    return [r.asDict() for r in df.collect()]
