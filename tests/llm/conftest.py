import random

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    *[T.StructField(c, T.StringType()) for c in (
        "n_words", "kept", "score", "component_id", "size", "shard", "key", "root", "removed", "n_lines",
        "sequence_id", "__w", "cutoff_symbols", "f_words", "length", "part")],
])


def _row(doc_id, text, lang="en", source="a"):
    extra = [f"own{k}" for k in range(len(DOCUMENT) - 5)]
    return (doc_id, text, lang, source, None if text is None else len(text), *extra)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty, blank, short, repeated, tied, odd and very long texts."""
    chance = random.Random(3)
    vocabulary = ["".join(chance.choice("abcdefghijklmnop") for _ in range(chance.randint(2, 9))) for _ in range(4000)]
    prose = [" ".join(chance.choice(vocabulary) for _ in range(60)) for _ in range(8)]
    long = " ".join(chance.choice(vocabulary) for _ in range(40_000))
    passage = "\n".join(" ".join(chance.choice(vocabulary) for _ in range(12)) for _ in range(24))
    rows = [
        _row(0, None), _row(1, ""), _row(2, "   \n\t "), _row(3, "one two"), _row(3, "one two"), _row(4, "ONE Two"),
        _row(None, prose[0]), _row(5, prose[0]), _row(5, prose[0]), _row(None, None), _row(None, None),
        _row(6, prose[1], None, None), _row(7, prose[1] + " end"), _row(8, long), _row(9, long + " tail"),
        _row(10, "日本語 😀 <|endoftext|>  double  space\r\nline x ▁ é́"),
        _row(11, "x" * 30_000), _row(12, "a " * 3000), _row(13, prose[2] + "\n" + passage),
        _row(14, prose[3] + "\n" + passage), _row(15, passage + "\n" + prose[4]), _row(16, passage),
        _row(17, " ".join(w + "###" for w in prose[5].split())), _row(18, prose[6].upper()),
        _row(19, "\n".join([prose[7]] * 6)), _row(20, "\n\n\n"), _row(21, "same line\nsame line\nsame line"),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCUMENT).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(5, 1, 0), (6, 1, 0), (7, 0, 1), (7, 1, 0), (None, 1, 0), (17, 0, None), (8, None, 1)],
        "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
