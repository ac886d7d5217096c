import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()),
                       # names that operators use themselves
                       *(T.StructField(c, T.StringType()) for c in
                         ("id", "rest", "s", "k", "c", "n", "pos", "score", "kept_text", "component", "Doc"))])


def frame(spark, rows, parts=3):
    """A table of documents from (id, text[, lang, source]) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or ""),
             *["x"] * 11) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def edge_rows():
    """Null, empty, white, tiny, long, repeated and tied rows, null ids."""
    rng = random.Random(5)
    vocab = [f"{a}{b}" for a in ("th", "on", "er", "ß", "é") for b in ("a", "ing", "x", "o")]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n))
    base, passage, long = prose(120), prose(60), prose(6000)
    rows = [(1, None), (2, ""), (3, " \t\n \x0b"), (4, "one"), (5, "One two"), (6, "one TWO"), (7, "a b c d"),
            (8, base), (9, base), (9, base), (10, base.upper()), (11, base + " " + prose(5)),
            (12, prose(30) + "\n" + passage + "\n" + prose(20)), (13, passage + " tail"), (14, "x " * 200),
            (15, long), (16, long[:3000] + " edited " + long[3000:]), (None, base), (None, None), (None, "null id"),
            (17, "Same line\nother " + prose(3)), (18, " same line \nmore " + prose(3)), (19, "SAME LINE"),
            (20, "same line\nsame line\n"), (21, "12 34 !!"), (22, "日本語 テキスト " * 20), (23, "😀" * 130),
            (24, "a" * 5000), (25, "ab " * 300 + "\n" + "ab " * 300)]
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return frame(spark, edge_rows())


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
