"""The corpus pipeline: five stages over the table ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``docs`` (with ``n_chars`` kept true to the
text). ``run`` writes each stage's rows as Parquet into the shared checkpoint
folder and reads them again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.llm import debruijn, jaccard, langid, lines, packing
from kinrank.llm.common import table, unpack, written

# Texts that no language reaches this score for are rejected (figures in the
# README). Under SHORT characters a text has few n-grams, and the score tells
# only other scripts apart.
MIN_SCORE, SHORT, MIN_SHORT = 0.27, 40, 0.12
LINE_DOCUMENTS = 10   # lines found in so many documents go
WORDS, PERCENT = 5, 80
WINDOW = 35
KEY = "pipeline_row_key"


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go: a null text, one without a
    letter, or one that no learned language scores ``MIN_SCORE`` for
    (``MIN_SHORT`` under ``SHORT`` characters). Learns from a bounded sample of
    the rows whose ``lang`` is given; where none is, nothing can be judged and
    only texts without a letter go."""
    model = langid.train(docs)
    if model is None:
        return docs.filter(F.col("text").rlike("\\p{L}"))
    kept = langid.identify(docs.withColumn(KEY, F.col("text")), model)
    least = F.when(F.length(f"rest.{KEY}") < SHORT, MIN_SHORT).otherwise(MIN_SCORE)
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= least)
    return unpack(kept.filter(known), docs, text=f"rest.{KEY}")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ``LINE_DOCUMENTS`` documents go from all of them; every
    document stays. A null text is one empty line; rows without an id count by
    their texts; an empty table stays empty."""
    return _measured(unpack(lines.line_dedup(docs, min_docs=LINE_DOCUMENTS), docs, text="kept_text"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, whatever ids its members share or lack:
    the one with the smallest id (null ids last), then the smallest hash of
    its text, then the smallest row key, which is written with the rows. Texts
    without words stay."""
    keyed = written(docs.withColumn(KEY, F.monotonically_increasing_id()), "keyed")
    named = keyed.select("doc_id", "text", KEY, F.xxhash64("text").alias(f"{KEY}_text"))
    found = jaccard.jaccard_join(named, words=WORDS, percent=PERCENT).select("id", "group", "rest")
    order = F.struct(F.col("id").isNull().alias("last"), "id", f"rest.{KEY}_text", f"rest.{KEY}")
    first = found.filter("group is not null").groupBy("group").agg(F.min(order).alias("first"))
    stays = first.select(f"first.{KEY}").unionByName(found.filter("group is null").select(f"rest.{KEY}"))
    return keyed.join(stays, KEY, "left_semi").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of ``WINDOW`` words that start anywhere else too go;
    every document stays. A null or empty text stays empty, repeated rows lose
    their windows in each, an empty table stays empty."""
    kept = debruijn.substring_dedup(docs, k=WINDOW, squash=False)
    return _measured(unpack(kept, docs, text="kept_text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens at most. A null or
    empty text is its end token alone; repeated rows and null ids are packed
    one by one; an empty table gives no pieces."""
    pieces = packing.harmonic_pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumnRenamed("doc", "doc_id")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("jaccard_join", jaccard_join),
          ("substring_dedup", substring_dedup), ("packing", pack)]

# Language scores and token ids are beyond SQL; tests/llm holds the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
