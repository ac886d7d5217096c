"""Helpers shared by the corpus operators: reading the tables, packing rows so
that callers' column names cannot clash, and written intermediates."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinrank.session import ensure_checkpoint_dir, scratch_path

ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, as
    in a local session started elsewhere. A cluster gets the package by
    ``--py-files`` or its image; a path that is not there does no harm."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, rest)``: the id, the text (null becomes empty) and all
    columns but the text as one struct, so that no name of the caller's table
    can clash with a column that an operator adds."""
    importable(docs.sparkSession)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                       F.struct(*rest).alias("rest"))


def unpack(packed: DataFrame, like: DataFrame, text_col: str = "text", text: str = "text") -> DataFrame:
    """The caller's columns in their order, the text taken from ``text``."""
    return packed.select(*[F.col(text).alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c)
                           for c in like.columns])


def fold_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts: one aggregated number, from which partition and
    bucket counts are set so that each stays bounded at any size."""
    return docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate as Parquet into the shared checkpoint folder and
    read it back: lost executors cost a re-read, never a recomputation."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_bounds(counted: list[tuple], by: str, each: int) -> Column:
    """For each value of ``by`` the bound under which a 64-bit hash leaves
    about ``each`` and a quarter more of its rows (``counted``: value, rows)."""
    bound = F.lit(None).cast("long")
    for value, n in counted:
        part = min(1.0, (1.25 * each + 50) / max(1, n))
        most = min((1 << 63) - 1, int(part * 2.0 ** 64) - (1 << 63))
        bound = F.when(F.col(by).eqNullSafe(F.lit(value)), F.lit(most)).otherwise(bound)
    return bound


def hashed_sample(rows: DataFrame, by: str, hash_of: list[str], each: int, groups: int = 1000) -> DataFrame:
    """At most ``each`` rows of every value of ``by``: the first by a hash of
    the columns ``hash_of``, so the same rows whatever the partitions.

    The values are counted (more than ``groups`` are refused); then only rows
    with a hash under ``hash_bounds`` are ranked, so that hardly more than the
    sample is shuffled.
    """
    counted = rows.groupBy(by).agg(F.count("*").alias("n")).limit(groups + 1).collect()
    if len(counted) > groups:
        raise ValueError(f"more than {groups} values of {by}")
    bound = hash_bounds([(r[by], r["n"]) for r in counted], by, each)
    rank = F.row_number().over(Window.partitionBy(by).orderBy("hashed", *hash_of))
    return (rows.withColumn("hashed", F.xxhash64(*hash_of)).filter(F.col("hashed") <= bound)
            .withColumn("rank", rank).filter(F.col("rank") <= each).drop("hashed", "rank"))
