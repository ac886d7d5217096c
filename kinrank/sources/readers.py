"""Readers and writers for delimited rating files.

``read_ratings`` follows the classic MovieLens loader: every line is split on
a regular expression, fields are trimmed, the first three are kept, and a line
whose first field is not an integer (a header, a comment) is dropped. A bad
second or third field is an error: ANSI casts throw, whatever the session's
setting. Every row is kept, as in the loader; ``merge_duplicates`` is a step of
its own.

``read_personal`` reads ``id,title,rating`` with a header row; a missing
rating means "not rated" (0) and such rows are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.sources.schema import ITEM, RATING, USER

DEFAULT_SEP = "\t"


def _fields(spark: SparkSession, path: str, sep: str) -> DataFrame:
    parts = F.split(F.col("value"), sep)
    return spark.read.text(path).select(
        *[F.trim(F.get(parts, i)).alias(f"c{i}") for i in range(3)])


def _strict(c, type_name: str):
    """Cast that fails the job on a missing or bad field, with ANSI off too."""
    got = c.try_cast(type_name)
    bad = F.raise_error(F.concat(F.lit("bad field in a rating line: "), F.coalesce(c, F.lit("missing"))))
    return F.when(got.isNull(), bad.cast(type_name)).otherwise(got)


def read_ratings(spark: SparkSession, path: str, sep: str = DEFAULT_SEP) -> DataFrame:
    f = _fields(spark, path, sep)
    return (f.filter(F.expr("try_cast(c0 as bigint)").isNotNull())
             .select(F.col("c0").cast("bigint").alias(USER),
                     _strict(F.col("c1"), "bigint").alias(ITEM),
                     _strict(F.col("c2"), "double").alias(RATING)))


def merge_duplicates(ratings: DataFrame) -> DataFrame:
    """One row for each ``(user_id, item_id)``, with its largest rating."""
    return ratings.groupBy(USER, ITEM).agg(F.max(RATING).alias(RATING))


def read_personal(spark: SparkSession, path: str, user_id: int,
                  sep: str = ",") -> DataFrame:
    f = _fields(spark, path, sep).filter(F.col("c0") != "id")
    # an absent or empty third field is "not rated"; anything else must parse
    rating = F.when(F.col("c2").isNull() | (F.col("c2") == ""), F.lit(0.0)
                    ).otherwise(_strict(F.col("c2"), "double"))
    return (f.select(F.lit(user_id).cast("bigint").alias(USER),
                     _strict(F.col("c0"), "bigint").alias(ITEM), rating.alias(RATING))
             .filter(F.col(RATING) != 0))


def read_titles(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    f = _fields(spark, path, sep).filter(F.col("c0") != "id")
    return f.select(_strict(F.col("c0"), "bigint").alias(ITEM), F.col("c1").alias("title"))


def write_ratings(df: DataFrame, path: str, sep: str = DEFAULT_SEP,
                  header: bool = True) -> None:
    """Write ``(user_id, item_id, rating)`` as delimited text (one file per
    task, no driver round trip). A header line lands in one of the files; the
    reader drops it wherever it is."""
    lines = df.select(F.concat_ws(sep, F.col(USER).cast("string"), F.col(ITEM).cast("string"),
                                  F.col(RATING).cast("string")).alias("value"))
    if header:
        spark = df.sparkSession
        lines = spark.createDataFrame([(sep.join([USER, ITEM, RATING]),)],
                                      "value string").unionByName(lines)
    lines.write.mode("overwrite").text(path)


def write_lines(df: DataFrame, path: str) -> None:
    df.select("value").write.mode("overwrite").text(path)
