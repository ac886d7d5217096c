"""Fixture adapter: a ratings table derived from the TPC-H-like test tables.

    ratings  = lineitem JOIN orders: user = o_custkey, item = l_partkey,
               rating = max(1 + floor((l_quantity - 1) / 10)) per pair (1..5)
    test     = ratings where (user_id*31 + item_id*17) % 5 = 0, train = the rest
    titles   = part (p_partkey, p_name)
    personal = user -1 over every part: rating = p_partkey % 6, 0 = not rated
    pairs    = test pairs plus three cold ones (unknown user / item / both)

Only the columns used are read, so the parquet scans prune to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.sources.schema import ITEM, RATING, USER

# The split rule's multipliers and modulus, the personal user's
# id and rating modulus, and the cold ids used for the fallback rules.
SPLIT_USER_MUL = 31
SPLIT_ITEM_MUL = 17
SPLIT_MOD = 5
PERSONAL_USER = -1
PERSONAL_MOD = 6
COLD_ID = -5
COLD_PAIRS = [(COLD_ID, 1), (1, COLD_ID), (COLD_ID, COLD_ID)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings table, derived anew by each query that reads it."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    stars = 1 + F.floor((F.col("l_quantity") - 1) / 10)
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .groupBy(F.col("o_custkey").alias(USER), F.col("l_partkey").alias(ITEM))
              .agg(F.max(stars).cast("double").alias(RATING)))


def is_test(df: DataFrame):
    return (F.col(USER) * SPLIT_USER_MUL + F.col(ITEM) * SPLIT_ITEM_MUL) % SPLIT_MOD == 0


def split(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) — a deterministic hash split, no shuffle."""
    return r.filter(~is_test(r)), r.filter(is_test(r))


def cold_pairs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COLD_PAIRS, f"{USER} bigint, {ITEM} bigint")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(ITEM), F.col("p_name").alias("title"))


def personal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal-ratings file as text lines ``id,title,rating``; the rating
    is left empty where ``p_partkey % 6 = 0`` (a missing rating)."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    r = F.col("p_partkey") % PERSONAL_MOD
    body = part.select(F.concat_ws(
        ",", F.col("p_partkey").cast("string"), F.col("p_name"),
        F.when(r != 0, r.cast("double").cast("string")).otherwise(F.lit(""))).alias("value"))
    header = spark.createDataFrame([("id,title,rating",)], "value string")
    return header.unionByName(body)


def personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal ratings as the personal reader yields them (zeros dropped)."""
    part = table(spark, sf_dir, "part").select("p_partkey")
    r = (F.col("p_partkey") % PERSONAL_MOD).cast("double")
    return (part.select(F.lit(PERSONAL_USER).cast("bigint").alias(USER),
                        F.col("p_partkey").alias(ITEM), r.alias(RATING))
                .filter(F.col(RATING) != 0))
