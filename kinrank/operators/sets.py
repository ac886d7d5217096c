"""Lookups and grouped member lists.

``grouped_lists`` is the "items of a user" / "raters of an item" map. A
group is never collected whole: members are spread over
``ceil(n / chunk)`` chunks by a portable hash of the member, and each output
row lists one chunk (sorted, comma-joined), so a row holds about ``chunk``
members whatever the group's size; every row names the group's whole size and
its number of chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.operators.neighbors import bucket_hash
from kinrank.sources.schema import ITEM, RATING, USER


def rating_lookup(ratings: DataFrame, pairs: DataFrame) -> DataFrame:
    """``user_id, item_id, rating`` for each pair; rating null if absent."""
    return pairs.select(USER, ITEM).join(ratings.select(USER, ITEM, RATING), [USER, ITEM], "left")


def grouped_lists(df: DataFrame, key: str, member: str, chunk: int, name: str) -> DataFrame:
    """``key, n, n_chunks, chunk, <name>``: sorted members per (key, chunk)."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    n_chunks = F.ceil(F.col("n") / F.lit(chunk)).cast("bigint")
    tagged = (df.select(key, member).join(sizes, key).withColumn("n_chunks", n_chunks)
                .withColumn("chunk", (bucket_hash(F.col(member), 0) % F.col("n_chunks")).cast("bigint")))
    return tagged.groupBy(key, "n", "n_chunks", "chunk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(member)), lambda x: x.cast("string")),
                     ",").alias(name))


def restrict_users(df: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``user_id`` is in ``users`` (a left-semi join;
    each kept row stays whole, nothing from ``users`` is added)."""
    return df.join(users.select(USER).distinct(), USER, "left_semi")


def for_user(df: DataFrame, user_id: int) -> DataFrame:
    return df.filter(F.col(USER) == F.lit(user_id))


def for_item(df: DataFrame, item_id: int) -> DataFrame:
    return df.filter(F.col(ITEM) == F.lit(item_id))
