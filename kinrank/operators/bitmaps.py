"""Union and intersection of users' item sets by bitmaps.

Items are numbered densely and a user's items become bits of 64-bit words, one
for each range of numbers in which the user has items: a word a user and item at
most, however many items there are. A pair's words of one range are or-ed by an
aggregate: the union's bits are counted, and what both sides have beyond it is
the intersection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.functions.ranking import dense_index
from kinrank.sources.schema import ITEM, USER

WORD = 64  # bits


def item_bitmaps(ratings: DataFrame) -> DataFrame:
    """``user_id, range, bits``: one word for each range of item numbers in
    which the user has items."""
    index = dense_index(ratings.select(ITEM), ITEM, "_bit")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_bit") % WORD).cast("int"))
    return (ratings.select(USER, ITEM).join(index, ITEM)
            .groupBy(USER, F.floor(F.col("_bit") / WORD).alias("range")).agg(F.bit_or(bit).alias("bits")))


def set_sizes_of(ratings: DataFrame, pairs: DataFrame) -> DataFrame:
    """``u, v, n_union, n_common`` for each given pair (distinct); an unknown
    user has no items."""
    given = pairs.select("u", "v").distinct()
    bitmaps = item_bitmaps(ratings)
    sides = given.withColumn(USER, F.explode(F.array("u", "v")))
    each = (sides.join(bitmaps, USER).groupBy("u", "v", "range")
            .agg(F.bit_count(F.bit_or("bits")).alias("_any"), F.sum(F.bit_count("bits")).alias("_both")))
    sizes = each.groupBy("u", "v").agg(F.sum("_any").alias("_any"), F.sum("_both").alias("_both"))
    return given.join(sizes, ["u", "v"], "left").select(
        "u", "v", F.coalesce("_any", F.lit(0)).alias("n_union"),
        F.coalesce(F.col("_both") - F.col("_any"), F.lit(0)).alias("n_common"))
