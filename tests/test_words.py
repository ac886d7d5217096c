"""Item sets as words of bits."""

from pyspark.sql import functions as F

from kinrank.operators import bitmaps


def test_words_of_scattered_items_are_small(spark):
    rows = spark.createDataFrame([(u, i) for u in (1, 2) for i in range(u, 400_000, 997)], "user_id bigint, item_id bigint")
    filler = spark.range(0, 400_000, 2).select(F.lit(3).cast("bigint").alias("user_id"), F.col("id").alias("item_id"))
    words = bitmaps.item_bitmaps(rows.unionByName(filler))
    size = words.agg(F.sum(F.octet_length(F.col("bits").cast("string")))).first()[0]
    assert size <= 20 * (2 * 402 + 400_000 // 64 + 1)  # 20 digits a word at most
    given = spark.createDataFrame([(1, 2), (1, 3)], "u bigint, v bigint")
    got = {(r["u"], r["v"]): r["n_common"] for r in bitmaps.set_sizes_of(rows.unionByName(filler), given).collect()}
    assert got == {(1, 2): 0, (1, 3): sum(1 for i in range(1, 400_000, 997) if i % 2 == 0)}
