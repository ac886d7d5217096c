"""A distributed dense index: ``1..N`` over the sorted distinct values of a
column, without a single-partition window.

Values are range-partitioned, sorted and numbered inside each partition, and
written once: range bounds are sampled whenever a plan runs, so sizes and
positions must come from the same written rows. Per-partition sizes (one row
per partition, a bound fixed by the partition count) are prefix-summed and
joined back as offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.session import materialize

_LOW_BITS = 33


def dense_index(df: DataFrame, col: str, name: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """``col, name`` with ``name`` = 1-based position of ``col`` in sorted order."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = (df.select(col).distinct()
               .repartitionByRange(n, col).sortWithinPartitions(col)
               .withColumn("_mid", F.monotonically_increasing_id()))
    keyed = keyed.select(col, F.shiftright("_mid", _LOW_BITS).alias("_pid"),
                         F.col("_mid").bitwiseAND((1 << _LOW_BITS) - 1).alias("_local"))
    keyed = materialize(keyed, "dense-index")
    sizes = keyed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_pid", F.coalesce(F.sum("_size").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (keyed.join(F.broadcast(offsets), "_pid")
                 .select(col, (F.col("_off") + F.col("_local") + 1).alias(name)))
