"""Tables laid out for their joins: bucketed and sorted by user or by item, so
that joins and aggregates on that key need no exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from kinrank.session import scratch_path
from kinrank.sources.schema import ITEM, USER

BUCKETS = 16


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """``df`` as a table of ``buckets`` files by a hash of ``key``, each sorted
    by it, in ``path`` (default: the application's folder for intermediates).
    Tables that are joined on the key need the same number of buckets; choose
    it so that a bucket fits a task."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return spark.table(table)


class RatingLayout:
    """One ratings table twice: ``by_user`` and ``by_item``."""

    def __init__(self, ratings: DataFrame, name: str = "ratings", buckets: int = BUCKETS):
        self.by_user = write_bucketed(ratings, f"{name}-by-user", USER, buckets)
        self.by_item = write_bucketed(ratings, f"{name}-by-item", ITEM, buckets)
