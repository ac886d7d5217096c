"""Averages, deviations and norms over a ratings table.

Every per-user / per-item fact is a ``groupBy().agg()`` (partial aggregation
before the shuffle) joined back on its key. The join's strategy is left to
AQE, which broadcasts the aggregate only after measuring it; the deviation
rows stay hash-partitioned by ``user_id``, so the norm aggregate and the join
that attaches it reuse that partitioning instead of shuffling again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.functions.formulas import deviation, safe_ratio
from kinrank.sources.schema import ITEM, RATING, USER


def global_average(train: DataFrame) -> DataFrame:
    """One row: ``avg_rating`` (null for an empty table)."""
    return train.agg(F.avg(RATING).alias("avg_rating"))


def global_scalar(train: DataFrame) -> Column:
    """The global average as a scalar subquery column (evaluated once)."""
    return train.agg(F.avg(RATING)).scalar()


def rating_stats(train: DataFrame) -> DataFrame:
    """Count, mean and population standard deviation of the ratings."""
    return train.agg(F.count(F.lit(1)).alias("n"), F.avg(RATING).alias("avg_rating"),
                     F.stddev_pop(RATING).alias("std_rating"))


def user_stats(train: DataFrame) -> DataFrame:
    """``user_id, n, user_avg``."""
    return train.groupBy(USER).agg(F.count(F.lit(1)).alias("n"),
                                   F.avg(RATING).alias("user_avg"))


def item_stats(train: DataFrame) -> DataFrame:
    """``item_id, n, item_avg``."""
    return train.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n"),
                                   F.avg(RATING).alias("item_avg"))


def deviations(train: DataFrame, ustats: DataFrame | None = None) -> DataFrame:
    """``user_id, item_id, rating, user_avg, n_user, dev`` with
    ``dev = (r - ua) / scale(r, ua)``."""
    us = (ustats if ustats is not None else user_stats(train)).select(
        USER, F.col("n").alias("n_user"), "user_avg")
    return (train.select(USER, ITEM, RATING).join(us, USER)
                 .withColumn("dev", deviation(F.col(RATING), F.col("user_avg"))))


def normalized(dev: DataFrame) -> DataFrame:
    """Adds ``w = dev / ||dev_u||`` (0 for a user whose norm is 0)."""
    norms = dev.groupBy(USER).agg(F.sqrt(F.sum(F.col("dev") * F.col("dev"))).alias("norm"))
    return dev.join(norms, USER).withColumn("w", safe_ratio(F.col("dev"), F.col("norm")))


def item_average_deviation(dev: DataFrame) -> DataFrame:
    """``item_id, n, avg_dev`` — mean normalised deviation over the raters."""
    return dev.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n"), F.avg("dev").alias("avg_dev"))


class Prepared:
    """The training-side frames every predictor shares, built once per train
    table: ``ustats`` (per user) and ``w`` (one row per rating with
    ``rating, n_user, user_avg, dev, norm, w``; ``dev`` is the same frame).

    With ``materialize`` (the default) both are written once as parquet to
    the shared folder: every later branch scans them instead of
    recomputing the joins and aggregates behind them.
    """

    def __init__(self, train: DataFrame, materialize: bool = True):
        from kinrank.session import materialize as write
        train = train.select(USER, ITEM, RATING)
        ustats = user_stats(train)
        if materialize:
            ustats = write(ustats, "ustats")
        dev = deviations(train, ustats)
        w = normalized(dev)
        if materialize:
            w = write(w, "prepared")
            dev = w  # one written table serves both
        self.ustats = ustats
        self.w = w
        self.dev = dev
        # the plain input: averages and counts over it need none of the joins above
        self.train = train
        self.g = global_scalar(train)
        self._idev = None
        self._span = None

    @classmethod
    def of(cls, ustats: DataFrame, w: DataFrame, item_dev: DataFrame | None = None) -> Prepared:
        """From tables that are there already."""
        prep = cls.__new__(cls)
        prep.ustats, prep.w, prep.dev, prep.train = ustats, w, w, w.select(USER, ITEM, RATING)
        prep.g, prep._idev, prep._span = global_scalar(prep.train), item_dev, None
        return prep

    @property
    def item_dev(self) -> DataFrame:
        if self._idev is None:
            self._idev = item_average_deviation(self.dev)
        return self._idev

    def span(self):
        """``users, low, high, most``: number of users, their smallest and
        largest id, and the most ratings of one; looked up once."""
        if self._span is None:
            self._span = self.ustats.agg(F.count(F.lit(1)).alias("users"), F.min(USER).alias("low"),
                                         F.max(USER).alias("high"), F.max("n").alias("most")).first()
        return self._span

    def n_users(self) -> Column:
        """Number of distinct train users, as a scalar subquery column."""
        return self.ustats.agg(F.count(F.lit(1))).scalar()
