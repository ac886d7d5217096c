"""Appending ratings without starting over.

Averages are kept as (count, sum), which merge. New ratings change the average
of the users who gave them, so these users' deviations and norms are made anew
from their own rows; an item's sum of deviations changes by the difference of
its touched raters' old and new ones. Everybody else's rows are carried over
as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.operators.stats import Prepared, deviations, normalized
from kinrank.session import materialize
from kinrank.sources.schema import ITEM, RATING, USER


class RatingState:
    """``users``: ``user_id, n, total``; ``items``: ``item_id, n, dev_sum``;
    ``rows``: one row per rating with its deviation and weight (``Prepared.w``)."""

    def __init__(self, users: DataFrame, items: DataFrame, rows: DataFrame):
        self.users, self.items, self.rows = users, items, rows

    @classmethod
    def of(cls, train: DataFrame) -> RatingState:
        train = train.select(USER, ITEM, RATING)
        users = materialize(_totals(train), "user-totals")
        rows = materialize(normalized(deviations(train, _stats(users))), "rated")
        return cls(users, materialize(_by_item(rows), "item-sums"), rows)

    def append(self, new: DataFrame) -> RatingState:
        """The state with the ratings ``new`` (``user_id, item_id, rating``)
        added. Only rows of their users are read again; items no such user
        rated stay as they are."""
        new = materialize(new.select(USER, ITEM, RATING), "new")
        touched = new.select(USER).distinct()
        mine = self.users.join(touched, USER, "left_semi").unionByName(_totals(new))
        changed = materialize(mine.groupBy(USER).agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "changed")
        old = self.rows.join(touched, USER, "left_semi")
        again = materialize(normalized(deviations(
            old.select(USER, ITEM, RATING).unionByName(new), _stats(changed))), "made-anew")
        minus = _by_item(old).select(ITEM, (-F.col("n")).alias("n"), (-F.col("dev_sum")).alias("dev_sum"))
        delta = materialize(_merged(minus.unionByName(_by_item(again))), "item-changes")
        items = (self.items.join(delta, ITEM, "left_anti")
                 .unionByName(_merged(self.items.join(delta, ITEM, "left_semi").unionByName(delta))))
        return RatingState(self.users.join(touched, USER, "left_anti").unionByName(changed), items,
                           self.rows.join(touched, USER, "left_anti").unionByName(again))

    def item_deviations(self) -> DataFrame:
        """``item_id, n, avg_dev``."""
        return self.items.filter(F.col("n") > 0).select(ITEM, "n", (F.col("dev_sum") / F.col("n")).alias("avg_dev"))

    def prepared(self) -> Prepared:
        """The tables that the predictors take, without building them again."""
        return Prepared.of(_stats(self.users), self.rows, self.item_deviations())


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy(USER).agg(F.count(F.lit(1)).alias("n"), F.sum(RATING).alias("total"))


def _stats(users: DataFrame) -> DataFrame:
    return users.select(USER, "n", (F.col("total") / F.col("n")).alias("user_avg"))


def _by_item(rows: DataFrame) -> DataFrame:
    return rows.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n"), F.sum("dev").alias("dev_sum"))


def _merged(items: DataFrame) -> DataFrame:
    return items.groupBy(ITEM).agg(F.sum("n").alias("n"), F.sum("dev_sum").alias("dev_sum"))
