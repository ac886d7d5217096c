"""Recommendations to everybody: one shuffle of the reached items, only top rows are written."""

from pyspark.sql import functions as F

from kinrank.operators import recommend as rc
from kinrank.operators.pairs import HotItems
from kinrank.operators.stats import Prepared

from .test_spread_pairs import RATINGS, prep, same_rows  # noqa: F401


def test_spread_pairs_recommend_the_same(spark, prep, monkeypatch):  # noqa: F811
    same_rows(spark, prep, monkeypatch, lambda p, hot, given: rc.recommend(p, None, 3, 3, hot))


def test_recommendation_writes_its_top_rows_only(prep, monkeypatch):  # noqa: F811
    written, write = {}, rc.materialize

    def watched(df, name):
        got = write(df, name)
        written[name] = got
        return got
    monkeypatch.setattr(rc, "materialize", watched)
    rc.recommend(prep, None, 2, 3, HotItems(prep.train)).collect()
    assert "reach" not in written
    assert max(r["count"] for r in written["scored"].groupBy("user_id").count().collect()) <= 2


def test_a_missing_item_is_recommended_as_before(spark):
    prep = Prepared(spark.createDataFrame([*RATINGS, (1, None, 5.0), (2, None, 4.0)],
                                          "user_id bigint, item_id bigint, rating double"))
    rows = rc.recommend(prep, None, 20, 5, HotItems(prep.train)).filter(F.col("item_id").isNull()).collect()
    assert {r["user_id"] for r in rows} & {1, 2}  # a null never equals a null: nobody has rated it
