"""Given pairs that are too many for lists come from the pair join."""

import pytest
from pyspark.sql import functions as F

from kinrank.operators import similarity as sim
from kinrank.operators.neighbors import low_users
from kinrank.operators.pairs import HotItems
from kinrank.operators.stats import Prepared

RATINGS = [(u, i, float(1 + (u * 7 + i * 3) % 5)) for u in range(1, 13) for i in range(1, 9) if (u * i) % 3]
GIVEN = [(u, v) for u in range(1, 13) for v in range(1, 13)] * 2 + [
    (1, 99), (99, 1), (99, 99), (98, 99), (None, 1), (1, None), (None, None)]


@pytest.fixture
def prep(spark):
    return Prepared(spark.createDataFrame(RATINGS, "user_id bigint, item_id bigint, rating double"))


def _rows(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [4096, 3])
@pytest.mark.parametrize("of", [sim.similarity_of, sim.common_items_of])
def test_pairs_of_the_pair_join_are_those_of_lists(spark, prep, monkeypatch, of, block):
    given = spark.createDataFrame(GIVEN, "u bigint, v bigint")
    hot = HotItems(prep.train, block=block)
    want = _rows(of(prep, given))
    led, listed = [], sim._led
    monkeypatch.setattr(sim, "_led", lambda p, pairs: led.append(pairs) or listed(p, pairs))
    assert _rows(of(prep, given, hot=hot)) == want
    # only pairs of a user with itself went by lists
    assert led[0].filter(~F.col("u").eqNullSafe(F.col("v"))).isEmpty()
    few = spark.createDataFrame([(1, 2)], "u bigint, v bigint")
    assert _rows(of(prep, few, hot=hot)) == _rows(of(prep, few))
    assert led[1].count() == 1  # few pairs go by lists


@pytest.mark.parametrize("sparse", [0, 4])
def test_pair_sums_without_a_partial_sum_are_the_same(spark, prep, monkeypatch, sparse):
    hot = HotItems(prep.train, partitions=7)
    want = _rows(sim.pair_stats(prep))
    monkeypatch.setattr(sim, "SPARSE", sparse)
    stats = sim.pair_stats(prep, hot)
    assert _rows(stats) == want
    assert ("REPARTITION_BY_NUM" in stats.select("u", "v", "cos")._jdf.queryExecution().executedPlan().toString().split(
        "Aggregate")[-1].split("Join")[0]) == (sparse == 0)


def test_low_users_of_a_literal_user_keep_their_join_key(spark):
    ratings = spark.createDataFrame(RATINGS, "user_id bigint, item_id bigint, rating double")
    own = spark.createDataFrame([(1, 5.0), (2, 1.0)], "item_id bigint, rating double").select(
        F.lit(-1).cast("bigint").alias("user_id"), "item_id", "rating")
    prep = Prepared(ratings.unionByName(own))
    low = low_users(prep, 300, HotItems(prep.train), spark.createDataFrame([(-1,)], "user_id bigint"))
    assert "NestedLoop" not in low._jdf.queryExecution().executedPlan().toString()
    assert [r[0] for r in low.collect()] == [-1]


def test_a_missing_rating_leaves_the_cosine_unknown_either_way(spark):
    ratings = spark.createDataFrame(RATINGS + [(1, 20, None), (2, 20, 3.0)],
                                    "user_id bigint, item_id bigint, rating double")
    prep = Prepared(ratings)
    given = spark.createDataFrame(GIVEN, "u bigint, v bigint")
    want = _rows(sim.similarity_of(prep, given))
    assert any(r[:2] == (1, 2) and r[3] is None for r in want)
    assert _rows(sim.similarity_of(prep, given, hot=HotItems(prep.train))) == want
