"""Pairs met about once: rows go straight to tasks by their number, with the
same results as where sums and top rows are made before the shuffle."""

import pytest
from pyspark.sql import functions as F

from kinrank.operators import neighbors as nbm
from kinrank.operators import similarity as sim
from kinrank.operators.pairs import HotItems
from kinrank.operators.stats import Prepared

RATINGS = [(u, i, float(1 + (u * 7 + i * 3 + u * i) % 5)) for u in range(1, 15) for i in range(1, 12) if (u * i + 2 * u + i) % 4]
GRID = [(1, 1), (4, 2), (5, 1), (70, 9)]
FORMS = {
    "knn": lambda p, hot, given: nbm.knn(p, 3, hot),
    "knn_all": lambda p, hot, given: nbm.knn(p, 20, hot),
    "approx": lambda p, hot, given: nbm.approx_knn(p, 3, 4, 2, hot),
    "bucket": lambda p, hot, given: nbm.bucket_knn(p, 3, 4, 2, hot),
    "grid": lambda p, hot, given: nbm.approx_knn_grid(p, 3, GRID, sim.pair_stats(p).select("u", "v", "cos"), hot),
    "weights": lambda p, hot, given: nbm.neighbor_weights(
        nbm.knn(p, 3, hot), given.select(F.col("user_id").alias("u"), F.col("item_id").alias("v")),
        nbm.ranking_tasks(p, hot)),
}


@pytest.fixture
def prep(spark):
    return Prepared(spark.createDataFrame(RATINGS, "user_id bigint, item_id bigint, rating double"))


def rows_of(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def same_rows(spark, prep, monkeypatch, form):
    # of every user and item, rated or not, one of each unknown
    given = spark.createDataFrame([(u, i) for u in range(1, 16) for i in range(1, 13)], "user_id bigint, item_id bigint")
    hot = HotItems(prep.train, partitions=7)
    monkeypatch.setattr(sim, "SPARSE", 10 ** 6)
    want = rows_of(form(prep, hot, given))
    monkeypatch.setattr(sim, "SPARSE", 0)
    assert rows_of(form(prep, hot, given)) == want


@pytest.mark.parametrize("form", sorted(FORMS))
def test_spread_pairs_give_the_same_rows(spark, prep, monkeypatch, form):
    same_rows(spark, prep, monkeypatch, FORMS[form])


def plans_of(monkeypatch, module):
    plans, write = {}, module.materialize

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)
    monkeypatch.setattr(module, "materialize", watched)
    return plans


def test_spread_pairs_are_ranked_in_one_shuffle_sized_by_work(prep, monkeypatch):
    monkeypatch.setattr(sim, "SPARSE", 0)
    plans = plans_of(monkeypatch, nbm)
    stats = sim.pair_stats(prep).localCheckpoint()
    nbm.knn(prep, 3, HotItems(prep.train, partitions=7), stats=stats)
    top = plans["top-similarities"]
    assert top.count("Exchange") == 1 and "user_id#" in top and "REPARTITION_BY_NUM" in top


def test_grid_joins_nothing_to_the_pairs(prep, monkeypatch):
    plans = plans_of(monkeypatch, nbm)
    nbm.approx_knn_grid(prep, 3, GRID, sim.pair_stats(prep).select("u", "v", "cos").localCheckpoint(),
                        HotItems(prep.train))
    assert "Join" not in plans["top-similarities"]


def test_bucket_pairs_are_sized_by_work(prep, monkeypatch):
    monkeypatch.setattr(sim, "SPARSE", 0)
    sums = nbm.BucketRows(prep, 4, 2).sums()
    assert "REPARTITION_BY_NUM" in sums._jdf.queryExecution().executedPlan().toString().split("Aggregate")[-1].split("Join")[0]
