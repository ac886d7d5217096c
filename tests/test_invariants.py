"""Properties that must hold on real fixture data (sf0.001)."""

import math

import pytest
from pyspark.sql import functions as F

from kinrank.operators import evaluate as ev
from kinrank.operators import neighbors as nbm
from kinrank.operators import predict as pr
from kinrank.operators import similarity as sim
from kinrank.operators.stats import Prepared
from kinrank.session import scratch_path
from kinrank.sources import fixtures as fx
from kinrank.sources import readers as rd

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def data(spark):
    ratings = fx.ratings(spark, SF_SMALL)
    train, test = fx.split(ratings)
    return ratings, train, test, Prepared(train)


def _nb(df):
    return {(r.user_id, r.neighbor_id): (r.pos, round(r.sim, 9)) for r in df.collect()}


def test_approx_with_one_bucket_is_exact(data):
    *_, prep = data
    assert _nb(nbm.approx_knn(prep, 10, 1, 1)) == _nb(nbm.knn(prep, 10))


def test_approx_with_full_replication_is_exact(data):
    *_, prep = data
    assert _nb(nbm.approx_knn(prep, 10, 4, 4)) == _nb(nbm.knn(prep, 10))


def test_approx_loses_only_pairs(data):
    *_, prep = data
    exact = {(r.u, r.v): r.cos for r in sim.pair_stats(prep).collect()}
    approx = {(r.u, r.v): r.cos for r in nbm.approx_similarities(prep, 10, 2).collect()}
    assert set(approx) <= set(exact)
    assert all(math.isclose(approx[p], exact[p], abs_tol=1e-12) for p in approx)
    assert len(approx) < len(exact)


def test_buckets_are_distinct_and_replicated(data):
    *_, prep = data
    b = nbm.user_buckets(prep.ustats.select("user_id"), 10, 2)
    per_user = b.groupBy("user_id").agg(F.countDistinct("bucket").alias("n")).select("n").distinct().collect()
    assert [r.n for r in per_user] == [2]


def test_cosine_symmetric_and_bounded(data):
    *_, prep = data
    d = {(r.user_id, r.neighbor_id): r.sim for r in sim.directed(sim.cosine_similarity(prep)).collect()}
    assert all(math.isclose(d[(v, u)], s, abs_tol=1e-12) for (u, v), s in d.items())
    assert all(abs(s) <= 1 + 1e-9 for s in d.values())


def test_sweep_at_10_equals_knn_mae(data):
    _, _, test, prep = data
    sweep = {r.k: r.mae for r in ev.mae(pr.predict_knn_sweep(prep, test, [10, 30]), by=["k"]).collect()}
    one = ev.mae(pr.predict_knn(prep, test, 10)).collect()[0].mae
    assert math.isclose(sweep[10], one, abs_tol=1e-12)


def test_knn_with_all_neighbours_equals_cosine(data):
    _, _, test, prep = data
    n = prep.ustats.count()
    a = {(r.user_id, r.item_id): r.prediction for r in pr.predict_knn(prep, test, n - 1).collect()}
    b = {(r.user_id, r.item_id): r.prediction for r in pr.predict_cosine(prep, test).collect()}
    assert a.keys() == b.keys()
    assert all(math.isclose(a[x], b[x], abs_tol=1e-9) for x in a)


def test_mae_order_of_sizes(data):
    _, _, test, prep = data
    m = ev.mae(pr.predict_baseline(prep, test)).collect()[0]
    assert m.n == test.count() and 0 <= m.mae <= 4


def test_written_ratings_round_trip(spark, data):
    ratings, *_ = data
    path = scratch_path(spark, "rt")
    rd.write_ratings(ratings, path, sep="\t")
    back = rd.read_ratings(spark, path, sep="\t")
    assert sorted(back.collect()) == sorted(ratings.collect())


def test_personal_reader_semantics(spark):
    path = scratch_path(spark, "personal")
    lines = ["id,title,rating", "1,Toy Story,5", "2,Heat,", "3,Casino", "4,Fargo,3.5"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = sorted((r.user_id, r.item_id, r.rating) for r in rd.read_personal(spark, path, 944).collect())
    assert got == [(944, 1, 5.0), (944, 4, 3.5)]
    titles = {r.item_id: r.title for r in rd.read_titles(spark, path).collect()}
    assert titles == {1: "Toy Story", 2: "Heat", 3: "Casino", 4: "Fargo"}
