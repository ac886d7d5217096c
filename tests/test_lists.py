"""Pairs of users by lists: an item's raters go to each of them as arrays."""

import random

import pytest
from pyspark.sql import functions as F

from kinrank.operators import neighbors as nbm
from kinrank.operators import predict as pr
from kinrank.operators import similarity as sim
from kinrank.operators.pairs import HotItems, corated, partners
from kinrank.operators.stats import Prepared

from .test_spread_pairs import plans_of, rows_of

RNG = random.Random(11)
SPARSE = [(u * 1000 - 5000, i, float(RNG.randrange(1, 6))) for u in range(150)
          for i in RNG.sample(range(200), RNG.randrange(1, 4))]
SPARSE += [(u * 1000 - 5000, 500, 5.0) for u in range(5)] + [(-5000, 500, 1.0), (1 << 40, 3, 2.0), (1 << 40, 4, 5.0)]
SPARSE += [(None, 3, 4.0), (-4000, None, 2.0), (-4000, 3, None), (-3000, 3, None), (-3000, 7, 2.0)]


@pytest.fixture(params=[4096, 3])
def case(spark, request):
    prep = Prepared(spark.createDataFrame(SPARSE, "user_id bigint, item_id bigint, rating double"))
    return prep, HotItems(prep.train, block=request.param, partitions=5)


@pytest.mark.parametrize("both", [False, True])
def test_partners_are_the_corated_pairs(case, both):
    prep, hot = case
    for own in (None, F.col("n_user") > 2):
        got = partners(prep.w, ["w", "n_user"], ["w"], hot, both=both, owner=own)
        want = corated(prep.w.select("user_id", "item_id", "w", "n_user"), ["w", "n_user"], directed=both)
        if own is not None:
            want = want.filter("n_user_u > 2")
        cols = ["u", "v", "item_id", "w_u", "n_user_u", "w_v"]
        assert rows_of(got.select(*cols)) == rows_of(want.select(*cols))


def compared(monkeypatch, form):
    monkeypatch.setattr(sim, "SPARSE", 10 ** 6)
    want = rows_of(form())
    monkeypatch.setattr(sim, "SPARSE", 0)
    assert rows_of(form()) == want


@pytest.mark.parametrize("longest", [1024, 2])
def test_lists_give_the_same_similarities(case, monkeypatch, longest):
    prep, hot = case
    monkeypatch.setattr(sim, "LIST", longest)
    compared(monkeypatch, lambda: sim.pair_stats(prep, hot))


@pytest.mark.parametrize("longest", [1024, 2])
@pytest.mark.parametrize("k", [1, 3])
def test_lists_give_the_same_neighbours(case, monkeypatch, longest, k):
    prep, hot = case
    monkeypatch.setattr(sim, "LIST", longest)
    assert nbm.nobody_low(prep, k, hot)
    compared(monkeypatch, lambda: nbm.knn(prep, k, hot))


@pytest.mark.parametrize("steps", [1, 5, 127])
def test_coarse_weights_change_nothing(case, monkeypatch, steps):
    """The bounds hold however few steps a weight has."""
    prep, hot = case
    monkeypatch.setattr(nbm, "STEPS", steps)
    compared(monkeypatch, lambda: nbm.knn(prep, 2, hot))


def test_no_low_user_where_it_is_said(case):
    prep, hot = case
    for k in range(1, 150, 7):
        if nbm.nobody_low(prep, k, hot):
            assert nbm.low_users(prep, k, hot).isEmpty()


def test_no_pair_row_is_shuffled(case, monkeypatch):
    """The rows that leave the item's task are ratings with arrays; sums and
    ranks need no other exchange."""
    prep, hot = case
    monkeypatch.setattr(sim, "SPARSE", 0)
    plan = sim.pair_stats(prep, hot)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("posexplode(_ids")[0] and "_ids" in plan
    plans = plans_of(monkeypatch, nbm)
    nbm.knn(prep, 3, hot)
    assert "posexplode(_ids" in plans["top-similarities"]


@pytest.mark.parametrize("k", [1, 3])
def test_lists_give_the_same_bucket_neighbours(case, monkeypatch, k):
    prep, hot = case
    for longest in (1024, 2):
        monkeypatch.setattr(sim, "LIST", longest)
        compared(monkeypatch, lambda: nbm.bucket_knn(prep, k, 4, 2, hot))
    compared(monkeypatch, lambda: nbm.approx_knn(prep, k, 4, 2, hot))


def test_neighbours_are_asked_by_lists(spark, case, monkeypatch):
    """One row for each user and neighbour, cut at LIST items, for the same predictions."""
    prep, hot = case
    given = spark.createDataFrame([*[(u, i) for u, i, _ in SPARSE[::3]], *[(u * 1000 - 5000, i) for u in range(20)
                                  for i in range(0, 60, 3)], (7, 3), (None, 3), (-5000, None), (-5000, 3), (-5000, 3)],
                                  "user_id bigint, item_id bigint")
    monkeypatch.setattr(pr, "neighbours_first", lambda *_: True)
    for most in (1024, 2):
        monkeypatch.setattr(pr, "LIST", most)
        compared(monkeypatch, lambda: pr.predict_knn(prep, given, 3, hot=hot))
    raters = prep.dev.select("item_id", F.col("user_id").alias("neighbor_id"), "dev")
    nb = nbm.knn(prep, 3, hot).select("user_id", "neighbor_id", "sim")
    want = given.join(nb, "user_id").join(raters, ["neighbor_id", "item_id"]).select("user_id", "item_id", "sim", "dev")
    assert rows_of(pr.asked(given, nb, raters, 3)) == rows_of(want) != []
    plan = pr.asked(given, nb, raters, 3)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(neighbor_id" in plan and "hashpartitioning(neighbor_id, item_id" not in plan
    monkeypatch.setattr(pr, "MOST_ASKING", 0)
    assert not pr.listable(prep, nb)


GRID = [(1, 1), (4, 2), (5, 1), (70, 9)]  # over 62 marks: more than one number


def test_marks_tell_the_settings_of_a_pair(spark, case, monkeypatch):
    """What two users' marks share is what their hashed buckets share, by lists
    and by pair rows, and the grid needs no hash for each pair."""
    prep, hot = case
    marks = nbm.bucket_marks(prep.ustats, GRID)
    assert len(marks.words) == 2
    every = nbm.with_settings(sim.pair_stats(prep).select("u", "v", "cos"), GRID)
    want = {(r["u"], r["v"]): sum(1 << g for g in r["_seen"]) for r in every.collect()}
    for sparse, longest in ((10 ** 6, 1024), (0, 1024), (0, 2)):
        monkeypatch.setattr(sim, "SPARSE", sparse)
        monkeypatch.setattr(sim, "LIST", longest)
        got = sim.pair_stats(prep, hot, shared=marks)
        assert {(r["u"], r["v"]): r["_seen"] for r in got.collect()} == want
    stats = sim.pair_stats(prep).select("u", "v", "cos").localCheckpoint()
    rows = rows_of(nbm.approx_knn_grid(prep, 2, GRID, stats, hot))
    monkeypatch.setattr(nbm, "with_settings", None)
    marked = sim.pair_stats(prep, hot, shared=marks).select("u", "v", "cos", "_seen").localCheckpoint()
    assert rows_of(nbm.approx_knn_grid(prep, 2, GRID, marked, hot)) == rows


@pytest.mark.parametrize("kind", ["cosine", "jaccard"])
def test_full_predictions_by_lists(spark, case, monkeypatch, kind):
    """Raters and wanted pairs meet in the smaller user's partition."""
    prep, hot = case
    given = spark.createDataFrame([*[(u, i) for u, i, _ in SPARSE[::3]], *[(u * 1000 - 5000, i) for u in range(20)
                                  for i in range(0, 60, 3)], (7, 3), (None, 3), (-5000, None), (-5000, 3), (-5000, 3),
                                  (-(1 << 60), 3), (1 << 60, 3)], "user_id bigint, item_id bigint")
    lists = []
    real = pr.met_by_lists
    monkeypatch.setattr(pr, "met_by_lists", lambda *a: lists.append(real(*a)) or lists[-1])
    predict = {"cosine": pr.predict_cosine, "jaccard": pr.predict_jaccard}[kind]
    compared(monkeypatch, lambda: predict(prep, given, hot))
    assert len(lists) == (1 if hot.n == 0 else 0)
    for made in lists:  # no candidate is shuffled as a row
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("posexplode(_ids")[0]


def test_given_pairs_meet_the_lists(spark, case, monkeypatch):
    prep, hot = case
    ids = sorted({u for u, _, _ in SPARSE if u is not None})
    given = spark.createDataFrame([(u, v) for u in ids[::2] for v in ids[::3]] + [(ids[0], None), (None, ids[1]), (7, ids[0]),
                                  (ids[0], -(1 << 60)), (ids[0], ids[1]), (ids[0], ids[1])], "u bigint, v bigint")
    monkeypatch.setattr(sim, "_split", lambda prep, pairs, hot: (pairs.distinct(), None) if hot is None else (
        pairs.distinct().filter(F.col("u").eqNullSafe(F.col("v"))), pairs.distinct().filter(~F.col("u").eqNullSafe(F.col("v")))))
    lists, found = [], []
    real = sim._common_by_partner_lists
    monkeypatch.setattr(sim, "_common_by_partner_lists", lambda *a: lists.append(real(*a)) or lists[-1])
    for sparse, longest in ((10 ** 6, 1024), (0, 1024), (0, 2)):
        monkeypatch.setattr(sim, "SPARSE", sparse)
        monkeypatch.setattr(sim, "LIST", longest)
        found.append([rows_of(f(prep, given, hot=hot)) for f in (sim.common_items_of, sim.similarity_of)])
    assert found[0][0] and found[0] == found[1] == found[2]
    assert len(lists) == 1 and "Exchange" not in lists[0]._jdf.queryExecution().executedPlan().toString().split("explode(_ids")[0]
