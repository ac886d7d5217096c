"""Predictions from pairs that are met about once."""

import pytest

from kinrank.operators import predict as pr
from kinrank.operators import similarity as sim
from kinrank.operators.pairs import HotItems

from .test_spread_pairs import plans_of, prep, same_rows  # noqa: F401

FORMS = {
    "cosine": lambda p, hot, given: pr.predict_cosine(p, given, hot),
    "jaccard": lambda p, hot, given: pr.predict_jaccard(p, given, hot),
    "of_stats": lambda p, hot, given: pr.predict_jaccard(p, given, hot, stats=sim.pair_stats(p)),
    "sweep": lambda p, hot, given: pr.predict_knn_sweep(p, given, [1, 3, 20], hot),
}


@pytest.mark.parametrize("form", sorted(FORMS))
def test_spread_pairs_predict_the_same(spark, prep, monkeypatch, form):  # noqa: F811
    same_rows(spark, prep, monkeypatch, FORMS[form])


def test_cosine_of_spread_pairs_writes_no_candidates(spark, prep, monkeypatch):  # noqa: F811
    monkeypatch.setattr(sim, "SPARSE", 0)
    plans = plans_of(monkeypatch, pr)
    pr.predict_cosine(prep, spark.createDataFrame([(1, 2), (2, 5)], "user_id bigint, item_id bigint"), HotItems(prep.train))
    assert not plans
