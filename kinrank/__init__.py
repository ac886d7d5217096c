"""kinrank — neighbourhood rating analytics as Spark DataFrame operators.

A ratings table ``(user_id BIGINT, item_id BIGINT, rating DOUBLE)`` goes in;
averages, normalised deviations, user-user similarities, k-nearest
neighbours (exact and bucket-approximate), rating predictions, mean absolute
error and top-n recommendations come out, each as a lazy DataFrame whose
work runs on the executors.

Layout:

* ``kinrank.sources``   — delimited / personal-file readers, the fixture adapter
* ``kinrank.functions`` — column expressions (scale, deviation, prediction) and
  a distributed dense index
* ``kinrank.operators`` — stats, sets, pair emission, similarity, neighbours,
  predictors, evaluation, recommendation
* ``kinrank.plans``     — the registered queries and their SQL oracles
* ``kinrank.llm``       — operators of a training-data pipeline over documents
"""

from kinrank.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
