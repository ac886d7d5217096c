"""Plan properties that the scale design relies on."""

import contextlib
import io
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kinrank.functions import ranking
from kinrank.operators import neighbors, pairs, predict, pruned, recommend, similarity, state
from kinrank.plans import catalog
from kinrank.functions.formulas import rank_key
from kinrank.operators import similarity as sim
from kinrank.operators.stats import Prepared
from kinrank.sources import fixtures as fx

from .conftest import SF_SMALL

FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython|BatchEvalPython")


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


MODULES = [catalog, neighbors, pairs, predict, pruned, recommend, similarity, state, ranking]


@pytest.fixture
def written_plans(monkeypatch):
    """Plans of everything that a query writes before its last step."""
    import kinrank.session as session
    plans, write = [], session.materialize

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)
    for m in [*MODULES, session]:
        monkeypatch.setattr(m, "materialize", watched)
    return plans


@pytest.mark.parametrize("name", sorted(catalog.registry()))
def test_no_cross_products_or_python_in_plans(spark, name, written_plans):
    df = entry.queries()[name](spark, SF_SMALL)
    written_plans.append(("result", df._jdf.queryExecution().executedPlan().toString()))
    for step, plan in written_plans:
        assert not FORBIDDEN.findall(plan), (name, step)
    if name in ("knn_neighbors", "predict_knn", "mae_knn"):
        steps = [step for step, _ in written_plans]
        assert "top-similarities" in steps  # users x k rows at most, no table of all pairs
        top = next(plan for step, plan in written_plans if step == "top-similarities")
        assert top.count("WindowGroupLimit") == 2 and "SortMergeJoin" in top + "".join(p for _, p in written_plans)


def test_report_has_one_sum_for_each_predictor(spark, written_plans):
    df = entry.queries()["metrics_report"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    sums = re.findall(r"Aggregate \[user_id#\d+L?, item_id#\d+L?\], .*_num", plan)
    assert len(sums) == 4  # cosine, Jaccard, kNN and approximate kNN; the sweep groups by its step too


def test_a_cluster_needs_a_shared_folder():
    from kinrank.session import require_local_master
    for master in ("local", "local[4]", "local[*]"):
        require_local_master(master)
    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[3,2,3000]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            require_local_master(master)


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    import os

    import kinrank.session as session
    assert spark.sparkContext.applicationId in session.scratch_root(spark)
    monkeypatch.setattr(session, "scratch_root", lambda s: str(tmp_path))  # others' tables stay
    assert session.materialize(spark.range(3), "three").count() == 3
    assert os.listdir(tmp_path)
    session.clear_scratch(spark)
    assert not os.listdir(tmp_path)


def test_changed_input_gives_a_new_answer(spark, tmp_path):
    """Nothing is remembered between queries, whatever the path looks like."""
    import shutil
    for n in ("orders", "lineitem"):
        shutil.copyfile(f"{SF_SMALL}/{n}.parquet", tmp_path / f"{n}.parquet")
    where = f"file://{tmp_path}"
    whole = entry.queries()["rating_stats"](spark, where).first()["n"]
    import pyarrow.parquet as pq
    table = pq.read_table(f"{SF_SMALL}/lineitem.parquet")
    pq.write_table(table.slice(0, len(table) // 5), tmp_path / "lineitem.parquet")
    assert 0 < entry.queries()["rating_stats"](spark, where).first()["n"] < whole


def test_knn_ranking_is_a_partial_top_k(spark):
    prep = Prepared(fx.split(fx.ratings(spark, SF_SMALL))[0])
    sims = sim.directed(sim.pair_stats(prep).select("u", "v", "cos"), "cos")
    win = Window.partitionBy("user_id").orderBy(rank_key(F.col("sim")).desc(), F.col("neighbor_id").desc())
    top = sims.withColumn("rn", F.row_number().over(win)).filter("rn <= 10")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # partial (before the shuffle) and final


def test_adapter_scans_prune_columns(spark):
    text = _formatted(fx.ratings(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in schemas
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in schemas
