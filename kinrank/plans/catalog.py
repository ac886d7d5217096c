"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each one reads the whole test tables through the fixture adapter and runs
one operator of the library. Every double is reported rounded to 6 decimals
(``out``), the same rounding as the SQL oracle in ``kinrank.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.functions.formulas import out, rank_key
from kinrank.operators import bitmaps as bm
from kinrank.operators import evaluate as ev
from kinrank.operators import neighbors as nbm
from kinrank.operators import predict as pr
from kinrank.operators import recommend as rc
from kinrank.operators import sets as st
from kinrank.operators import similarity as sim
from kinrank.operators import stats as ss
from kinrank.operators.pairs import HotItems, raters_of
from kinrank.operators.pruned import knn_pruned
from kinrank.operators.state import RatingState
from kinrank.session import materialize, scratch_path
from kinrank.sources import fixtures as fx
from kinrank.sources import layout as ly
from kinrank.sources import readers as rd
from kinrank.sources.schema import ITEM, RATING, USER

# Fixed parameters of the registered queries.
K = 10                 # neighbours for kNN queries
K_REC = 300            # neighbours for the personal recommendation
N_REC = 3              # recommendations per user
N_BUCKETS = 10         # approximate kNN: buckets
REPLICATION = 2        # approximate kNN: buckets per user
SWEEP_KS = [10, 30, 50, 100, 200, 300, 400, 800, 943]
LIST_CHUNK = 1000      # members per row of a grouped list
GRID = [(10, 1), (10, 2), (10, 4), (20, 2)]  # (buckets, buckets per user) of the recall report

Query = Callable[[SparkSession, str], DataFrame]


class Ctx:
    """Frames shared inside one query build (not across queries)."""

    def __init__(self, spark: SparkSession, sf_dir: str, with_personal: bool = False,
                 heavy: bool = False):
        self.spark, self.sf_dir = spark, sf_dir
        # pair-based queries write the prepared tables once: there they feed
        # the pair join, the rater join, the fallbacks and the size check
        self.heavy = heavy
        self.ratings = fx.ratings(spark, sf_dir)
        if heavy:  # derived once for this query
            self.ratings = materialize(self.ratings, "ratings")
        self.train, self.test = fx.split(self.ratings)
        if with_personal:
            self.train = rc.union_personal(self.ratings, fx.personal(spark, sf_dir))
        self._prep = None
        self._hot = None

    @property
    def prep(self) -> ss.Prepared:
        """Prepared tables, written on first use only."""
        if self._prep is None:
            self._prep = ss.Prepared(self.train, materialize=self.heavy)
        return self._prep

    @property
    def hot(self) -> HotItems:
        if self._hot is None:
            self._hot = HotItems(self.prep.train)
        return self._hot

    def pairs(self) -> DataFrame:
        return self.test.select(USER, ITEM).unionByName(fx.cold_pairs(self.spark))


def _preds(df: DataFrame) -> DataFrame:
    return df.select(USER, ITEM, out(pr.PRED).alias(pr.PRED))


def _mae(df: DataFrame) -> DataFrame:
    return ev.mae(df).select("n", out("mae").alias("mae"))


# ---------------------------------------------------------------- stats
def q_rating_stats(spark, d):
    c = Ctx(spark, d)
    return ss.rating_stats(c.train).select("n", out("avg_rating").alias("avg_rating"),
                                           out("std_rating").alias("std_rating"))


def q_global_average(spark, d):
    return ss.global_average(Ctx(spark, d).train).select(out("avg_rating").alias("avg_rating"))


def q_user_average(spark, d):
    return ss.user_stats(Ctx(spark, d).train).select(USER, "n", out("user_avg").alias("user_avg"))


def q_item_average(spark, d):
    return ss.item_stats(Ctx(spark, d).train).select(ITEM, "n", out("item_avg").alias("item_avg"))


def q_item_average_deviation(spark, d):
    return ss.item_average_deviation(Ctx(spark, d).prep.dev).select(ITEM, "n", out("avg_dev").alias("avg_dev"))


def q_normalized_deviations(spark, d):
    return Ctx(spark, d).prep.dev.select(USER, ITEM, out("dev").alias("dev"))


def q_l2_normalized_deviations(spark, d):
    return Ctx(spark, d).prep.w.select(USER, ITEM, out("w").alias("w"))


# ---------------------------------------------------------------- sets
def q_rating_lookup(spark, d):
    c = Ctx(spark, d)
    return st.rating_lookup(c.ratings, c.pairs())


def q_items_by_user(spark, d):
    return st.grouped_lists(Ctx(spark, d).train, USER, ITEM, LIST_CHUNK, "items")


def q_raters_by_item(spark, d):
    return st.grouped_lists(Ctx(spark, d).train, ITEM, USER, LIST_CHUNK, "users")


def q_common_items(spark, d):
    c = Ctx(spark, d, heavy=True)
    return sim.common_items(c.prep, c.hot)


def _candidates(c: Ctx) -> DataFrame:
    """``u, v``: each test user with every train rater of one of its test items."""
    raters = c.prep.dev.select(ITEM, F.col(USER).alias("v"))
    met = raters_of(c.test.select(USER, ITEM), raters, "v", c.hot)
    return met.filter(F.col(USER) != F.col("v")).select(F.col(USER).alias("u"), "v").distinct()


def q_similarity_of_pairs(spark, d):
    c = Ctx(spark, d, heavy=True)
    return sim.similarity_of(c.prep, _candidates(c), hot=c.hot).select("u", "v", "n_common", out("cos").alias("cos"),
                                                            out("jac").alias("jac"))


def q_common_items_of_pairs(spark, d):
    c = Ctx(spark, d, heavy=True)
    return sim.common_items_of(c.prep, _candidates(c), hot=c.hot)


def q_neighbor_weights_of_pairs(spark, d):
    c = Ctx(spark, d, heavy=True)
    weights = nbm.neighbor_weights(nbm.knn(c.prep, K, c.hot), _candidates(c), nbm.ranking_tasks(c.prep, c.hot))
    return weights.select("u", "v", out("weight").alias("weight"))


def q_item_set_sizes(spark, d):
    """Every user with the next user id: sizes of the union and intersection
    of their item sets (a next id without ratings has an empty set)."""
    c = Ctx(spark, d, heavy=True)
    pairs = c.prep.ustats.select(F.col(USER).alias("u"), (F.col(USER) + 1).alias("v"))
    return bm.set_sizes_of(c.train, pairs)


def q_append_personal(spark, d):
    """Item deviations after the personal ratings are appended to all others."""
    c = Ctx(spark, d, heavy=True)
    state = RatingState.of(c.ratings).append(fx.personal(spark, d))
    return state.item_deviations().select(ITEM, "n", out("avg_dev").alias("avg_dev"))


def q_append_ratings(spark, d):
    """Baseline predictions for the pairs after the test ratings of every other
    user are appended to train."""
    c = Ctx(spark, d, heavy=True)
    state = RatingState.of(c.train).append(c.test.filter(F.col(USER) % 2 == 0))
    return _preds(pr.predict_baseline(state.prepared(), c.pairs()))


def q_layout_by_user(spark, d):
    """Test rows with their user's train average, both tables laid out by user."""
    c = Ctx(spark, d, heavy=True)
    train, test = (ly.write_bucketed(t, n, USER) for t, n in ((c.train, "train"), (c.test, "test")))
    return test.join(ss.user_stats(train), USER).select(USER, ITEM, RATING, "n", out("user_avg").alias("user_avg"))


def q_layout_by_item(spark, d):
    """Test rows with their item's train average, both tables laid out by item."""
    c = Ctx(spark, d, heavy=True)
    train, test = (ly.write_bucketed(t, n, ITEM) for t, n in ((c.train, "train"), (c.test, "test")))
    return test.join(ss.item_stats(train), ITEM).select(USER, ITEM, RATING, "n", out("item_avg").alias("item_avg"))


def q_restrict_users(spark, d):
    c = Ctx(spark, d)
    return st.restrict_users(c.train, c.test)


def q_rows_of_user(spark, d):
    return st.for_user(Ctx(spark, d).ratings, 1)


def q_rows_of_item(spark, d):
    return st.for_item(Ctx(spark, d).ratings, 1)


def q_union_personal(spark, d):
    c = Ctx(spark, d)
    return rc.union_personal(c.ratings, fx.personal(spark, d))


def q_unrated_candidates(spark, d):
    c = Ctx(spark, d, with_personal=True)
    return rc.unrated_items(c.train, [fx.PERSONAL_USER])


def q_unrated_counts(spark, d):
    return rc.unrated_counts(Ctx(spark, d).train)


# ---------------------------------------------------------------- similarity / neighbours
def _nonzero(df: DataFrame) -> DataFrame:
    return df.filter(rank_key("sim") != 0).select("u", "v", out("sim").alias("sim"))


def q_cosine_similarity(spark, d):
    c = Ctx(spark, d, heavy=True)
    return _nonzero(sim.cosine_similarity(c.prep, c.hot))


def q_jaccard_similarity(spark, d):
    c = Ctx(spark, d, heavy=True)
    return _nonzero(sim.jaccard_similarity(c.prep, c.hot))


def _nb_out(df: DataFrame) -> DataFrame:
    return df.select(USER, "pos", sim.NEIGHBOR, out("sim").alias("sim"))


def q_knn_neighbors(spark, d):
    c = Ctx(spark, d, heavy=True)
    return _nb_out(nbm.knn(c.prep, K, c.hot))


def q_user_buckets(spark, d):
    c = Ctx(spark, d)
    return nbm.user_buckets(c.prep.ustats.select(USER), N_BUCKETS, REPLICATION)


def q_approx_knn_neighbors(spark, d):
    c = Ctx(spark, d, heavy=True)
    return _nb_out(nbm.approx_knn(c.prep, K, N_BUCKETS, REPLICATION, c.hot))


def q_knn_neighbors_pruned(spark, d):
    c = Ctx(spark, d, heavy=True)
    return _nb_out(knn_pruned(c.prep, K, c.hot))


def q_bucket_knn_neighbors(spark, d):
    c = Ctx(spark, d, heavy=True)
    nb = nbm.bucket_knn(c.prep, K, N_BUCKETS, REPLICATION, c.hot)
    return nb.select("bucket", USER, "pos", sim.NEIGHBOR, out("sim").alias("sim"))


def q_approx_knn_recall(spark, d):
    """How much of exact kNN the approximate form finds, by its setting."""
    c = Ctx(spark, d, heavy=True)
    marks = nbm.bucket_marks(c.prep.ustats, GRID)
    stats = materialize(sim.pair_stats(c.prep, c.hot, shared=marks).select("u", "v", "cos", "_seen"), "pair-stats")
    exact = materialize(nbm.knn(c.prep, K, c.hot, stats=stats), "exact")
    found = nbm.approx_knn_grid(c.prep, K, GRID, stats, c.hot)
    got = nbm.neighbor_overlap(exact, found, ["n_buckets", "replication"])
    return got.select("n_buckets", "replication", "n_exact", "n_found", out("recall").alias("recall"))


def q_weighted_deviation_knn(spark, d):
    c = Ctx(spark, d, heavy=True)
    p = c.pairs()
    wd = pr.weighted_deviation(c.prep, p, nbm.knn(c.prep, K, c.hot), per_user=K, hot=c.hot)
    return (p.join(wd, [USER, ITEM], "left")
             .select(USER, ITEM, out(F.coalesce(F.col("d"), F.lit(0.0))).alias("wdev")))


# ---------------------------------------------------------------- predictors
def _predictor(kind: str):
    def build(c: Ctx, pairs: DataFrame) -> DataFrame:
        p = c.prep
        if kind == "global":
            return pr.predict_global(p, pairs)
        if kind == "user_avg":
            return pr.predict_user_avg(p, pairs)
        if kind == "item_avg":
            return pr.predict_item_avg(p, pairs)
        if kind == "baseline":
            return pr.predict_baseline(p, pairs)
        if kind == "uniform":
            return pr.predict_uniform(p, pairs)
        if kind == "cosine":
            return pr.predict_cosine(p, pairs, c.hot)
        if kind == "jaccard":
            return pr.predict_jaccard(p, pairs, c.hot)
        if kind == "knn":
            return pr.predict_knn(p, pairs, K, hot=c.hot)
        if kind == "approx_knn":
            return pr.predict_approx_knn(p, pairs, K, N_BUCKETS, REPLICATION, hot=c.hot)
        raise ValueError(kind)
    return build


PREDICTORS = ["global", "user_avg", "item_avg", "baseline", "uniform", "cosine", "jaccard",
              "knn", "approx_knn"]


PLAIN = ["global", "user_avg", "item_avg", "baseline"]  # no pairs of users
HEAVY = {"cosine", "jaccard", "knn", "approx_knn"}


def _predict_query(kind: str) -> Query:
    def q(spark, d):
        c = Ctx(spark, d, heavy=kind in HEAVY)
        return _preds(_predictor(kind)(c, c.pairs()))
    q.__name__ = f"q_predict_{kind}"
    return q


def _mae_query(kind: str) -> Query:
    def q(spark, d):
        c = Ctx(spark, d, heavy=kind in HEAVY)
        return _mae(_predictor(kind)(c, c.test))
    q.__name__ = f"q_mae_{kind}"
    return q


def q_predict_knn_keep_known(spark, d):
    c = Ctx(spark, d, heavy=True)
    pairs = c.ratings.select(USER, ITEM).unionByName(fx.cold_pairs(spark))
    return _preds(pr.predict_knn(c.prep, pairs, K, keep_known=True, hot=c.hot))


def q_predict_approx_knn_keep_known(spark, d):
    c = Ctx(spark, d, heavy=True)
    pairs = c.ratings.select(USER, ITEM).unionByName(fx.cold_pairs(spark))
    return _preds(pr.predict_approx_knn(c.prep, pairs, K, N_BUCKETS, REPLICATION, keep_known=True, hot=c.hot))


def q_predict_personal(spark, d):
    """Data and personal ratings together: the personal user's prediction for
    every part, known ratings kept, at the recommendation's k."""
    c = Ctx(spark, d, with_personal=True, heavy=True)
    users = spark.createDataFrame([(fx.PERSONAL_USER,)], f"{USER} bigint")
    # written: joins on a literal user would lose their key
    parts = materialize(fx.titles(spark, d).select(F.lit(fx.PERSONAL_USER).cast("bigint").alias(USER), ITEM),
                        "personal-pairs")
    nbrs = nbm.knn(c.prep, K_REC, c.hot, users=users)
    return _preds(pr.predict_knn(c.prep, parts, K_REC, keep_known=True, hot=c.hot, nbrs=nbrs))


def q_mae_knn_sweep(spark, d):
    c = Ctx(spark, d, heavy=True)
    preds = pr.predict_knn_sweep(c.prep, c.test, SWEEP_KS, hot=c.hot)
    return ev.mae(preds, by=["k"]).select(F.col("k").cast("bigint").alias("k"), "n", out("mae").alias("mae"))


# ---------------------------------------------------------------- recommendation
def _personal_top(spark, d) -> DataFrame:
    c = Ctx(spark, d, with_personal=True, heavy=True)
    users = spark.createDataFrame([(fx.PERSONAL_USER,)], f"{USER} bigint")
    return rc.recommend(c.prep, users, N_REC, K_REC, hot=c.hot)


def q_recommend_top_n(spark, d):
    return _personal_top(spark, d).select(USER, "rank", ITEM, out(pr.PRED).alias(pr.PRED))


def q_recommend_top_n_all(spark, d):
    c = Ctx(spark, d, heavy=True)
    return (rc.recommend(c.prep, None, N_REC, K, hot=c.hot)
              .select(USER, "rank", ITEM, out(pr.PRED).alias(pr.PRED)))


def q_recommend_top_n_approx(spark, d):
    c = Ctx(spark, d, heavy=True)
    nbrs = nbm.approx_knn(c.prep, K, N_BUCKETS, REPLICATION, c.hot)
    return (rc.recommend(c.prep, None, N_REC, K, hot=c.hot, nbrs=nbrs)
              .select(USER, "rank", ITEM, out(pr.PRED).alias(pr.PRED)))


def q_recommend_top_n_baseline(spark, d):
    c = Ctx(spark, d, with_personal=True, heavy=True)
    top = rc.recommend_by(c.prep.train, [fx.PERSONAL_USER], N_REC, lambda x: pr.predict_baseline(c.prep, x))
    return top.select(USER, "rank", ITEM, out(pr.PRED).alias(pr.PRED))


def _ranked_query(kind: str) -> Query:
    def q(spark, d):
        c = Ctx(spark, d, heavy=True)
        return rc.recommend_ranked(c.prep, kind, N_REC).select(USER, "rank", ITEM, out(pr.PRED).alias(pr.PRED))
    q.__name__ = f"q_recommend_top_n_{kind}_all"
    return q


def q_recommend_with_titles(spark, d):
    top = _personal_top(spark, d)
    return (top.join(fx.titles(spark, d), ITEM, "left")
               .select("rank", ITEM, "title", out(pr.PRED).alias(pr.PRED)))


# ---------------------------------------------------------------- report
def q_metrics_report(spark, d):
    """Averages, the MAE of the nine predictors over the test set and their
    prediction for (user 1, item 1), the similarities of users 1 and 2, and
    the k sweep. Each predictor runs once over test + probe into one aggregate
    of both; cosine, Jaccard, kNN and the sweep share one written pair table."""
    c = Ctx(spark, d, heavy=True)
    p = c.prep
    stats = materialize(sim.pair_stats(p, c.hot), "pair-stats")
    nbrs = materialize(nbm.knn(p, max(SWEEP_KS), c.hot, stats=stats), "neighbours")
    probe = spark.createDataFrame([(1, 1)], f"{USER} bigint, {ITEM} bigint")
    both = (c.test.select(USER, ITEM, RATING, F.lit(False).alias("_probe"))
            .unionByName(probe.select(USER, ITEM, F.lit(None).cast("double").alias(RATING),
                                      F.lit(True).alias("_probe"))))
    build = {
        "global": lambda x: pr.predict_global(p, x),
        "user_avg": lambda x: pr.predict_user_avg(p, x),
        "item_avg": lambda x: pr.predict_item_avg(p, x),
        "baseline": lambda x: pr.predict_baseline(p, x),
        "uniform": lambda x: pr.predict_uniform(p, x),
        "cosine": lambda x: pr.predict_cosine(p, x, c.hot, stats=stats),
        "jaccard": lambda x: pr.predict_jaccard(p, x, c.hot, stats=stats),
        "knn": lambda x: pr.predict_knn(p, x, K, hot=c.hot, nbrs=nbrs.filter(F.col("pos") <= K)),
        "approx_knn": lambda x: pr.predict_approx_knn(p, x, K, N_BUCKETS, REPLICATION, hot=c.hot),
    }
    parts = [ev.report([
        ("averages", "global_avg", ss.global_average(c.train), "avg_rating"),
        ("averages", "user_1_avg", p.ustats.filter(F.col(USER) == 1), "user_avg"),
        ("averages", "item_1_avg", ss.item_stats(c.train).filter(F.col(ITEM) == 1), "item_avg"),
        ("averages", "item_1_avg_dev", p.item_dev.filter(F.col(ITEM) == 1), "avg_dev")])]
    for kind, fn in build.items():
        parts.append(ev.mae_and_probe(fn(both), "_probe", kind))
    two = sim.similarity_of(p, spark.createDataFrame([(1, 2)], "u bigint, v bigint"))
    parts.append(ev.report([("similarity_1_2", "cosine", two, "cos"), ("similarity_1_2", "jaccard", two, "jac")]))
    sweep = ev.mae(pr.predict_knn_sweep(p, c.test, SWEEP_KS, hot=c.hot, nbrs=nbrs), by=["k"])
    parts.append(sweep.select(F.lit("mae_knn_sweep").alias("section"),
                              F.concat(F.lit("k="), F.col("k").cast("string")).alias("metric"),
                              F.col("mae").alias("value")))
    return reduce(DataFrame.unionByName, parts).select("section", "metric", out("value").alias("value"))


def q_answers_report(spark, d):
    """The answers file: averages, MAEs and predictions of the plain
    predictors, written nested by section and read back by its schema."""
    c = Ctx(spark, d, heavy=True)
    p = c.prep
    probe = spark.createDataFrame([(1, 1)], f"{USER} bigint, {ITEM} bigint")
    both = (c.test.select(USER, ITEM, RATING, F.lit(False).alias("_probe"))
            .unionByName(probe.select(USER, ITEM, F.lit(None).cast("double").alias(RATING), F.lit(True).alias("_probe"))))
    parts = [ev.report([
        ("averages", "global_avg", ss.global_average(c.train), "avg_rating"),
        ("averages", "user_1_avg", p.ustats.filter(F.col(USER) == 1), "user_avg"),
        ("averages", "item_1_avg", ss.item_stats(c.train).filter(F.col(ITEM) == 1), "item_avg"),
        ("averages", "item_1_avg_dev", p.item_dev.filter(F.col(ITEM) == 1), "avg_dev")])]
    parts += [ev.mae_and_probe(_predictor(kind)(c, both), "_probe", kind) for kind in PLAIN]
    metrics = ["global_avg", "user_1_avg", "item_1_avg", "item_1_avg_dev", *PLAIN]
    path = scratch_path(spark, "answers")
    ev.write_answers(reduce(DataFrame.unionByName, parts), path, metrics)
    return ev.flat_answers(ev.read_answers(spark, path, metrics), metrics).select(
        "section", "metric", out("value").alias("value"))


# ---------------------------------------------------------------- readers
def q_read_ratings(spark, d):
    c = Ctx(spark, d)
    path = scratch_path(spark, "ratings-tsv")
    rd.write_ratings(c.ratings, path)
    return rd.read_ratings(spark, path)


def q_read_personal(spark, d):
    path = scratch_path(spark, "personal-csv")
    rd.write_lines(fx.personal_lines(spark, d), path)
    return rd.read_personal(spark, path, fx.PERSONAL_USER)


def q_read_titles(spark, d):
    """The id,title,rating file again, read by the title reader."""
    path = scratch_path(spark, "titles-csv")
    rd.write_lines(fx.personal_lines(spark, d), path)
    return rd.read_titles(spark, path)


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "rating_stats": q_rating_stats,
        "global_average": q_global_average,
        "user_average": q_user_average,
        "item_average": q_item_average,
        "item_average_deviation": q_item_average_deviation,
        "normalized_deviations": q_normalized_deviations,
        "l2_normalized_deviations": q_l2_normalized_deviations,
        "rating_lookup": q_rating_lookup,
        "items_by_user": q_items_by_user,
        "raters_by_item": q_raters_by_item,
        "common_items": q_common_items,
        "cosine_similarity": q_cosine_similarity,
        "jaccard_similarity": q_jaccard_similarity,
        "knn_neighbors": q_knn_neighbors,
        "user_buckets": q_user_buckets,
        "approx_knn_neighbors": q_approx_knn_neighbors,
        "weighted_deviation_knn": q_weighted_deviation_knn,
        "similarity_of_pairs": q_similarity_of_pairs,
        "common_items_of_pairs": q_common_items_of_pairs,
        "neighbor_weights_of_pairs": q_neighbor_weights_of_pairs,
        "restrict_users": q_restrict_users,
        "rows_of_user": q_rows_of_user,
        "rows_of_item": q_rows_of_item,
    }
    for kind in PREDICTORS:
        q[f"predict_{kind}"] = _predict_query(kind)
    q["predict_knn_keep_known"] = q_predict_knn_keep_known
    q["predict_approx_knn_keep_known"] = q_predict_approx_knn_keep_known
    q["predict_personal"] = q_predict_personal
    for kind in PREDICTORS:
        q[f"mae_{kind}"] = _mae_query(kind)
    q.update({
        "mae_knn_sweep": q_mae_knn_sweep,
        "union_personal": q_union_personal,
        "unrated_candidates": q_unrated_candidates,
        "unrated_counts": q_unrated_counts,
        "recommend_top_n": q_recommend_top_n,
        "recommend_top_n_all": q_recommend_top_n_all,
        "recommend_top_n_approx": q_recommend_top_n_approx,
        "recommend_top_n_baseline": q_recommend_top_n_baseline,
        "recommend_with_titles": q_recommend_with_titles,
        "metrics_report": q_metrics_report,
        "answers_report": q_answers_report,
        "knn_neighbors_pruned": q_knn_neighbors_pruned,
        "bucket_knn_neighbors": q_bucket_knn_neighbors,
        "approx_knn_recall": q_approx_knn_recall,
        "item_set_sizes": q_item_set_sizes,
        "append_personal": q_append_personal,
        "append_ratings": q_append_ratings,
        "layout_by_user": q_layout_by_user,
        "layout_by_item": q_layout_by_item,
        **{f"recommend_top_n_{kind}_all": _ranked_query(kind) for kind in PLAIN},
        "read_ratings": q_read_ratings,
        "read_personal": q_read_personal,
        "read_titles": q_read_titles,
    })
    return q
