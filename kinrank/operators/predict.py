"""Rating predictors: ``(prep, pairs, ...) -> pairs + prediction``.

``pairs`` is any DataFrame with ``user_id, item_id`` (extra columns, such as
a test ``rating``, pass through). Fallbacks:

* unknown user                -> global average
* known user, no deviation    -> user average (d = 0): unknown item, no
                                 neighbour rated it, or neighbour weights sum to 0
* otherwise                   -> ua + d * scale(ua + d, ua)

Personalised deviations are ``d = sum(s * dev) / sum(|s|)`` over the raters
of the item that are neighbours of the user. Two join orders give them; the
one with less work is taken (``neighbours_first``):

* pairs -> the user's neighbours -> the neighbour's rating of the item, a
  lookup by a unique key: ``pairs x k`` rows, or a list of items for each
  neighbour (``asked``);
* pairs -> raters of the item -> the neighbour table on ``(user, neighbor)``:
  one row for each pair and rater, hot items split into blocks (``raters_of``).

Similarities under half a unit of the ninth decimal count as zero in the sums
(``ZERO_DIGITS``): summation noise of a true zero would otherwise become a
weight where it is a pair's only one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.functions.formulas import RANK_DIGITS, predict_from, round_half_up, safe_ratio
from kinrank.operators.neighbors import approx_knn, knn
from kinrank.operators.pairs import LIST_TASKS, HotItems, partner_lists, raters_of
from kinrank.operators.similarity import LIST, NEIGHBOR, id_type, long_users, mostly_once, pair_stats, self_similarity
from kinrank.operators.stats import Prepared, item_stats
from kinrank.session import materialize
from kinrank.sources.schema import ITEM, RATING, USER

PRED = "prediction"
ZERO_DIGITS = RANK_DIGITS
MOST_ASKING = 100_000  # users whose wanted items one neighbour is asked for in one task


def _with_user(prep: Prepared, pairs: DataFrame) -> DataFrame:
    return pairs.join(prep.ustats.select(USER, "user_avg"), USER, "left")


def finish(prep: Prepared, pairs: DataFrame, d: DataFrame | None) -> DataFrame:
    """Apply the prediction formula given per-pair deviations ``d``
    (``user_id, item_id, d``; absent = 0)."""
    x = _with_user(prep, pairs)
    if d is not None:
        x = x.join(d, [USER, ITEM], "left")
        dev = F.coalesce(F.col("d"), F.lit(0.0))
    else:
        dev = F.lit(0.0)
    pred = F.when(F.col("user_avg").isNull(), prep.g).otherwise(predict_from(F.col("user_avg"), dev))
    return x.withColumn(PRED, pred).drop("user_avg", "d")


def predict_global(prep: Prepared, pairs: DataFrame) -> DataFrame:
    return pairs.withColumn(PRED, prep.g)


def predict_user_avg(prep: Prepared, pairs: DataFrame) -> DataFrame:
    return (_with_user(prep, pairs)
            .withColumn(PRED, F.coalesce(F.col("user_avg"), prep.g)).drop("user_avg"))


def predict_item_avg(prep: Prepared, pairs: DataFrame) -> DataFrame:
    ia = item_stats(prep.train).select(ITEM, "item_avg")
    return (pairs.join(ia, ITEM, "left")
                 .withColumn(PRED, F.coalesce(F.col("item_avg"), prep.g)).drop("item_avg"))


def predict_baseline(prep: Prepared, pairs: DataFrame) -> DataFrame:
    """d = the item's mean normalised deviation (0 for an unknown item)."""
    return finish(prep, pairs, weighted_deviation_uniform(prep, pairs))


def weighted_deviation_uniform(prep: Prepared, pairs: DataFrame) -> DataFrame:
    """Uniform weights: ``sum(1 * dev) / sum(1)`` over the raters of the item,
    i.e. the item's mean deviation."""
    return (pairs.select(USER, ITEM)
                 .join(prep.item_dev.select(ITEM, F.col("avg_dev").alias("d")), ITEM))


def predict_uniform(prep: Prepared, pairs: DataFrame) -> DataFrame:
    """Uniform-similarity predictor; it coincides with the baseline."""
    return predict_baseline(prep, pairs)


def neighbours_first(pairs: DataFrame, per_user: int, hot: HotItems) -> bool:
    """Whether ``pairs x per_user`` rows are fewer than the rows of pairs with
    the raters of their items: both are added up over the whole tables."""
    row = (pairs.groupBy(ITEM).agg(F.count(F.lit(1)).alias("_p")).join(hot.counts, ITEM, "left")
           .agg(F.sum("_p").alias("pairs"), F.sum(F.col("_p") * F.coalesce("_n", F.lit(0))).alias("raters")).first())
    return (row["pairs"] or 0) * per_user < (row["raters"] or 0)


def weighted_deviation(prep: Prepared, pairs: DataFrame, nbrs: DataFrame, per_user: int | None = None,
                       hot: HotItems | None = None) -> DataFrame:
    """``user_id, item_id, d`` for pairs with at least one weighted rater.
    ``nbrs``: ``user_id, neighbor_id, sim``; ``per_user``: the most neighbours
    that a user has, if it is known."""
    raters = prep.dev.select(ITEM, F.col(USER).alias(NEIGHBOR), "dev")
    nb = nbrs.select(USER, NEIGHBOR, "sim")
    wanted = pairs.select(USER, ITEM)
    if per_user is not None and hot is not None and neighbours_first(wanted, per_user, hot):
        if mostly_once(prep, hot) and listable(prep, nb):
            cand = asked(wanted, nb, raters, hot.tasks(per_user * hot.rows))
            return _ratio(cand.groupBy(USER, ITEM).agg(*_sums()), USER, ITEM)
        cand = wanted.join(nb, USER).join(raters, [NEIGHBOR, ITEM])
    else:
        cand = raters_of(wanted, raters, NEIGHBOR, hot).join(nb, [USER, NEIGHBOR])
    return _ratio(cand.groupBy(USER, ITEM).agg(*_sums()), USER, ITEM)


def listable(prep: Prepared, nbrs: DataFrame) -> bool:
    """Whether no user has a long list and nobody is a neighbour of more users
    than ``MOST_ASKING``: what a neighbour is asked then fits in one task."""
    asking = nbrs.groupBy(NEIGHBOR).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("most")).first()["most"]
    return long_users(prep) is None and (asking or 0) <= MOST_ASKING


def asked(wanted: DataFrame, nb: DataFrame, raters: DataFrame, tasks: int) -> DataFrame:
    """``user_id, item_id, sim, dev``: the neighbours' ratings of the wanted
    items, as by ``wanted.join(nb, user).join(raters, (neighbour, item))``. A
    neighbour gets one row with all items of a user (``LIST`` at most), and
    meets its own ratings in the same partition."""
    at = Window.partitionBy(USER).orderBy(ITEM)
    items = (wanted.filter(F.col(USER).isNotNull() & F.col(ITEM).isNotNull())
             .withColumn("_part", F.floor(F.row_number().over(at) / LIST))
             .groupBy(USER, "_part").agg(F.collect_list(ITEM).alias("_items")))
    own = raters.filter(F.col(ITEM).isNotNull()).select(
        NEIGHBOR, F.lit(None).cast("bigint").alias(USER), F.lit(None).cast("double").alias("sim"),
        F.array(ITEM).alias("_items"), F.struct("dev").alias("_dev"))
    asks = items.join(nb, USER).select(NEIGHBOR, USER, "sim", "_items", F.lit(None).cast(own.schema["_dev"].dataType).alias("_dev"))
    every = asks.unionByName(own).repartition(tasks, NEIGHBOR).select(
        NEIGHBOR, USER, "sim", "_dev", F.explode("_items").alias(ITEM))
    met = every.withColumn("_devs", F.collect_list("_dev").over(Window.partitionBy(NEIGHBOR, ITEM)))
    return (met.filter(F.col("_dev").isNull() & (F.size("_devs") > 0))
            .select(USER, ITEM, "sim", F.explode("_devs").alias("_d")).select(USER, ITEM, "sim", "_d.dev"))


def _sums() -> list:
    return [F.sum(F.col("sim") * F.col("dev")).alias("_num"), F.sum(F.abs(F.col("sim"))).alias("_den")]


def _ratio(sums: DataFrame, *keys: str) -> DataFrame:
    return sums.select(*keys, safe_ratio(F.col("_num"), F.col("_den")).alias("d"))


def weighted_deviation_full(prep: Prepared, pairs: DataFrame, kind: str,
                            hot: HotItems | None = None, stats: DataFrame | None = None,
                            zero_digits: int = ZERO_DIGITS) -> DataFrame:
    """``d`` over every rater of the item, weighted by the full cosine or
    Jaccard similarity.

    Only the similarities of wanted pairs are aggregated: the (user, rater)
    pairs that the candidates need, as ``u < v``, reduce the pair emission by a
    semi-join before its aggregation. The candidates are written once, for the
    semi-join and for the join with the similarities, both keyed by ``(u, v)``.
    Where a pair is met about once (``mostly_once``) there is nothing to reduce:
    candidates and pairs go once into partitions by pair work, as lists where
    no item is hot and no user has a long list (``met_by_lists``).
    ``stats``: a written table of all pairs, where others need it too. The
    diagonal (a user rating the item itself) joins the per-user
    self-similarity.
    """
    col = "cos" if kind == "cosine" else "jac"

    def some(df: DataFrame) -> DataFrame:
        return df.filter(round_half_up(F.col("sim"), zero_digits) != 0)
    raters = prep.dev.select(ITEM, F.col(USER).alias(NEIGHBOR), "dev")
    diag = some(self_similarity(prep, kind)).select(USER, "sim")
    once = mostly_once(prep, hot)
    own = (pairs.select(USER, ITEM).join(prep.dev.select(USER, ITEM, "dev"), [USER, ITEM])
           .join(diag, USER).select(USER, ITEM, "sim", "dev"))
    if once and stats is None and hot.n == 0 and long_users(prep) is None:
        other = some(met_by_lists(prep, pairs, kind, hot))
        return _ratio(other.unionByName(own).groupBy(USER, ITEM).agg(*_sums()), USER, ITEM)
    met = raters_of(pairs.select(USER, ITEM), raters, NEIGHBOR, hot)
    cand = met.select(F.least(USER, NEIGHBOR).alias("u"), F.greatest(USER, NEIGHBOR).alias("v"), ITEM, "dev",
                      (F.col(USER) < F.col(NEIGHBOR)).alias("_first"))
    if once:  # both sides in partitions by pair work, no step between
        cand = cand.filter(F.col("u") < F.col("v")).repartition(hot.partitions, "u", "v")
        if stats is None:
            stats = pair_stats(prep, hot)
        else:
            stats = stats.select("u", "v", col).repartition(hot.partitions, "u", "v")
    elif stats is None:
        cand = materialize(cand, "candidates")
        wanted = materialize(cand.filter(F.col("u") < F.col("v")).select("u", "v").distinct(), "wanted-pairs")
        stats = pair_stats(prep, hot, wanted=wanted)
    sims = some(stats.select("u", "v", F.col(col).alias("sim")))
    other = cand.join(sims, ["u", "v"]).select(F.when(F.col("_first"), F.col("u")).otherwise(F.col("v")).alias(USER),
                                               ITEM, "sim", "dev")
    return _ratio(other.unionByName(own).groupBy(USER, ITEM).agg(*_sums()), USER, ITEM)


def met_by_lists(prep: Prepared, pairs: DataFrame, kind: str, hot: HotItems) -> DataFrame:
    """``user_id, item_id, sim, dev`` of each pair with each other rater of its
    item. The smaller user of two owns what both have in common: the lists of
    co-raters (``partner_lists``), of raters of a wanted item, and of users who
    want an item that it rated. All meet in the owner's partition, where a
    window over the two users adds up the similarity."""
    span, ids = prep.span(), id_type(prep)
    fact = "w" if kind == "cosine" else "n_user"
    own = partner_lists(prep.w, [fact], [fact], hot, ids).select(
        "u", F.lit(None).cast("bigint").alias(ITEM), F.lit(0).cast("tinyint").alias("_kind"),
        F.col(f"{fact}_u").cast("double").alias("_mine"), "_ids", F.col(f"_{fact}").cast("array<double>").alias("_theirs"))
    tasks = hot.tasks(hot.pairs / LIST_TASKS)
    known = F.col(ITEM).isNotNull() & F.col(USER).between(F.lit(span["low"]), F.lit(span["high"]))
    wanted = pairs.filter(known).select(USER, ITEM).repartition(tasks, ITEM)
    raters = prep.dev.filter(known).select(USER, ITEM, "dev").repartition(tasks, ITEM)
    lists = raters.groupBy(ITEM).agg(F.array_sort(F.collect_list(F.struct(USER, "dev"))).alias("_l")).select(
        ITEM, F.col(f"_l.{USER}").cast(f"array<{ids}>").alias("_ids"), F.col("_l.dev").alias("_theirs"))
    part = F.floor(F.row_number().over(Window.partitionBy(ITEM).orderBy(USER)) / hot.block)
    asking = (wanted.withColumn("_part", part).groupBy(ITEM, "_part").agg(F.array_sort(F.collect_list(USER)).alias("_l"))
              .select(ITEM, F.col("_l").cast(f"array<{ids}>").alias("_ids"), F.lit(None).cast("array<double>").alias("_theirs")))

    def later(left: DataFrame, right: DataFrame, number: int, mine) -> DataFrame:
        met = left.join(right, ITEM).withColumn("_n", F.size(F.filter("_ids", lambda x: x <= F.col(USER))))
        cut = [F.slice(c, F.col("_n") + 1, F.size("_ids")).alias(c) for c in ("_ids", "_theirs")]
        return met.filter(F.col("_n") < F.size("_ids")).select(
            F.col(USER).alias("u"), ITEM, F.lit(number).cast("tinyint").alias("_kind"), mine.alias("_mine"), *cut)
    every = (own.unionByName(later(wanted, lists, 1, F.lit(None).cast("double")))
             .unionByName(later(raters, asking, 2, F.col("dev")))).repartition(hot.tasks(2 * hot.pairs), "u")
    rows = every.select("u", ITEM, "_kind", "_mine", "_theirs", F.posexplode("_ids").alias("_p", "v"))
    rows = rows.withColumn("_theirs", F.get("_theirs", F.col("_p"))).filter(F.col("v") > F.col("u"))
    two, co = Window.partitionBy("u", "v"), F.col("_kind") == 0
    if kind == "cosine":
        sim = F.sum(F.when(co, F.col("_mine") * F.col("_theirs"))).over(two)
    else:
        common = F.sum(F.when(co, 1)).over(two)
        sim = common / (F.max(F.when(co, F.col("_mine"))).over(two) + F.max(F.when(co, F.col("_theirs"))).over(two) - common)
    first = F.col("_kind") == 1
    return rows.withColumn("sim", sim).filter(~co).select(
        F.when(first, F.col("u")).otherwise(F.col("v").cast("bigint")).alias(USER), ITEM, "sim",
        F.when(first, F.col("_theirs")).otherwise(F.col("_mine")).alias("dev"))


def predict_cosine(prep: Prepared, pairs: DataFrame, hot: HotItems | None = None,
                   stats: DataFrame | None = None) -> DataFrame:
    return finish(prep, pairs, weighted_deviation_full(prep, pairs, "cosine", hot, stats))


def predict_jaccard(prep: Prepared, pairs: DataFrame, hot: HotItems | None = None,
                    stats: DataFrame | None = None) -> DataFrame:
    return finish(prep, pairs, weighted_deviation_full(prep, pairs, "jaccard", hot, stats))


def _keep_known(prep: Prepared, pairs: DataFrame, predictor) -> DataFrame:
    """Known (user, item) ratings are returned as they are; only the rest
    is predicted."""
    known_r = prep.train.select(USER, ITEM, F.col(RATING).alias(PRED))
    known = pairs.join(known_r, [USER, ITEM])
    unknown = pairs.join(known_r.select(USER, ITEM), [USER, ITEM], "left_anti")
    return known.unionByName(predictor(unknown))


def predict_knn(prep: Prepared, pairs: DataFrame, k: int, keep_known: bool = False,
                hot: HotItems | None = None, nbrs: DataFrame | None = None) -> DataFrame:
    nb = nbrs if nbrs is not None else knn(prep, k, hot)

    def run(p):
        return finish(prep, p, weighted_deviation(prep, p, nb, per_user=k, hot=hot))
    return _keep_known(prep, pairs, run) if keep_known else run(pairs)


def predict_approx_knn(prep: Prepared, pairs: DataFrame, k: int, n_buckets: int,
                       replication: int, keep_known: bool = False,
                       hot: HotItems | None = None) -> DataFrame:
    nb = approx_knn(prep, k, n_buckets, replication, hot)
    return predict_knn(prep, pairs, k, keep_known=keep_known, hot=hot, nbrs=nb)


def predict_knn_sweep(prep: Prepared, pairs: DataFrame, ks: list[int], hot: HotItems | None = None,
                      nbrs: DataFrame | None = None) -> DataFrame:
    """Predictions for every k in ``ks`` from one ranking at ``max(ks)``.

    Each (pair, neighbour) row is summed into the first grid step whose k
    keeps it (``j = #{k in ks : k < pos}``), giving at most ``len(ks)``
    partial sums per pair; those are then spread to every k from step ``j``
    on and summed again. The neighbour table itself is never copied per k.
    Output: pairs columns, ``k``, prediction."""
    ks = sorted(int(k) for k in ks)
    nb = nbrs if nbrs is not None else knn(prep, ks[-1], hot)
    ks_arr = F.array(*[F.lit(k) for k in ks])
    raters = prep.dev.select(ITEM, F.col(USER).alias(NEIGHBOR), "dev")
    cand, nb = raters_of(pairs.select(USER, ITEM), raters, NEIGHBOR, hot), nb.select(USER, NEIGHBOR, "sim", "pos")
    if mostly_once(prep, hot):  # lists of every co-rater, as many rows as pairs
        cand, nb = (x.repartition(hot.partitions, USER, NEIGHBOR) for x in (cand, nb))
    cand = cand.join(nb, [USER, NEIGHBOR])
    step = F.size(F.filter(ks_arr, lambda k: k < F.col("pos")))
    part = (cand.withColumn("_j", step)
                .groupBy(USER, ITEM, "_j").agg(*_sums()))
    spread = part.withColumn("k", F.explode(F.slice(ks_arr, F.col("_j") + 1, F.lit(len(ks)) - F.col("_j"))))
    d = (spread.groupBy(USER, ITEM, "k")
               .agg(F.sum("_num").alias("_num"), F.sum("_den").alias("_den")))
    d = _ratio(d, USER, ITEM, "k")
    pk = pairs.withColumn("k", F.explode(ks_arr))
    x = _with_user(prep, pk).join(d, [USER, ITEM, "k"], "left")
    dev = F.coalesce(F.col("d"), F.lit(0.0))
    pred = F.when(F.col("user_avg").isNull(), prep.g).otherwise(predict_from(F.col("user_avg"), dev))
    return x.withColumn(PRED, pred).drop("user_avg", "d")
