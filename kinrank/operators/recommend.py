"""Top-n recommendations of unrated items, by the kNN predictor.

Scoring every user x item is never done. An unrated item that no neighbour
of ``u`` rated predicts exactly ``ua(u)`` (d = 0), so such items only matter
as ties at that value, broken by the smaller item id. Per user:

1. *reached* items: rated by a neighbour, not by ``u`` -> scored;
2. *fill* items, only for users with fewer than ``n`` reached items ranked
   strictly above ``ua(u)``: the ``n`` smallest-id items outside
   ``rated(u) + reached(u)`` -> ``ua(u)`` (or the global average for an
   unknown user), see ``first_unseen``;
3. ``row_number() over (user order by prediction desc, item asc) <= n``.

Work per user is bounded by what step 1 already touched, plus ``n``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinrank.functions.formulas import RATING_HI, RATING_LO, predict_from, rank_key, safe_ratio
from kinrank.functions.ranking import dense_index
from kinrank.operators.neighbors import knn
from kinrank.operators.pairs import HotItems
from kinrank.operators.predict import PRED, predict_baseline, predict_global, predict_item_avg, predict_user_avg
from kinrank.operators.similarity import NEIGHBOR
from kinrank.operators.stats import Prepared, item_stats
from kinrank.session import materialize
from kinrank.sources.schema import ITEM, USER


LISTED = 1000  # users of one block of ``unrated_items``


def unrated_items(ratings: DataFrame, user_ids: list[int], block: int = LISTED) -> DataFrame:
    """``user_id, item_id`` of items in ``ratings`` that each listed user has
    not rated: users x items rows by nature, made in blocks of ``block``
    users. For everybody's best items see ``recommend`` and
    ``recommend_ranked``, for their number ``unrated_counts``."""
    items = ratings.select(ITEM).distinct()
    parts = []
    for i in range(0, max(1, len(user_ids)), block):
        ids = F.array(*[F.lit(int(u)) for u in user_ids[i:i + block]]).cast("array<bigint>")
        parts.append(items.select(F.explode(ids).alias(USER), ITEM))
    return (reduce(DataFrame.unionByName, parts)
            .join(ratings.select(USER, ITEM), [USER, ITEM], "left_anti"))


def unrated_counts(ratings: DataFrame) -> DataFrame:
    """``user_id, n_candidates`` = number of items the user has not rated,
    for every user (arithmetic on counts, no pairs)."""
    n_items = ratings.select(ITEM).distinct().agg(F.count(F.lit(1))).scalar()
    return (ratings.groupBy(USER).agg(F.countDistinct(ITEM).alias("_n"))
                   .select(USER, (n_items - F.col("_n")).alias("n_candidates")))


def union_personal(ratings: DataFrame, personal: DataFrame) -> DataFrame:
    return ratings.select(USER, ITEM, "rating").unionByName(personal.select(USER, ITEM, "rating"))


def recommend(prep: Prepared, users: DataFrame | None, n: int, k: int,
              hot: HotItems | None = None, nbrs: DataFrame | None = None) -> DataFrame:
    """``user_id, rank, item_id, prediction`` — the top ``n`` unrated items of
    each user in ``users`` (one column ``user_id``; ``None`` = every train
    user, which takes the undirected kNN path and skips the restriction)."""
    # ``rated`` comes from the deviation table (the prepared, written one in
    # pair-based use), not from the raw input: if that input is a union with
    # a branch whose user id is a literal, a semi-join pushed into that branch
    # would lose its equi-join key and turn into a nested-loop join.
    every = users is None
    if every:
        users = prep.ustats.select(USER)
        nb = nbrs if nbrs is not None else knn(prep, k, hot)
        nb = nb.select(USER, NEIGHBOR, "sim")
        rated = prep.dev.select(USER, ITEM)
    else:
        users = users.select(USER).distinct()
        nb = nbrs if nbrs is not None else knn(prep, k, hot, users=users)
        nb = nb.join(users, USER, "left_semi").select(USER, NEIGHBOR, "sim")
        rated = prep.dev.select(USER, ITEM).join(users, USER, "left_semi")
    raters = prep.dev.select(F.col(USER).alias(NEIGHBOR), ITEM, "dev")

    # all rows of a user in one partition, its ratings among them: sums, what it
    # rated and the ranking need no other shuffle
    tasks = hot.tasks(k * hot.rows) if every and hot is not None else None

    def reached(nb: DataFrame, rated: DataFrame) -> DataFrame:
        met = nb.join(raters, NEIGHBOR).select(USER, ITEM, (F.col("sim") * F.col("dev")).alias("_x"),
                                               F.abs(F.col("sim")).alias("_s"), F.lit(False).alias("_rated"))
        own = rated.filter(F.col(ITEM).isNotNull()).select(USER, ITEM, F.lit(None).cast("double").alias("_x"),
                                                           F.lit(None).cast("double").alias("_s"),
                                                           F.lit(True).alias("_rated"))
        both = met.unionByName(own)
        both = both.repartition(tasks, USER) if tasks else both.repartition(USER)
        return (both.groupBy(USER, ITEM).agg(F.sum("_x").alias("_num"), F.sum("_s").alias("_den"),
                                             F.max("_rated").alias("_rated")).filter(~F.col("_rated")))
    ua = users.join(prep.ustats.select(USER, "user_avg"), USER, "left")
    base = F.coalesce(F.col("user_avg"), prep.g)
    w = Window.partitionBy(USER).orderBy(rank_key(F.col(PRED)).desc(), F.col(ITEM).asc())
    found = reached(nb, rated).join(ua, USER).select(USER, ITEM, "user_avg", predict_from(
        F.col("user_avg"), safe_ratio(F.col("_num"), F.col("_den"))).alias(PRED))
    # written once, at most n rows a user: the per-user counts and the ranking read it
    scored = materialize(found.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank"),
                         "scored")

    # fill: smallest-id items outside rated + reached, predicted ua(u). They can
    # enter the top n only for a user with fewer than n reached items ranked
    # strictly above ua(u) (same rounded key as the final ordering), so the
    # fill is computed for those users alone.
    above = (scored.groupBy(USER)
                   .agg(F.sum(F.when(rank_key(F.col(PRED)) > rank_key(F.col("user_avg")), 1)
                             .otherwise(0)).alias("_above")))
    needy = materialize(users.join(above, USER, "left")
                        .filter(F.coalesce(F.col("_above"), F.lit(0)) < n).select(USER), "needy")
    again = reached(*(x.join(needy, USER, "left_semi") for x in (nb, rated)))
    seen = rated.join(needy, USER, "left_semi").unionByName(again.select(USER, ITEM))
    fill = (first_unseen(needy, seen, item_order(prep.dev.select(ITEM), F.lit(0)), n).join(ua, USER)
            .select(USER, ITEM, base.alias(PRED)))

    cands = scored.drop("user_avg").unionByName(fill)
    return (cands.withColumn("rank", F.row_number().over(w).cast("bigint"))
                 .filter(F.col("rank") <= n)
                 .select(USER, "rank", ITEM, PRED))


def item_order(items: DataFrame, key: Column) -> DataFrame:
    """``item_id, _rank``: the distinct items numbered by ``key`` descending,
    equal keys by the smaller id."""
    order = items.select(F.struct((-key).alias("key"), F.col(ITEM).alias("item")).alias("_order"))
    return dense_index(order, "_order", "_rank").select(F.col("_order.item").alias(ITEM), "_rank")


def first_unseen(users: DataFrame, seen: DataFrame, index: DataFrame, n: int,
                 chunk: int = 32, per_copy: int = 10_000) -> DataFrame:
    """``user_id, item_id``: for each user the first ``n`` items of ``index``
    (``item_id, _rank`` from 1, see ``item_order``) outside its ``seen`` rows.

    The order is cut into chunks of ``chunk`` items (at least ``n``). A chunk
    can hold an answer only while fewer than ``n`` unseen items stand before
    it, and since an unseen chunk has ``chunk`` of them, such a chunk is the
    first one, one with seen items, or the next after one with seen items.
    These few (user, chunk) rows meet the chunk's items. The first chunks are
    everybody's: a chunk has a copy for each ``per_copy`` users who need it,
    counted before, and the users are dealt over the copies by a hash.
    """
    chunk = max(chunk, n)
    index = materialize(index.withColumn("_chunk", F.floor((F.col("_rank") - 1) / chunk)), "item-index")
    seen = materialize(seen.select(USER, ITEM), "seen")
    before = Window.partitionBy(USER).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    taken = (seen.join(index, ITEM).groupBy(USER, "_chunk").agg(F.count(F.lit(1)).alias("_c"))
             .withColumn("_upto", F.sum("_c").over(before)))
    start = F.col("_chunk") * chunk
    need = (users.select(USER, F.lit(0).cast("bigint").alias("_chunk"))
            .unionByName(taken.filter(start - (F.col("_upto") - F.col("_c")) < n).select(USER, "_chunk"))
            .unionByName(taken.filter(start + chunk - F.col("_upto") < n)
                         .select(USER, (F.col("_chunk") + 1).alias("_chunk"))).distinct())
    need = materialize(need, "need")
    spread = need.groupBy("_chunk").agg(F.ceil(F.count(F.lit(1)) / F.lit(per_copy)).cast("int").alias("_copies"))
    copies = (index.join(spread, "_chunk")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies"))
    # a chunk's number of copies is one number a chunk: thousands of users a row
    dealt = (need.join(spread, "_chunk")
             .withColumn("_salt", F.pmod(F.xxhash64(USER), F.col("_copies")).cast("int")).drop("_copies"))
    order = Window.partitionBy(USER).orderBy("_rank")
    return (dealt.join(copies, ["_chunk", "_salt"]).join(seen, [USER, ITEM], "left_anti")
            .withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).select(USER, ITEM))


def recommend_ranked(prep: Prepared, kind: str, n: int, users: DataFrame | None = None) -> DataFrame:
    """``user_id, rank, item_id, prediction``: the top ``n`` unrated items of
    every train user (or of the train users in ``users``) by a predictor whose
    order of items is the same for all: ``global``, ``user_avg`` (equal for
    all items: by id), ``item_avg`` (by the item's average) and ``baseline``.

    The items are ranked once and each user takes the first ``n`` unseen ones,
    so nothing of users x items is scored. The baseline grows with the item's
    average deviation, except that for a user whose average is the scale's
    upper end all deviations from 0 up predict that end, and at the lower end
    all from 0 down; these users have orders of their own. Averages and
    deviations that agree at nine decimals are equal.
    """
    who = prep.ustats.select(USER, "user_avg")
    if users is not None:
        who = who.join(users.select(USER).distinct(), USER, "left_semi")
    rated = prep.dev.select(USER, ITEM)
    if kind in ("global", "user_avg"):
        orders = [(F.lit(True), prep.dev.select(ITEM), F.lit(0.0))]
    elif kind == "item_avg":
        orders = [(F.lit(True), item_stats(prep.train), rank_key("item_avg"))]
    elif kind == "baseline":
        d, top, low = rank_key("avg_dev"), F.col("user_avg") >= RATING_HI, F.col("user_avg") <= RATING_LO
        orders = [(~top & ~low, prep.item_dev, d), (top, prep.item_dev, F.least(d, F.lit(0.0))),
                  (low, prep.item_dev, F.greatest(d, F.lit(0.0)))]
    else:
        raise ValueError(f"no order of items that holds for all users: {kind}")
    found = []
    for some, items, key in orders:
        group = materialize(who.filter(some).select(USER), "ranked-users")
        if group.isEmpty():
            continue
        index = item_order(items, key)
        seen = rated if len(orders) == 1 and users is None else rated.join(group, USER, "left_semi")
        index = materialize(index, "order")
        found.append(first_unseen(group, seen, index, n).join(index, ITEM))
    if not found:
        found = [who.limit(0).select(USER, F.lit(0).cast("bigint").alias(ITEM), F.lit(0).cast("bigint").alias("_rank"))]
    picked = reduce(DataFrame.unionByName, found)
    predict = {"global": predict_global, "user_avg": predict_user_avg, "item_avg": predict_item_avg,
               "baseline": predict_baseline}[kind]
    w = Window.partitionBy(USER).orderBy("_rank")
    return (predict(prep, picked).withColumn("rank", F.row_number().over(w).cast("bigint"))
            .select(USER, "rank", ITEM, PRED))


def recommend_by(ratings: DataFrame, user_ids: list[int], n: int, predictor) -> DataFrame:
    """``user_id, rank, item_id, prediction``: the top ``n`` unrated items of
    each listed user by any predictor (``pairs -> pairs + prediction``). Every
    unrated item of these users is scored, in blocks of users;
    ``recommend_ranked`` and ``recommend`` serve everybody without that."""
    scored = predictor(unrated_items(ratings, user_ids))
    w = Window.partitionBy(USER).orderBy(rank_key(F.col(PRED)).desc(), F.col(ITEM).asc())
    return (scored.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= n)
            .select(USER, "rank", ITEM, PRED))
