"""User-user similarities from one co-rated pair emission.

    cos(u,v) = sum over common items of w(u,i) * w(v,i)
    jac(u,v) = |I(u) & I(v)| / (|I(u)| + |I(v)| - |I(u) & I(v)|)

Per-user facts (``w``, the user's item count) ride on the rating rows, so
the pair rows carry everything and a single ``groupBy(u, v)`` (partial
aggregation before its shuffle) yields cosine, Jaccard and the common-item
count together; no per-pair lookups, no extra joins. Given pairs are compared by the
users' lists, the shorter one leading, where that sends fewer list entries than
the pair join has rows; else their sums are picked from the pair join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinrank.operators.pairs import HotItems, Shared, corated, partner_lists, partners
from kinrank.operators.stats import Prepared
from kinrank.session import materialize
from kinrank.sources.schema import ITEM, USER

NEIGHBOR = "neighbor_id"


# Users of up to so many ratings are compared as whole lists.
LIST = 1024
# The pair join's rows, times this, are fewer than the pairs of users: sparse.
SPARSE = 4


def pair_stats(prep: Prepared, hot: HotItems | None = None, left_users: DataFrame | None = None,
               directed: bool = False, wanted: DataFrame | None = None, shared: Shared | None = None) -> DataFrame:
    """``u, v, n_common, cos, jac`` for co-rated pairs (``u < v`` unless
    ``directed``). With ``wanted`` (distinct ``u, v`` in the same sense) only
    these pairs are made: rows of other users never enter the join, and other
    pairs of theirs leave before the aggregation. With ``shared`` all pairs
    have ``_seen`` too, the groups that both users share (``Shared.of``)."""
    if wanted is None and left_users is None and not directed and mostly_once(prep, hot):
        return _listed_stats(prep, hot, shared=shared)
    if shared is not None:
        return _seen(prep, _pair_rows(prep, hot), shared)
    return _stats(_pair_rows(prep, hot, left_users, directed, wanted).groupBy("u", "v"))


def _seen(prep: Prepared, pairs: DataFrame, shared: Shared, strict: bool = False) -> DataFrame:
    """``_stats`` of pair rows with ``_seen``, looked up once a pair."""
    out = _stats(pairs.groupBy("u", "v"), strict)
    for side in "uv":
        out = out.join(shared.rows.select(F.col(USER).alias(side), *[F.col(w).alias(f"{w}_{side}") for w in shared.words]), side)
    return out.select("u", "v", "n_common", "cos", "jac",
                      shared.of(lambda w: F.col(f"{w}_u"), lambda w: F.col(f"{w}_v")).alias("_seen"))


def _listed_stats(prep: Prepared, hot: HotItems, strict: bool = False, shared: Shared | None = None) -> DataFrame:
    """``pair_stats`` of all pairs by lists (``partners``), u in one partition;
    pairs of a ``u`` with a long list by pair rows."""
    long = long_users(prep)
    rows = prep.w.select(USER, ITEM, "w", "n_user")
    if shared is not None:
        rows = rows.join(shared.rows, USER)
    p = partners(rows, ["w", "n_user"], ["w", "n_user"], hot, id_type(prep), owner=short_list(long), shared=shared)
    more = [] if shared is None else ["_seen"]
    p = p.select("u", "v", (F.col("w_u") * F.col("w_v")).alias("_x"), "n_user_u", "n_user_v", *more)
    out = _stats(p.groupBy("u", "v", *more), strict, more)
    if long is not None:
        pairs = _pair_rows(prep, hot, long)
        out = out.unionByName(_stats(pairs.groupBy("u", "v"), strict) if shared is None else _seen(prep, pairs, shared, strict))
    return out


def id_type(prep: Prepared) -> str:
    """The smallest type that holds all user ids."""
    span = prep.span()
    low, high = span["low"] or 0, span["high"] or 0
    return "int" if low >= -(1 << 31) and high < 1 << 31 else "bigint"


def short_list(long: DataFrame | None) -> Column | None:
    """Which rows of ``prep.w`` are of users outside ``long_users``; ``None``: all."""
    return None if long is None else F.col("n_user") <= LIST


def long_users(prep: Prepared) -> DataFrame | None:
    """``user_id`` of those with more than ``LIST`` ratings, ``None`` without any."""
    if (prep.span()["most"] or 0) <= LIST:
        return None
    return prep.ustats.filter(F.col("n") > LIST).select(USER)


def _pair_rows(prep: Prepared, hot: HotItems | None = None, left_users: DataFrame | None = None,
               directed: bool = False, wanted: DataFrame | None = None) -> DataFrame:
    """``u, v, _x`` and both users' counts: a row for each pair and shared item."""
    rows = prep.w.select(USER, ITEM, "w", "n_user")
    right_users = None
    if wanted is not None:
        left_users = wanted.select(F.col("u").alias(USER)).distinct()
        right_users = wanted.select(F.col("v").alias(USER)).distinct()
    p = corated(rows, ["w", "n_user"], hot=hot, left_users=left_users, right_users=right_users, directed=directed)
    p = p.select("u", "v", (F.col("w_u") * F.col("w_v")).alias("_x"), "n_user_u", "n_user_v")
    if wanted is not None:
        p = p.join(wanted.select("u", "v"), ["u", "v"], "left_semi")
    return p


def mostly_once(prep: Prepared, hot: HotItems | None) -> bool:
    """Whether the pair join's rows are few beside all pairs of users. Then a
    pair is met about once, adding up before the shuffle spares nothing, and
    the pairs go as lists to as many tasks as their number asks for: a task's
    pairs fit in memory whatever the session's number of partitions."""
    if hot is None:
        return False
    n = prep.span()["users"]
    return SPARSE * hot.pairs < n * (n - 1) / 2


def _stats(grouped, strict: bool = False, more: list[str] | None = None) -> DataFrame:
    """With ``strict`` the cosine is null if a shared item's weight is, as by lists."""
    dot = F.when(F.count("_x") == F.count(F.lit(1)), F.sum("_x")) if strict else F.sum("_x")
    agg = grouped.agg(F.count(F.lit(1)).alias("n_common"), dot.alias("cos"),
                      F.max("n_user_u").alias("n_u"), F.max("n_user_v").alias("n_v"))
    return agg.select("u", "v", "n_common", "cos",
                      (F.col("n_common") / (F.col("n_u") + F.col("n_v") - F.col("n_common"))).alias("jac"),
                      *(more or []))


def user_lists(prep: Prepared, most: int = LIST) -> DataFrame:
    """``user_id, items, ws``: the sorted items of each user with at most
    ``most`` ratings, and their weights in that order."""
    rows = prep.w.filter(F.col("n_user") <= most)
    both = F.array_sort(F.collect_list(F.struct(F.col(ITEM).alias("i"), F.col("w").alias("w"))))
    lists = rows.groupBy(USER).agg(both.alias("_l"))
    return lists.select(USER, F.transform("_l", lambda x: x["i"]).alias("items"),
                        F.transform("_l", lambda x: x["w"]).alias("ws"))


def _led(prep: Prepared, pairs: DataFrame) -> DataFrame:
    """Distinct given pairs with their counts (null: unknown), and which of the
    two has the shorter list (``lead``) and the longer one (``other``)."""
    n = prep.ustats.select(F.col(USER).alias("_id"), F.col("n").alias("_n"))
    p = (pairs.select("u", "v").distinct()
         .join(n.select(F.col("_id").alias("u"), F.col("_n").alias("n_u")), "u", "left")
         .join(n.select(F.col("_id").alias("v"), F.col("_n").alias("n_v")), "v", "left"))
    first = (F.col("n_u") < F.col("n_v")) | ((F.col("n_u") == F.col("n_v")) & (F.col("u") <= F.col("v")))
    return p.select("u", "v", "n_u", "n_v", F.when(first, F.col("u")).otherwise(F.col("v")).alias("lead"),
                    F.when(first, F.col("v")).otherwise(F.col("u")).alias("other"),
                    F.when(F.col("n_u").isNotNull() & F.col("n_v").isNotNull(), F.greatest("n_u", "n_v")).alias("_longer"))


def _intersected(prep: Prepared, led: DataFrame, most: int) -> DataFrame:
    """Pairs of users with lists: the shorter list goes to the longer one, one
    row a pair, with ``common``, the items of both, and all four lists."""
    lists = user_lists(prep, most)
    short = lists.select(F.col(USER).alias("lead"), F.col("items").alias("_i"), F.col("ws").alias("_w"))
    long = lists.select(F.col(USER).alias("other"), F.col("items").alias("_j"), F.col("ws").alias("_x"))
    return (led.filter(F.col("_longer") <= most).join(short, "lead").join(long, "other")
            .withColumn("common", F.array_intersect("_i", "_j")))


def _looked_up(prep: Prepared, led: DataFrame, most: int) -> DataFrame:
    """Pairs with a longer list: one row for each item of the shorter list,
    looked up by the unique key ``(other, item)``."""
    first = prep.w.select(F.col(USER).alias("lead"), ITEM, F.col("w").alias("w_u"))
    second = prep.w.select(F.col(USER).alias("other"), ITEM, F.col("w").alias("w_v"))
    return led.filter(F.col("_longer") > most).join(first, "lead").join(second, ["other", ITEM])


def _split(prep: Prepared, pairs: DataFrame, hot: HotItems | None) -> tuple[DataFrame, DataFrame | None]:
    """The distinct given pairs: those to compare by lists, and those to pick
    from the pair join. A pair sends two lists, of a user's mean length in the
    estimate; the pair join makes ``hot.pairs`` rows whatever is given. Pairs
    of a user with itself always go by lists: the pair join has none."""
    if hot is None:
        return pairs, None
    given = materialize(pairs.select("u", "v").distinct(), "given-pairs")
    users = prep.ustats.agg(F.count(F.lit(1)).alias("users"), F.sum("n").alias("rows")).first()
    if 2.0 * given.count() * (users["rows"] or 0) <= hot.pairs * users["users"]:
        return given, None
    own = F.col("u").eqNullSafe(F.col("v"))
    return given.filter(own), given.filter(~own)


def _keyed(given: DataFrame, hot: HotItems) -> DataFrame:
    """The pairs with the pair join's key, ``_a < _b``, in partitions by pair work."""
    return given.select("u", "v", F.least("u", "v").alias("_a"), F.greatest("u", "v").alias("_b")).repartition(
        hot.partitions, "_a", "_b")


def similarity_of(prep: Prepared, pairs: DataFrame, most: int = LIST, hot: HotItems | None = None) -> DataFrame:
    """``u, v, n_common, cos, jac`` for each given pair (distinct); zeros
    where the users share no item or one of them is unknown. With ``hot`` the
    pairs come from the pair join where they are too many for lists
    (``_split``)."""
    few, many = _split(prep, pairs, hot)
    by_list = _similarity_by_list(prep, few, most)
    if many is None:
        return by_list
    # by both users, as they meet the given pairs: sums by lists would be shuffled again
    every = _pair_rows(prep, hot)
    if mostly_once(prep, hot):
        every = every.repartition(hot.partitions, "u", "v")
    every = _stats(every.groupBy("u", "v"), strict=True)
    sums = every.select(
        F.col("u").alias("_a"), F.col("v").alias("_b"), "n_common", "cos", "jac")
    met = _keyed(many, hot).join(sums.repartition(hot.partitions, "_a", "_b"), ["_a", "_b"], "left")
    none = F.col("n_common").isNull()
    return by_list.unionByName(met.select(
        "u", "v", F.coalesce("n_common", F.lit(0)).alias("n_common"),
        F.when(none, F.lit(0.0)).otherwise(F.col("cos")).alias("cos"), F.coalesce("jac", F.lit(0.0)).alias("jac")))


def _similarity_by_list(prep: Prepared, pairs: DataFrame, most: int) -> DataFrame:
    """Lists of up to ``most`` items are intersected whole, so no more rows
    than pairs arise; longer ones are looked up item by item of the shorter
    list."""
    led = materialize(_led(prep, pairs), "led-pairs")
    dot = F.aggregate("common", F.lit(0.0), lambda acc, x: acc + F.element_at("_w", F.array_position("_i", x).cast("int"))
                      * F.element_at("_x", F.array_position("_j", x).cast("int")))
    by_list = _intersected(prep, led, most).select("u", "v", F.size("common").cast("bigint").alias("n_common"),
                                                   dot.alias("cos"), "n_u", "n_v")
    sums = (_looked_up(prep, led, most).groupBy("u", "v")
            .agg(F.count(F.lit(1)).alias("n_common"), F.sum(F.col("w_u") * F.col("w_v")).alias("cos")))
    rest = led.filter(F.col("_longer").isNull() | (F.col("_longer") > most))
    by_item = rest.join(sums, ["u", "v"], "left").select(
        "u", "v", F.coalesce("n_common", F.lit(0)).alias("n_common"), F.coalesce("cos", F.lit(0.0)).alias("cos"),
        "n_u", "n_v")
    jac = F.col("n_common") / (F.col("n_u") + F.col("n_v") - F.col("n_common"))
    return by_list.unionByName(by_item).select("u", "v", "n_common", "cos", F.coalesce(jac, F.lit(0.0)).alias("jac"))


def common_items_of(prep: Prepared, pairs: DataFrame, most: int = LIST, hot: HotItems | None = None) -> DataFrame:
    """``u, v, item_id``: the items that both users of each given pair rated.
    With ``hot`` from the pair join where the pairs are too many for lists."""
    few, many = _split(prep, pairs, hot)
    led = materialize(_led(prep, few), "led-pairs")
    by_list = _intersected(prep, led, most).select("u", "v", F.explode("common").alias(ITEM))
    by_list = by_list.unionByName(_looked_up(prep, led, most).select("u", "v", ITEM))
    if many is None:
        return by_list
    if mostly_once(prep, hot) and long_users(prep) is None:
        return by_list.unionByName(_common_by_partner_lists(prep, many, hot))
    met = corated(prep.w.select(USER, ITEM), [], hot=hot).select(F.col("u").alias("_a"), F.col("v").alias("_b"), ITEM)
    met = _keyed(many, hot).join(met.repartition(hot.partitions, "_a", "_b"), ["_a", "_b"])
    return by_list.unionByName(met.select("u", "v", ITEM))


def _common_by_partner_lists(prep: Prepared, given: DataFrame, hot: HotItems) -> DataFrame:
    """``u, v, item_id`` of given pairs of two users: they meet the lists of
    co-raters in the smaller user's partition."""
    ids, span = id_type(prep), prep.span()
    known = [F.col(c).between(F.lit(span["low"]), F.lit(span["high"])) for c in "uv"]
    asked = given.filter(known[0] & known[1]).select(
        F.least("u", "v").alias("u"), F.lit(None).cast("bigint").alias(ITEM),
        F.array(F.greatest("u", "v").cast(ids)).alias("_ids"), F.when(F.col("u") < F.col("v"), 1).otherwise(2).alias("_kind"))
    lists = partner_lists(prep.w, [], [], hot, ids).select("u", ITEM, "_ids", F.lit(0).alias("_kind"))
    rows = lists.unionByName(asked).repartition(hot.tasks(2 * hot.pairs), "u").select(
        "u", ITEM, "_kind", F.explode("_ids").alias("v")).select("u", F.col("v").cast("bigint").alias("v"), ITEM, "_kind")
    shared = F.collect_list(F.when(F.col("_kind") == 0, F.col(ITEM))).over(Window.partitionBy("u", "v"))
    met = rows.filter(F.col("v") > F.col("u")).withColumn("_items", shared).filter(F.col("_kind") > 0)
    first = F.col("_kind") == 1
    return met.select(F.when(first, F.col("u")).otherwise(F.col("v")).alias("u"),
                      F.when(first, F.col("v")).otherwise(F.col("u")).alias("v"), F.explode("_items").alias(ITEM))


def common_items(prep: Prepared, hot: HotItems | None = None) -> DataFrame:
    """``u, v, n_common`` for every co-rated pair, ``u < v``."""
    return pair_stats(prep, hot).select("u", "v", "n_common")


def cosine_similarity(prep: Prepared, hot: HotItems | None = None) -> DataFrame:
    """``u, v, sim`` (adjusted cosine), ``u < v``; only co-rated pairs."""
    return pair_stats(prep, hot).select("u", "v", F.col("cos").alias("sim"))


def jaccard_similarity(prep: Prepared, hot: HotItems | None = None) -> DataFrame:
    return pair_stats(prep, hot).select("u", "v", F.col("jac").alias("sim"))


def directed(sims: DataFrame, sim_col: str = "sim", *more: str) -> DataFrame:
    """``user_id, neighbor_id, sim`` (and the columns ``more``) in both directions from a ``u < v``
    table. The two branches share the aggregate's shuffle (exchange reuse)."""
    a = sims.select(F.col("u").alias(USER), F.col("v").alias(NEIGHBOR), F.col(sim_col).alias("sim"), *more)
    b = sims.select(F.col("v").alias(USER), F.col("u").alias(NEIGHBOR), F.col(sim_col).alias("sim"), *more)
    return a.unionByName(b)


def self_similarity(prep: Prepared, kind: str) -> DataFrame:
    """The diagonal that full neighbourhoods include: ``cos(u,u) = sum w^2``
    (1, or 0 for a zero-norm user) and ``jac(u,u) = 1``."""
    if kind == "cosine":
        diag = prep.w.groupBy(USER).agg(F.sum(F.col("w") * F.col("w")).alias("sim"))
    else:
        diag = prep.ustats.select(USER, F.lit(1.0).alias("sim"))
    return diag.select(USER, F.col(USER).alias(NEIGHBOR), "sim")
