"""k nearest neighbours, exact and over replicated user buckets.

Position rule (a user's candidates are *all* other train users, zeros
included, sorted by similarity with ties to the larger id):

    positive s:  pos = rank among positives by (s desc, neighbor desc)
    negative s:  pos = (N - 1 - n_neg(u)) + rank among negatives by (s desc, neighbor desc)

with ``N`` the number of train users; zero-similarity users fill the slots in
between without being materialised. Keep ``pos <= k``. The ranking is one
``row_number() <= k`` filter, which Spark plans as a partial top-k before the
shuffle (WindowGroupLimit), so no task receives a user's whole neighbour list.
Similarities are compared at 9 decimals (``rank_key``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinrank.functions.formulas import rank_key
from kinrank.operators.pairs import DEFAULT_BLOCK, HotItems, Shared, corated, partners
from kinrank.operators.similarity import NEIGHBOR, directed, id_type, long_users, mostly_once, pair_stats, short_list
from kinrank.operators.stats import Prepared
from kinrank.session import materialize
from kinrank.sources.schema import ITEM, USER

# The bucket hash (multiplicative hash reduced modulo the
# Mersenne prime 2^31 - 1, then squared so buckets are not shifts of each other).
HASH_MOD = 2147483647
HASH_MUL = 506952114          # 2654435761 mod (2^31 - 1)
HASH_BUCKET_MUL = 320743257   # 40503 * 7919
HASH_SEED = 1337

# A weight (-1 to 1) goes through the lists of ``close_pairs`` as one of so many steps.
STEPS = 127


def bucket_hash(user: Column, bucket) -> Column:
    """Portable integer hash of (user, bucket); all BIGINT, no overflow."""
    b = bucket if isinstance(bucket, Column) else F.lit(bucket)
    h1 = ((user % HASH_MOD) * HASH_MUL + b.cast("bigint") * HASH_BUCKET_MUL + HASH_SEED) % HASH_MOD
    return (h1 * h1) % HASH_MOD


def ranked_top(sims: DataFrame, k: int, by: tuple[str, ...] = (USER,), partitions: int | None = None) -> DataFrame:
    """``by, _rn, neighbor_id, sim, _sr``: the ``k`` largest non-zero
    similarities of each group by (s desc, neighbor desc). With ``partitions``
    the rows go straight to so many tasks by user, where they are ranked:
    for groups so spread that a top-k before the shuffle spares nothing, and
    would sort all rows once more."""
    if partitions:
        sims = sims.filter(rank_key(F.col("sim")) != 0).select(*by, NEIGHBOR, "sim").repartition(partitions, USER)
    nz = sims.withColumn("_sr", rank_key(F.col("sim"))).filter(F.col("_sr") != 0)
    win = Window.partitionBy(*by).orderBy(F.col("_sr").desc(), F.col(NEIGHBOR).desc())
    top = nz.withColumn("_rn", F.row_number().over(win)).filter(F.col("_rn") <= k)
    return top.select(*by, "_rn", NEIGHBOR, "sim", "_sr")


def top_similarities(sims: DataFrame, k: int, by: tuple[str, ...] = (USER,),
                     partitions: int | None = None) -> DataFrame:
    """``ranked_top``, written. The similarities stream from their aggregation
    through a partial top-k into the shuffle (with ``partitions`` as they are);
    at most ``groups x k`` rows are written."""
    return materialize(ranked_top(sims, k, by, partitions), "top-similarities")


def ranking_tasks(prep: Prepared, hot: HotItems | None, pairs: float | None = None) -> int | None:
    """Partitions to rank all pairs by user, ``None`` where a user meets the same
    users often and a top-k before the shuffle is worth it."""
    if not mostly_once(prep, hot):
        return None
    return hot.partitions if pairs is None else hot.tasks(pairs)


def low_users(prep: Prepared, k: int, hot: HotItems | None = None, users: DataFrame | None = None) -> DataFrame:
    """``user_id`` of those (of ``users``, if given) whose list of ``k`` may
    reach a negative similarity. The first negative stands at ``N -
    n_negative`` at the earliest, and no user has more co-raters than the
    other ratings of their items: all others need no negatives."""
    n = hot.counts if hot is not None else prep.train.groupBy(ITEM).agg(F.count(F.lit(1)).alias("_n"))
    rows = prep.w.select(USER, ITEM)  # the written rows: a literal user in a union would lose the semi-join's key
    if users is not None:
        rows = rows.join(users.select(USER), USER, "left_semi")
    met = rows.join(n.select(ITEM, "_n"), ITEM).groupBy(USER).agg(F.sum(F.col("_n") - 1).alias("_met"))
    return met.filter(F.col("_met") >= prep.n_users() - k).select(USER)


def place(top: DataFrame, n_users: Column, k: int, counts, by: tuple[str, ...] = (USER,),
          low: DataFrame | None = None) -> DataFrame:
    """``by, pos, neighbor_id, sim`` for ``pos <= k`` from the top rows.

    Positives come first, so for them ``pos = rn``. A negative is among the
    top ``k`` only when its group has fewer than ``k`` positives; the zeros
    stand before it: ``pos = rn + N - 1 - n_nonzero(u)``. ``counts(groups)``
    gives ``by, _nnz`` and is asked for those groups alone, and only for the
    users in ``low`` (see ``low_users``) if it is given; ``None``: no negatives
    are among the top rows.
    """
    down = top.filter(F.col("_sr") < 0)
    if low is not None:
        down = down.join(low, USER, "left_semi")
    up = top.filter(F.col("_sr") > 0).select(*by, F.col("_rn").cast("bigint").alias("pos"), NEIGHBOR, "sim")
    if counts is None or down.isEmpty():  # a look at the written top rows; usually nobody keeps a negative
        return up
    low = (down.join(counts(down.select(*by).distinct()), list(by))
               .withColumn("pos", (F.col("_rn") + n_users - 1 - F.col("_nnz")).cast("bigint"))
               .filter(F.col("pos") <= k).select(*by, "pos", NEIGHBOR, "sim"))
    return up.unionByName(low)


def knn(prep: Prepared, k: int, hot: HotItems | None = None,
        users: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Exact kNN by adjusted cosine: ``user_id, pos, neighbor_id, sim``.
    ``users`` restricts the users whose neighbours are wanted; the
    restriction is applied to the left side of the pair join. ``stats``: a
    written ``pair_stats`` table (e.g. shared with other predictors)."""
    if stats is None and users is None and mostly_once(prep, hot) and nobody_low(prep, k, hot):
        return place(materialize(ranked_top(close_pairs(prep, k, hot), k), "top-similarities"), prep.n_users(), k, None)
    if stats is not None:
        sims = directed(stats, "cos")
    elif users is None:
        sims = directed(pair_stats(prep, hot), "cos")
    else:
        sims = _of_users(prep, hot, users)

    def counts(some: DataFrame) -> DataFrame:
        again = directed(stats, "cos").join(some, USER, "left_semi") if stats is not None else _of_users(
            prep, hot, some)
        return again.filter(rank_key(F.col("sim")) != 0).groupBy(USER).agg(F.count(F.lit(1)).alias("_nnz"))
    sims, low = _reaching(prep, sims, k, hot, users)
    tasks = ranking_tasks(prep, hot) if users is None else None
    return place(top_similarities(sims, k, partitions=tasks), prep.n_users(), k, counts, low=low)


def nobody_low(prep: Prepared, k: int, hot: HotItems | None) -> bool:
    """Whether ``low_users`` is empty for sure: no user has more co-raters than
    the most ratings of a user times the most other raters of an item."""
    span = prep.span()
    return hot is not None and (span["most"] or 0) * max(0, hot.most - 1) < span["users"] - k


def close_pairs(prep: Prepared, k: int, hot: HotItems) -> DataFrame:
    """``user_id, neighbor_id, sim``: positive similarities, among them the
    ``k`` largest of every user, exact.

    Lists carry weights in 16 bits. A sum's error is at most half a step for
    each ``w_u`` in it, so a similarity lies between two known numbers; pairs
    whose upper one is under the user's k-th lower one are not among the ``k``
    largest. The few others are added up again from the weights themselves.
    Pairs of users with long lists are added up from pair rows at once."""
    long = long_users(prep)
    rows = prep.w.select(USER, ITEM, "w", "n_user", F.rint(F.col("w") * STEPS).cast("tinyint").alias("q"))
    p = partners(rows, ["w"], ["q"], hot, id_type(prep), both=True, owner=short_list(long))
    about = p.groupBy("u", "v").agg(
        (F.sum(F.col("w_u") * F.col("q_v")) / STEPS).alias("_s"), (F.sum(F.abs("w_u")) * (0.500001 / STEPS)).alias("_e"),
        F.count(F.lit(1)).alias("_c"), F.min(ITEM).alias("_i"), F.max(ITEM).alias("_j"))
    # two units of rank_key, as similarities are compared after rounding
    about = about.select("u", "v", "_c", "_i", "_j", (F.col("_s") - F.col("_e")).alias("_low"),
                         (F.col("_s") + F.col("_e") + 2e-9).alias("_high")).filter(F.col("_high") > 0)
    best = Window.partitionBy("u").orderBy(F.col("_low").desc(), "v").rowsBetween(Window.unboundedPreceding, 0)
    kth = F.nth_value("_low", k).over(best)  # known from the k-th row on
    some = about.withColumn("_k", kth).filter(F.col("_k").isNull() | (F.col("_high") >= F.col("_k")))
    # all shared items of a pair with one or two are known
    first = prep.w.select(F.col(USER).alias("u"), ITEM, F.col("w").alias("w_u"))
    second = prep.w.select(F.col(USER).alias("v"), ITEM, F.col("w").alias("w_v"))
    shared = (some.select("u", "v", "_c", "_i", "_j").join(first, "u")
              .filter((F.col("_c") > 2) | (F.col(ITEM) == F.col("_i")) | (F.col(ITEM) == F.col("_j")))
              .select("u", "v", ITEM, "w_u").join(second, ["v", ITEM]))
    exact = shared.groupBy("u", "v").agg(F.sum(F.col("w_u") * F.col("w_v")).alias("sim"))
    out = exact.select(F.col("u").alias(USER), F.col("v").alias(NEIGHBOR), "sim")
    if long is not None:
        out = out.unionByName(_of_users(prep, hot, long))
    return out.filter(rank_key(F.col("sim")) > 0)


def _reaching(prep: Prepared, sims: DataFrame, k: int, hot: HotItems | None,
              users: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The similarities that can stand in a list of ``k``, and the ``low_users``:
    where no list reaches a negative, negatives are not ranked. It holds for
    pairs inside buckets too, as a user meets fewer others there."""
    low = materialize(low_users(prep, k, hot, users), "low-users")
    return (sims.filter(rank_key(F.col("sim")) > 0) if low.isEmpty() else sims), low


def _of_users(prep: Prepared, hot: HotItems | None, users: DataFrame) -> DataFrame:
    p = pair_stats(prep, hot, left_users=users, directed=True)
    return p.select(F.col("u").alias(USER), F.col("v").alias(NEIGHBOR), F.col("cos").alias("sim"))


def neighbor_weights(nbrs: DataFrame, pairs: DataFrame, partitions: int | None = None) -> DataFrame:
    """``u, v, weight``: the similarity of each given pair where ``v`` is
    among the neighbours of ``u``, else 0. ``partitions``: of the pairs, by
    their number."""
    kept = nbrs.select(F.col(USER).alias("u"), F.col(NEIGHBOR).alias("v"), F.col("sim").alias("weight"))
    pairs = pairs.select("u", "v")
    if partitions:
        pairs, kept = pairs.repartition(partitions, "u", "v"), kept.repartition(partitions, "u", "v")
    return (pairs.distinct().join(kept, ["u", "v"], "left")
            .select("u", "v", F.coalesce("weight", F.lit(0.0)).alias("weight")))


def bucket_arrays(users: DataFrame, n_buckets: int, replication: int) -> DataFrame:
    """``user_id, bks``: each user's ``replication`` distinct buckets out of
    ``n_buckets``, those with the smallest hash (ties by bucket id). A per-row
    expression whose size does not depend on ``n_buckets``; no shuffle."""
    return users.select(USER, _buckets(n_buckets, replication).alias("bks"))


def _buckets(n_buckets: int, replication: int) -> Column:
    cands = F.transform(F.sequence(F.lit(0), F.lit(n_buckets - 1)),
                        lambda b: F.struct(bucket_hash(F.col(USER), b).alias("h"), b.alias("b")))
    return F.transform(F.slice(F.array_sort(cands), 1, replication), lambda s: s["b"])


def user_buckets(users: DataFrame, n_buckets: int, replication: int) -> DataFrame:
    """``bucket, user_id``: one row per (user, assigned bucket)."""
    return (bucket_arrays(users, n_buckets, replication)
            .select(F.explode("bks").alias("bucket"), USER))


class BucketRows:
    """Rating rows replicated to their user's buckets, written once, with the
    bucket beside the item in the join key: pair work shrinks by about
    ``replication^2 / n_buckets``. Work is counted and hot groups are split by
    ``(item, bucket)``, as that pair plays the item's part in the pair join."""

    def __init__(self, prep: Prepared, n_buckets: int, replication: int, block: int = DEFAULT_BLOCK):
        self.prep = prep
        placed = user_buckets(prep.ustats.select(USER), n_buckets, replication)
        cell = F.col(ITEM) * F.lit(n_buckets) + F.col("bucket")
        self.long = long_users(prep)
        more = [] if self.long is None else ["n_user"]
        rows = prep.w.select(USER, ITEM, "w", *more).join(placed, USER).select(
            USER, cell.alias(ITEM), F.col("bucket").alias("b"), "w", *more)
        self.rows = materialize(rows, "bucket-rows")
        self.cells = HotItems(self.rows, block=block)

    def sums(self, users: DataFrame | None = None) -> DataFrame:
        """``u, v, bucket, cos`` for pairs inside a bucket: u < v, or with
        ``users`` both directions for these."""
        p = corated(self.rows, ["w", "b"], hot=self.cells, left_users=users, directed=users is not None)
        p = p.select("u", "v", F.col("b_u").alias("bucket"), (F.col("w_u") * F.col("w_v")).alias("_x"))
        if users is None and mostly_once(self.prep, self.cells):
            p = p.repartition(self.cells.partitions, "u", "v")
        return p.groupBy("u", "v", "bucket").agg(F.sum("_x").alias("cos"))

    def similarities(self, users: DataFrame | None = None) -> DataFrame:
        """``u, v, cos`` for pairs that share a bucket (see ``sums``). Inside a
        bucket the sum over common items is the exact similarity (a user's rows
        are whole in each bucket), so a pair that shares several buckets has
        equal sums and one of them is kept."""
        return self.sums(users).groupBy("u", "v").agg(F.min_by("cos", "bucket").alias("cos"))

    def top(self, k: int, hot: HotItems | None = None) -> tuple[DataFrame, DataFrame]:
        """The ``k`` largest of each bucket and user, written: ``users x
        replication x k`` rows at most; and the ``low_users``."""
        if mostly_once(self.prep, self.cells):
            return self._listed_top(k, hot)
        sums = self.sums()
        sims = reduce(DataFrame.unionByName, [
            sums.select("bucket", F.col(a).alias(USER), F.col(b).alias(NEIGHBOR), F.col("cos").alias("sim"))
            for a, b in (("u", "v"), ("v", "u"))])
        sims, low = _reaching(self.prep, sims, k, hot)
        return top_similarities(sims, k, ("bucket", USER)), low

    def _listed_top(self, k: int, hot: HotItems | None) -> tuple[DataFrame, DataFrame]:
        """``top`` by lists (``partners``): a user's pairs are added up and
        ranked where they are made; those of users with long lists by pair rows."""
        p = partners(self.rows, ["w", "b"], ["w"], self.cells, id_type(self.prep), both=True, owner=short_list(self.long))
        sums = p.groupBy("u", F.col("b_u").alias("bucket"), "v").agg(F.sum(F.col("w_u") * F.col("w_v")).alias("cos"))
        ways = [sums] if self.long is None else [sums, self.sums(self.long)]
        sims = [s.select("bucket", F.col("u").alias(USER), F.col("v").alias(NEIGHBOR), F.col("cos").alias("sim"))
                for s in ways]
        low = None
        if nobody_low(self.prep, k, hot):
            sims = [s.filter(rank_key(F.col("sim")) > 0) for s in sims]
        else:
            low = materialize(low_users(self.prep, k, hot), "low-users")
            sims = [s.filter(rank_key(F.col("sim")) > 0) for s in sims] if low.isEmpty() else sims
        top = reduce(DataFrame.unionByName, [ranked_top(s, k, ("bucket", USER)) for s in sims])
        return materialize(top, "top-similarities"), low


def approx_similarities(prep: Prepared, n_buckets: int, replication: int,
                        hot: HotItems | None = None) -> DataFrame:
    """Cosine similarity for pairs that share a bucket: ``u, v, cos``, u < v."""
    return BucketRows(prep, n_buckets, replication, hot.block if hot else DEFAULT_BLOCK).similarities()


def bucket_knn(prep: Prepared, k: int, n_buckets: int, replication: int,
               hot: HotItems | None = None) -> DataFrame:
    """kNN inside each bucket: ``bucket, user_id, pos, neighbor_id, sim``. A
    bucket's candidates are all train users; those outside it count as zeros."""
    rows = BucketRows(prep, n_buckets, replication, hot.block if hot else DEFAULT_BLOCK)

    def counts(some: DataFrame) -> DataFrame:
        again = rows.sums(some.select(USER).distinct()).filter(rank_key(F.col("cos")) != 0)
        return again.groupBy("bucket", F.col("u").alias(USER)).agg(F.count(F.lit(1)).alias("_nnz"))
    top, low = rows.top(k, hot)
    return place(top, prep.n_users(), k, counts, ("bucket", USER), low)


def approx_knn(prep: Prepared, k: int, n_buckets: int, replication: int,
               hot: HotItems | None = None) -> DataFrame:
    """Approximate kNN in two levels: the top ``k`` of each bucket and user,
    then merged, one row of a pair that shares several buckets, and cut again.
    Positions are over co-bucketed pairs, ``N`` = all train users (users
    sharing no bucket count as zero-similarity candidates)."""
    rows = BucketRows(prep, n_buckets, replication, hot.block if hot else DEFAULT_BLOCK)
    top, low = rows.top(k, hot)
    merged = top.groupBy(USER, NEIGHBOR).agg(F.min_by("sim", "bucket").alias("sim"))

    def counts(some: DataFrame) -> DataFrame:
        again = rows.similarities(some).filter(rank_key(F.col("cos")) != 0)
        return again.groupBy(F.col("u").alias(USER)).agg(F.count(F.lit(1)).alias("_nnz"))
    return place(top_similarities(merged, k), prep.n_users(), k, counts, low=low)


def neighbor_overlap(exact: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """``by, n_exact, n_found, recall``: for each group of neighbour tables in
    ``found``, how many of ``exact``'s (user, neighbour) rows it has."""
    total = exact.agg(F.count(F.lit(1))).scalar()
    hits = found.select(*by, USER, NEIGHBOR).join(
        exact.select(USER, NEIGHBOR, F.lit(1).alias("_hit")), [USER, NEIGHBOR], "left")
    return (hits.groupBy(*by).agg(F.count("_hit").alias("n_found"))
            .select(*by, total.alias("n_exact"), "n_found", (F.col("n_found") / total).alias("recall")))


def _by_hash(user: Column, n_buckets: int) -> Column:
    """All buckets in the order in which ``user`` takes them, as ``hash *
    n_buckets + bucket`` (under 2^62): numbers sort faster than structs where a
    user comes up again and again."""
    return F.sort_array(F.transform(F.sequence(F.lit(0), F.lit(n_buckets - 1)),
                                    lambda b: bucket_hash(user, b) * n_buckets + b))


def with_settings(pairs: DataFrame, grid: list[tuple[int, int]]) -> DataFrame:
    """``pairs`` (``u, v, ...``) with ``_seen``: the numbers of the settings
    (buckets, replication) in which the two share a bucket."""
    cols = pairs.columns
    pairs = pairs.select(*cols, *[_by_hash(F.col(c), n).alias(f"_{c}{n}") for n in sorted({n for n, _ in grid})
                                  for c in ("u", "v")])

    def chosen(c: str, n: int, r: int) -> Column:
        return F.array(*[F.get(f"_{c}{n}", F.lit(i)) % n for i in range(min(n, r))])
    seen = F.array(*[F.when(F.arrays_overlap(chosen("u", n, r), chosen("v", n, r)), F.lit(g)).otherwise(F.lit(-1))
                     for g, (n, r) in enumerate(grid)])
    return pairs.select(*cols, F.array_remove(seen, -1).alias("_seen"))


WORD = 62  # marks in a number


def bucket_marks(users: DataFrame, grid: list[tuple[int, int]]) -> Shared:
    """Each user's buckets under every setting of ``grid`` as marks, made once
    a user: a pair that carries what both share needs no hash of its own."""
    groups, bits, at = [], [], 0
    for n, r in grid:
        where = [divmod(at + b, WORD) for b in range(n)]
        at += n
        groups.append({f"_w{w}": sum(1 << i for x, i in where if x == w) for w in sorted({w for w, _ in where})})
        bits.append((where, r))
    words = [f"_w{w}" for w in range(-(-at // WORD))]
    rows = users.select(USER)
    for g, (n, r) in enumerate(grid):
        rows = rows.withColumn(f"_b{g}", _buckets(n, r))

    def word(name: str) -> Column:
        out = F.lit(0).cast("bigint")
        for g, (where, _) in enumerate(bits):
            for b, (w, i) in enumerate(where):
                if f"_w{w}" == name:
                    out = out.bitwiseOR(F.when(F.array_contains(f"_b{g}", b), F.lit(1 << i).cast("bigint"))
                                        .otherwise(F.lit(0).cast("bigint")))
        return out
    return Shared(rows.select(USER, *[word(w).alias(w) for w in words]), words, groups)


def approx_knn_grid(prep: Prepared, k: int, grid: list[tuple[int, int]], stats: DataFrame,
                    hot: HotItems | None = None) -> DataFrame:
    """``n_buckets, replication, user_id, pos, neighbor_id, sim``: approximate
    kNN for every (buckets, replication) of ``grid`` from one written table of
    all pairs. A similarity does not depend on the buckets, so a setting only
    says which pairs it sees; a pair is ranked once for each that sees it. The
    settings are in ``stats`` as ``_seen`` (``bucket_marks``); without it a
    user's buckets follow from its id, and are not joined to the pairs."""
    marked = "_seen" in stats.columns
    kept = ["u", "v", "cos", *(["_seen"] if marked else [])]

    def sims_of(pairs: DataFrame, tasks: int | None = None) -> DataFrame:
        if marked:  # a pair is shuffled once, its settings are told apart in the user's partition
            of = F.array_compact(F.array(*[F.when(F.col("_seen").bitwiseAND(F.lit(1 << g)) != 0, F.lit(g))
                                           for g in range(len(grid))]))
            some = directed(pairs.filter(F.col("_seen") != 0), "cos", "_seen").filter(rank_key(F.col("sim")) != 0)
            some = some.repartition(tasks, USER) if tasks else some
            return some.select(F.explode(of).alias("_g"), "sim", USER, NEIGHBOR)
        pairs = with_settings(pairs.select("u", "v", "cos"), grid).select("u", "v", "cos", F.explode("_seen").alias("_g"))
        both = F.array(F.struct(F.col("u").alias(USER), F.col("v").alias(NEIGHBOR)),
                       F.struct(F.col("v").alias(USER), F.col("u").alias(NEIGHBOR)))
        return pairs.select("_g", F.col("cos").alias("sim"), F.inline(both))

    def counts(some: DataFrame) -> DataFrame:
        again = sims_of(stats).join(some, ["_g", USER], "left_semi").filter(rank_key(F.col("sim")) != 0)
        return again.groupBy("_g", USER).agg(F.count(F.lit(1)).alias("_nnz"))
    pairs, low = _reaching(prep, stats.select(*kept, F.col("cos").alias("sim")), k, hot)
    tasks = ranking_tasks(prep, hot, hot.pairs * sum(min(1.0, r * r / n) for n, r in grid) if hot else None)
    top = top_similarities(sims_of(pairs, tasks), k, ("_g", USER), None if marked else tasks)
    got = place(top, prep.n_users(), k, counts, ("_g", USER), low)
    n, r = (F.element_at(F.array(*[F.lit(x) for x in xs]), F.col("_g") + 1) for xs in zip(*grid, strict=True))
    return got.select(n.alias("n_buckets"), r.alias("replication"), USER, "pos", NEIGHBOR, "sim")
