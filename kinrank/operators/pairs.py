"""Joins of rating rows on ``item_id``, where work is quadratic in an item's
raters: co-rated user pairs, and the raters that a pair to predict meets.

* **u < v**: each unordered pair of raters is emitted once (half the join
  output); the mirror is a cheap union of the aggregated result.
* **partitions sized by pair work**: AQE sizes post-shuffle partitions by
  the bytes read, but this join's output is quadratic in the raters per item.
  The same pass that finds hot items sums ``n(n-1)/2``; the rows are
  hash-partitioned by the join key into ``max(shuffle partitions,
  pairs / pairs_per_task)`` partitions (both sides read one exchange).
* **block salting for hot items** (``salted_join``): an item with more than
  ``block`` raters is split into ``S = ceil(n / block)`` blocks by a hash of
  the user. Left rows are replicated over the ``S`` right blocks and right
  rows over the ``S`` left blocks, so the join key ``(item, left_block,
  right_block)`` holds at most about ``block`` rows a side. No task owns a
  whole hot item. Items at or below ``block`` raters are not replicated. The
  hot-item table has at most ``rows / block`` rows; it is counted first and
  broadcast only below ``broadcast_rows``, otherwise joined by shuffle.
* **lists instead of pair rows** (``partners``): where pairs are met about once,
  an item's raters go as one row of arrays to each of them, and the pair rows
  are made in the user's partition, where they are added up and ranked.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.session import materialize
from kinrank.sources.schema import ITEM, USER

DEFAULT_BLOCK = 4096
BROADCAST_ROWS = 200_000
PAIRS_PER_TASK = 1_000_000
LIST_TASKS = 4        # a task that sends lists makes the lists of so many tasks' pairs
MOST_TASKS = 100_000  # beyond this a task has more pairs; they are streamed


class HotItems:
    """Items with more raters than ``block``, with their block count, and the
    total pair work ``sum n(n-1)/2``; the item counts are written once and
    read for the totals and for every join.

    ``broadcast_rows`` is the largest hot-item table that is broadcast (its
    size is known before), ``pairs_per_task`` the pair work that one task of
    the pair join should have; ``partitions`` overrides the partition count
    that follows from it.
    """

    def __init__(self, ratings: DataFrame, block: int = DEFAULT_BLOCK,
                 broadcast_rows: int = BROADCAST_ROWS, pairs_per_task: int = PAIRS_PER_TASK,
                 partitions: int | None = None):
        self.block = block
        self.counts = materialize(ratings.groupBy(ITEM).agg(F.count(F.lit(1)).alias("_n")), "item-counts")
        self.table = (self.counts.filter(F.col("_n") > block)
                      .select(ITEM, F.ceil(F.col("_n") / F.lit(block)).cast("int").alias("_S")))
        row = self.counts.agg(F.sum(F.when(F.col("_n") > block, 1).otherwise(0)).alias("hot"),
                              F.sum(F.col("_n") * (F.col("_n") - 1) / 2).alias("pairs"), F.sum("_n").alias("rows"),
                              F.max("_n").alias("most")).first()
        self.n = int(row["hot"] or 0)  # size check before any broadcast
        self.pairs = float(row["pairs"] or 0.0)
        self.rows = int(row["rows"] or 0)
        self.most = int(row["most"] or 0)  # raters of the most popular item
        self.broadcastable = self.n <= broadcast_rows
        self._base, self._per_task = int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions")), pairs_per_task
        self.partitions = partitions or self.tasks(self.pairs)

    def tasks(self, rows: float) -> int:
        """Partitions for a shuffle of so many rows, no fewer than the session's."""
        return max(self._base, min(MOST_TASKS, int(-(-rows // self._per_task))))

    def attach(self, rows: DataFrame) -> DataFrame:
        side = F.broadcast(self.table) if self.broadcastable else self.table
        return (rows.join(side, ITEM, "left")
                    .withColumn("_S", F.coalesce(F.col("_S"), F.lit(1))))


def _blocks(rows: DataFrame, user: str, mine: str, other: str) -> DataFrame:
    return (rows.withColumn(mine, F.pmod(F.xxhash64(user), F.col("_S")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_S") - 1))).drop("_S"))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], left_user: str, right_user: str,
                hot: HotItems | None, on: Column | None = None, partitions: int | None = None) -> DataFrame:
    """``left`` and ``right`` joined on ``keys`` (with ``item_id`` among
    them), hot items in blocks by ``left_user`` and ``right_user``."""
    if hot is None or hot.n == 0:
        out = left.join(right, keys)
        return out if on is None else out.filter(on)
    key = keys + ["_lb", "_rb"]
    left = _blocks(hot.attach(left), left_user, "_lb", "_rb")
    right = _blocks(hot.attach(right), right_user, "_rb", "_lb")
    if partitions:
        left, right = left.repartition(partitions, *key), right.repartition(partitions, *key)
    out = left.join(right, key)
    return (out if on is None else out.filter(on)).drop("_lb", "_rb")


def corated(rows: DataFrame, payload: list[str], hot: HotItems | None = None,
            left_users: DataFrame | None = None, directed: bool = False,
            right_users: DataFrame | None = None) -> DataFrame:
    """Emit co-rated pairs.

    ``rows`` has ``user_id, item_id`` and the ``payload`` columns. The result
    has ``u, v, item_id`` and ``<col>_u`` / ``<col>_v`` for each payload
    column, one row per pair and shared item: ``u < v`` unless ``directed``
    (then ``u != v``). ``left_users`` and ``right_users`` (one column
    ``user_id``) restrict ``u`` and ``v`` before the join.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(USER).alias(name), ITEM, *[F.col(c).alias(f"{c}_{name}") for c in payload])
    if hot is not None and hot.n == 0 and left_users is None and right_users is None:
        # one exchange, sized by pair work, feeds both sides of the join
        rows = rows.repartition(hot.partitions, ITEM)
    left, right = side(rows, "u"), side(rows, "v")
    if left_users is not None:
        left = left.join(left_users.select(F.col(USER).alias("u")), "u", "left_semi")
    if right_users is not None:
        right = right.join(right_users.select(F.col(USER).alias("v")), "v", "left_semi")
    cond = (F.col("u") != F.col("v")) if directed else (F.col("u") < F.col("v"))
    return salted_join(left, right, [ITEM], "u", "v", hot, cond, hot.partitions if hot else None)


class Shared:
    """Marks of users as bits of a few numbers: ``rows`` (``user_id`` and the
    columns ``words``) and, for each group of marks, its bits by word. Two users
    share a group if they have one of its marks in common."""

    def __init__(self, rows: DataFrame, words: list[str], groups: list[dict[str, int]]):
        self.rows, self.words, self.groups = rows, words, groups

    def of(self, one: Callable[[str], Column], other: Callable[[str], Column]) -> Column:
        """The groups that two users share, group ``g`` as bit ``g``."""
        bits = None
        for g, words in enumerate(self.groups):
            met = reduce(Column.__or__, [one(w).bitwiseAND(other(w)).bitwiseAND(F.lit(m).cast("bigint")) != 0
                                         for w, m in words.items()])
            bit = F.when(met, F.lit(1 << g).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            bits = bit if bits is None else bits.bitwiseOR(bit)
        return bits.cast("tinyint" if len(self.groups) < 8 else "int" if len(self.groups) < 32 else "bigint")


def partners(rows: DataFrame, mine: list[str], theirs: list[str], hot: HotItems, ids: str = "bigint",
             both: bool = False, owner: Column | None = None, shared: Shared | None = None) -> DataFrame:
    """Co-rated pairs as by ``corated``, in partitions by ``u``: ``u, v,
    item_id``, ``<col>_u`` of the columns ``mine`` and ``<col>_v`` of
    ``theirs``; ``u < v``, or ``u != v`` if ``both``.

    What is shuffled is a row for each rating with the item's other raters as
    arrays (those after the user; all if ``both``), so a pair costs its number
    and payload, not a row. ``ids``: the type that holds all user ids.
    ``owner``: which rows get lists; a user's pairs meet in one task, so users
    of very many ratings go another way. Lists of hot items are cut into the
    blocks of ``salted_join``. ``shared``: adds ``_seen``, of both users' marks.
    """
    tasks = hot.tasks(hot.pairs * (2 if both else 1))
    out = partner_lists(rows, mine, theirs, hot, ids, both, owner, shared).repartition(tasks, "u")
    pairs = out.select("u", ITEM, *[f"{c}_u" for c in mine], *[f"_{c}" for c in theirs],
                       *(["_seen"] if shared else []), F.posexplode("_ids").alias("_p", "_v"))
    pairs = pairs.select("u", F.col("_v").cast("bigint").alias("v"), ITEM, *[f"{c}_u" for c in mine],
                         *[F.get(f"_{c}", F.col("_p")).alias(f"{c}_v") for c in theirs],
                         *([F.get("_seen", F.col("_p")).alias("_seen")] if shared else []))
    return pairs.filter(F.col("v") != F.col("u") if both else F.col("v") > F.col("u"))


def partner_lists(rows: DataFrame, mine: list[str], theirs: list[str], hot: HotItems, ids: str = "bigint",
                  both: bool = False, owner: Column | None = None, shared: Shared | None = None) -> DataFrame:
    """The rows that ``partners`` shuffles: ``u, item_id, <col>_u``, the users
    ``_ids`` and their ``_<col>`` as arrays."""
    own = F.lit(True) if owner is None else F.coalesce(owner, F.lit(False))
    member = F.struct(F.col(USER), *[F.col(c) for c in dict.fromkeys([*mine, *theirs, *(shared.words if shared else [])])], own.alias("_own"))
    rows = rows.filter(F.col(USER).isNotNull() & F.col(ITEM).isNotNull()).withColumn("_m", member).select(USER, ITEM, "_m")

    def lists(rows: DataFrame, *key: str) -> DataFrame:
        made = rows.groupBy(ITEM, *key).agg(F.array_sort(F.collect_list("_m")).alias("_l"))
        return made.select(ITEM, *key, "_l", F.col(f"_l.{USER}").cast(f"array<{ids}>").alias("_ids"),
                           *[F.col(f"_l.{c}").alias(f"_{c}") for c in theirs],
                           *([F.transform("_l", lambda m: F.struct(*[m[w].alias(w) for w in shared.words])).alias("_marks")]
                             if shared else []))
    marks = ["_marks"] if shared else []
    seen = [F.transform("_marks", lambda m: shared.of(lambda w: m[w], lambda w: F.col(f"_m.{w}"))).alias("_seen")] if shared else []
    arrays = ["_ids", *[f"_{c}" for c in theirs]]

    def sent(met: DataFrame, after: Column | None = None) -> DataFrame:
        cut = [F.col(a) if after is None else F.slice(a, after, F.size("_ids")).alias(a) for a in [*arrays, *marks]]
        met = met.filter(F.size("_ids") > 1) if both and not hot.n else met  # a rater alone meets nobody
        return met.filter(F.col("_m._own")).select(F.col(f"_m.{USER}").alias("u"), ITEM,
                                                   *[F.col(f"_m.{c}").alias(f"{c}_u") for c in mine], "_m", *cut).select(
            "u", ITEM, *[f"{c}_u" for c in mine], *arrays, *seen)
    side = F.broadcast(hot.table) if hot.broadcastable else hot.table
    cold = rows if hot.n == 0 else rows.join(side, ITEM, "left_anti")
    cold = lists(cold.repartition(hot.tasks(hot.pairs / LIST_TASKS), ITEM))
    out = sent(cold.select(ITEM, *arrays, *marks, F.posexplode("_l").alias("_p", "_m")), None if both else F.col("_p") + 2)
    if hot.n:
        many = rows.join(side, ITEM)
        left = _blocks(many.filter(F.col("_m._own")), USER, "_lb", "_rb")
        right = lists(_blocks(many, USER, "_rb", "_lb"), "_lb", "_rb").drop("_l")
        out = out.unionByName(sent(left.join(right, [ITEM, "_lb", "_rb"])))
    return out


def raters_of(pairs: DataFrame, raters: DataFrame, rater: str, hot: HotItems | None) -> DataFrame:
    """``pairs`` (``user_id, item_id, ...``) with every rater of the item;
    hot items in blocks, so neither many pairs nor many raters of an item
    meet in one task."""
    return salted_join(pairs, raters, [ITEM], USER, rater, hot)
