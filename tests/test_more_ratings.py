"""Top n for everybody, given and wanted pairs, pruned and per-bucket kNN,
recall, bitmaps, appended ratings, bucketed tables and nested answers, on
random tables against brute force."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from kinrank.operators import bitmaps, evaluate, pruned
from kinrank.operators import neighbors as nbm
from kinrank.operators import predict as pr
from kinrank.operators import recommend as rc
from kinrank.operators import similarity as sim
from kinrank.operators.pairs import HotItems
from kinrank.operators.state import RatingState
from kinrank.operators.stats import Prepared
from kinrank.session import scratch_path
from kinrank.sources import layout

from .brute import Brute

RATED = "user_id bigint, item_id bigint, rating double"


def random_ratings():
    """Popular and rare items, users of one value only (averages 5, 1 and 3),
    a user with a single rating and one who rates nearly everything."""
    rng = random.Random(6)
    rows = {}
    for u in range(30):
        for _ in range(rng.randrange(1, 14)):
            rows[u, int(40 * rng.random() ** 3)] = float(rng.randrange(1, 6))
    for u, value in ((40, 5.0), (41, 1.0), (42, 3.0), (43, 5.0), (44, 1.0)):
        for i in rng.sample(range(30), 6):
            rows[u, i] = value
    rows[45, 2] = 4.0
    for i in range(38):
        rows[46, i] = float(1 + i % 5)
    return [(u, i, r) for (u, i), r in rows.items()]


ROWS = random_ratings()
BRUTE = Brute(ROWS)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, RATED).repartition(3)


@pytest.fixture(scope="module")
def prep(table):
    return Prepared(table)


def order_key(kind, u, i):
    if kind == "item_avg":
        return round(BRUTE.ia[i], 9)
    if kind == "baseline":
        d, a = BRUTE.idev[i], BRUTE.ua[u]
        return round(min(d, 0.0) if a >= 5 else max(d, 0.0) if a <= 1 else d, 9)
    return 0.0


@pytest.mark.parametrize("kind", ["global", "user_avg", "item_avg", "baseline"])
@pytest.mark.parametrize("some", [None, [40, 41, 3, 999]])
def test_top_n_for_everybody(spark, prep, kind, some):
    users = None if some is None else spark.createDataFrame([(u,) for u in some], "user_id bigint")
    got = {}
    for r in rc.recommend_ranked(prep, kind, 4, users).collect():
        got.setdefault(r["user_id"], []).append((r["rank"], r["item_id"], r["prediction"]))

    def value(u, i):
        return BRUTE.predict(kind, u, i)
    want = [u for u in BRUTE.users if some is None or u in some]
    assert set(got) == {u for u in want if len(BRUTE.by_user[u]) < len(BRUTE.by_item)}
    for u in got:
        unseen = [i for i in sorted(BRUTE.by_item) if i not in BRUTE.by_user[u]]
        best = sorted(unseen, key=lambda i: (-order_key(kind, u, i), i))[:4]
        assert [(n, i) for n, i, _ in sorted(got[u])] == list(enumerate(best, 1))
        assert all(math.isclose(p, value(u, i), abs_tol=1e-9) for _, i, p in got[u])
        # nothing unrated is predicted higher
        last = min(p for _, _, p in got[u])
        assert all(value(u, i) <= last + 1e-9 for i in unseen if i not in best)


def test_other_predictors_have_no_common_order(prep):
    with pytest.raises(ValueError):
        rc.recommend_ranked(prep, "cosine", 3)


@pytest.mark.parametrize("most", [0, 5, 1024])
def test_given_pairs(spark, prep, most):
    rng = random.Random(3)
    pairs = [(rng.choice(BRUTE.users), rng.choice(BRUTE.users)) for _ in range(300)] + [(1, 999), (999, 998), (46, 46)]
    df = spark.createDataFrame(pairs, "u bigint, v bigint")
    rows = {(r["u"], r["v"]): r for r in sim.similarity_of(prep, df, most).collect()}
    assert set(rows) == set(pairs)
    common = {}
    for r in sim.common_items_of(prep, df, most).collect():
        common.setdefault((r["u"], r["v"]), set()).add(r["item_id"])
    for (u, v), r in rows.items():
        both = set(BRUTE.by_user.get(u, {})) & set(BRUTE.by_user.get(v, {}))
        assert r["n_common"] == len(both) and common.get((u, v), set()) == both
        known = u in BRUTE.by_user and v in BRUTE.by_user
        assert math.isclose(r["cos"], BRUTE.cos(u, v) if known else 0.0, abs_tol=1e-9)
        assert math.isclose(r["jac"], BRUTE.jac(u, v) if known else 0.0, abs_tol=1e-9)


def test_given_pairs_make_no_more_rows_than_pairs(prep, spark):
    pairs = spark.createDataFrame([(u, v) for u in BRUTE.users for v in BRUTE.users if u < v], "u bigint, v bigint")
    led = sim._led(prep, pairs)
    assert sim._intersected(prep, led, 1024).count() == led.count() == pairs.count()


@pytest.mark.parametrize("block", [4096, 5])
def test_only_wanted_pairs_are_made(spark, prep, table, block):
    hot = HotItems(table, block=block)
    wanted = [(1, 2), (3, 46), (40, 46), (5, 9)]
    got = sim.pair_stats(prep, hot, wanted=spark.createDataFrame(wanted, "u bigint, v bigint")).collect()
    assert {(r["u"], r["v"]) for r in got} <= set(wanted) and len(got) >= 2
    for r in got:
        assert math.isclose(r["cos"], BRUTE.cos(r["u"], r["v"]), abs_tol=1e-9)
    pairs = spark.createDataFrame([(3, 1), (46, 0), (45, 2), (1, 999), (999, 1)], "user_id bigint, item_id bigint")
    for predict, kind in ((pr.predict_cosine, "cosine"), (pr.predict_jaccard, "jaccard")):
        for r in predict(prep, pairs, hot).collect():
            assert math.isclose(r["prediction"], BRUTE.predict(kind, r["user_id"], r["item_id"]), abs_tol=1e-9)


def key(r):
    return (r["user_id"], r["pos"], r["neighbor_id"], round(r["sim"], 9))


@pytest.mark.parametrize("k", [1, 3, 20])
@pytest.mark.parametrize("options", [{}, {"classes": 4, "seeds": 1, "share": 1.0}, {"seeds": 0}])
def test_pruned_knn_is_exact(prep, table, k, options):
    hot = HotItems(table, block=7)
    want = sorted(map(key, nbm.knn(prep, k, hot).collect()))
    assert sorted(map(key, pruned.knn_pruned(prep, k, hot, **options).collect())) == want


def test_pruning_leaves_out_pairs_of_popular_items(spark):
    rng = random.Random(1)
    rows = [(u, 1000 + u // 3, 5.0) for u in range(120)]  # threes share two rare items
    rows += [(u, 2000 + u // 3, 1.0) for u in range(120)]
    rows += [(u, 1, 3.1 + rng.random() / 9) for u in range(120)]  # everybody's item, rated mildly
    prep = Prepared(spark.createDataFrame(rows, RATED))
    one = pruned.Pruned(prep, 1, classes=64, seeds=1)
    work = one.work().first()
    assert work["n_made"] < work["n_all"] / 2
    assert sorted(map(key, one.neighbors().collect())) == sorted(map(key, nbm.knn(prep, 1).collect()))


def test_per_bucket_knn(spark, prep):
    k, n, r = 3, 4, 2
    buckets = {}
    for row in nbm.user_buckets(prep.ustats.select("user_id"), n, r).collect():
        buckets.setdefault(row["bucket"], set()).add(row["user_id"])
    want = []
    for b, users in buckets.items():
        for u in users:
            sims = sorted((round(BRUTE.cos(u, v) if v in users else 0.0, 9), v) for v in BRUTE.users if v != u)[::-1]
            want += [(b, u, p, v, s) for p, (s, v) in enumerate(sims[:k], 1) if s != 0]
    got = [(x["bucket"], x["user_id"], x["pos"], x["neighbor_id"], round(x["sim"], 9))
           for x in nbm.bucket_knn(prep, k, n, r).collect()]
    assert sorted(got) == sorted(want)


def test_grid_gives_each_setting(prep):
    grid = [(1, 1), (4, 2), (5, 1), (3, 3)]
    stats = sim.pair_stats(prep).select("u", "v", "cos")
    rows = nbm.approx_knn_grid(prep, 4, grid, stats).collect()
    exact = nbm.knn(prep, 4)
    for n, r in grid:
        want = sorted(map(key, nbm.approx_knn(prep, 4, n, r).collect()))
        assert sorted(key(x) for x in rows if (x["n_buckets"], x["replication"]) == (n, r)) == want
    full = {key(x)[::2] for x in exact.collect()}
    report = nbm.neighbor_overlap(exact, nbm.approx_knn_grid(prep, 4, grid, stats), ["n_buckets", "replication"])
    for x in report.collect():
        mine = {key(y)[::2] for y in rows if (y["n_buckets"], y["replication"]) == (x["n_buckets"], x["replication"])}
        assert (x["n_exact"], x["n_found"]) == (len(full), len(full & mine)) and x["recall"] == x["n_found"] / x["n_exact"]
        if x["n_buckets"] == x["replication"]:
            assert x["recall"] == 1.0


def test_item_sets_as_bitmaps(spark, table):
    wide = spark.range(70_000).select(F.lit(500).cast("bigint").alias("user_id"), (F.col("id") + 100).alias("item_id"))
    even = spark.range(0, 70_000, 2).select(F.lit(501).cast("bigint").alias("user_id"), (F.col("id") + 100).alias("item_id"))
    rows = table.select("user_id", "item_id").unionByName(wide).unionByName(even)  # several ranges of items
    pairs = [(u, v) for u in BRUTE.users for v in BRUTE.users if u <= v] + [(500, 501), (500, 46), (999, 1), (998, 999)]
    got = {(r["u"], r["v"]): (r["n_union"], r["n_common"]) for r in
           bitmaps.set_sizes_of(rows, spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    sets = {u: set(d) for u, d in BRUTE.by_user.items()}
    for u, v in pairs[:-4]:
        assert got[u, v] == (len(sets[u] | sets[v]), len(sets[u] & sets[v]))
    assert got[500, 501] == (70_000, 35_000) and got[500, 46] == (70_038, 0)
    assert got[999, 1] == (len(sets[1]), 0) and got[998, 999] == (0, 0)


def test_appended_ratings_equal_a_rebuild(spark, table):
    new = [(3, 100, 5.0), (3, 2, 1.0), (77, 2, 4.0), (77, 101, 2.0), (46, 39, 3.0)]
    new = [r for r in new if r[:2] not in {x[:2] for x in ROWS}]
    state = RatingState.of(table).append(spark.createDataFrame(new[:2], RATED)).append(
        spark.createDataFrame(new[2:], RATED))
    whole = Prepared(spark.createDataFrame(ROWS + new, RATED))

    def rows(df, *cols):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect())
    prep = state.prepared()
    assert rows(prep.ustats, "user_id", "n", "user_avg") == rows(whole.ustats, "user_id", "n", "user_avg")
    assert rows(prep.w, "user_id", "item_id", "rating", "n_user", "dev", "w") == rows(
        whole.w, "user_id", "item_id", "rating", "n_user", "dev", "w")
    assert rows(prep.item_dev, "item_id", "n", "avg_dev") == rows(whole.item_dev, "item_id", "n", "avg_dev")
    assert rows(nbm.knn(prep, 3), "user_id", "pos", "neighbor_id", "sim") == rows(
        nbm.knn(whole, 3), "user_id", "pos", "neighbor_id", "sim")


def test_appending_leaves_others_alone(spark, table):
    state = RatingState.of(table)
    marked = RatingState(state.users, state.items.withColumn("dev_sum", F.when(F.col("item_id") == 39, 7.5).otherwise(
        F.col("dev_sum"))), state.rows.withColumn("w", F.when(F.col("user_id") == 5, 42.0).otherwise(F.col("w"))))
    after = marked.append(spark.createDataFrame([(45, 3, 2.0)], RATED))
    assert {r["w"] for r in after.rows.filter("user_id = 5").collect()} == {42.0}  # not made again
    touched = {i for i in BRUTE.by_user[45]} | {3}
    if 39 in BRUTE.by_item and 39 not in touched:
        assert after.items.filter("item_id = 39").first()["dev_sum"] == 7.5
    assert after.rows.filter("user_id = 45").count() == 2


@pytest.mark.parametrize("key", ["user_id", "item_id"])
def test_laid_out_joins_need_no_exchange(spark, table, key):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = (layout.write_bucketed(t, n, key, 4) for t, n in ((table, "one"), (table.filter("rating > 2"), "two")))
        joined = b.join(a.groupBy(key).agg(F.avg("rating").alias("avg")), key)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        assert joined.count() == table.filter("rating > 2").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    both = layout.RatingLayout(table, buckets=2)
    assert sorted(map(tuple, both.by_user.collect())) == sorted(map(tuple, both.by_item.collect())) == sorted(ROWS)


def test_answers_are_nested(spark):
    rows = [("averages", "global_avg", 3.5), ("averages", "user_1_avg", 2.0), ("mae", "baseline", 0.25)]
    path, metrics = scratch_path(spark, "answers"), ["global_avg", "user_1_avg", "baseline"]
    report = spark.createDataFrame(rows, "section string, metric string, value double")
    evaluate.write_answers(report, path, metrics)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert sorted(lines, key=lambda x: x["section"]) == [
        {"section": "averages", "answers": {"global_avg": 3.5, "user_1_avg": 2.0}},
        {"section": "mae", "answers": {"baseline": 0.25}}]
    back = evaluate.read_answers(spark, path, metrics)
    assert back.schema["answers"].dataType.fieldNames() == metrics
    assert sorted(map(tuple, evaluate.flat_answers(back, metrics).collect())) == sorted(rows)
