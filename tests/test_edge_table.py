"""A hand-made ratings file with the awkward cases, read through the
delimited reader and checked against the brute-force statement of the
formulas (``tests/brute.py``):

* user 1 rates everything 3: zero norm, weight 0
* user 2 has a single rating; user 4 shares no item with user 2
* item 6 is rated once
* users 7 and 8 rate identically: equal similarity to everyone (tie)
* users 3 and 6 rate in opposite directions: a negative similarity
* (3, 2) appears twice (merged with max in a step of its own), a header line
  and a line whose first field is not an integer are dropped
"""

import math

import pytest
from pyspark.sql import functions as F

from kinrank.operators import neighbors as nbm
from kinrank.operators import predict as pr
from kinrank.operators import recommend as rc
from kinrank.operators import similarity as sim
from kinrank.operators.pairs import HotItems
from kinrank.operators.stats import Prepared
from kinrank.session import scratch_path
from kinrank.sources.readers import merge_duplicates, read_ratings

from .brute import Brute

LINES = """user_id\titem_id\trating
1\t1\t3
1\t2\t3
1\t3\t3
2\t1\t4
3\t2\t5
3\t2\t2
3\t3\t1
3\t4\t4
4\t5\t2
4\t6\t5
5\t2\t4
5\t3\t1
5\t4\t5
6\t2\t1
6\t3\t5
6\t4\t2
7\t2\t5
7\t5\t2
8\t2\t5
8\t5\t2
x1\t3\t3
"""

TRAIN = [(1, 1, 3.0), (1, 2, 3.0), (1, 3, 3.0), (2, 1, 4.0), (3, 2, 5.0), (3, 3, 1.0), (3, 4, 4.0),
         (4, 5, 2.0), (4, 6, 5.0), (5, 2, 4.0), (5, 3, 1.0), (5, 4, 5.0), (6, 2, 1.0), (6, 3, 5.0),
         (6, 4, 2.0), (7, 2, 5.0), (7, 5, 2.0), (8, 2, 5.0), (8, 5, 2.0)]
USERS = range(1, 9)
ITEMS = range(1, 7)
COLD = [(99, 1), (1, 99), (99, 99)]


@pytest.fixture(scope="module")
def table(spark):
    path = scratch_path(spark, "edge")
    spark.createDataFrame([(line,) for line in LINES.strip().split("\n")], "value string") \
        .coalesce(1).write.text(path)
    raw = read_ratings(spark, path)
    assert raw.count() == len(TRAIN) + 1  # every row is kept
    return merge_duplicates(raw)


@pytest.fixture(scope="module")
def prep(table):
    return Prepared(table)


@pytest.fixture(scope="module")
def brute():
    return Brute(TRAIN)


@pytest.fixture(scope="module")
def pairs(spark, brute):
    ps = [(u, i) for u in USERS for i in ITEMS if (u, i) not in brute.r] + COLD
    return spark.createDataFrame(ps, "user_id bigint, item_id bigint")


def test_reader_drops_header_and_bad_ids(table):
    rows = sorted((r.user_id, r.item_id, r.rating) for r in table.collect())
    assert rows == sorted(TRAIN)


def test_reader_fails_on_bad_rating(spark):
    path = scratch_path(spark, "edge-bad")
    spark.createDataFrame([("1\t2\tfive",)], "value string").write.text(path)
    for ansi in ("true", "false"):  # whatever the caller's session says
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="bad field"):
                read_ratings(spark, path).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


def test_zero_norm_user_has_zero_weights(prep):
    ws = {r.item_id: r.w for r in prep.w.filter("user_id = 1").collect()}
    assert ws == {1: 0.0, 2: 0.0, 3: 0.0}


def test_similarities_match_brute(prep, brute):
    got = {(r.u, r.v): (r.cos, r.jac, r.n_common) for r in sim.pair_stats(prep).collect()}
    for u in USERS:
        for v in USERS:
            if u >= v:
                continue
            common = set(brute.by_user[u]) & set(brute.by_user[v])
            if not common:
                assert (u, v) not in got
                continue
            cos, jac, n = got[(u, v)]
            assert n == len(common)
            assert math.isclose(cos, brute.cos(u, v), abs_tol=1e-12)
            assert math.isclose(jac, brute.jac(u, v), abs_tol=1e-12)
    assert brute.cos(3, 6) < 0 and got[(3, 6)][0] < 0


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 6, 7])
def test_knn_positions_match_sorted_list_rule(prep, brute, k):
    got = {}
    for r in nbm.knn(prep, k).collect():
        got.setdefault(r.user_id, {})[r.neighbor_id] = (r.pos, r.sim)
    for u in USERS:
        ranked = [(v, s) for v, s in brute.ranked(u)][:k]
        want = {v: (n + 1, s) for n, (v, s) in enumerate(ranked) if round(s, 9) != 0}
        have = got.get(u, {})
        assert set(have) == set(want), (u, k, have, want)
        for v, (pos, s) in want.items():
            assert have[v][0] == pos and math.isclose(have[v][1], s, abs_tol=1e-12), (u, v, k)


@pytest.mark.parametrize("kind", ["global", "user_avg", "item_avg", "baseline", "uniform",
                                  "cosine", "jaccard"])
def test_predictors_match_brute(prep, brute, pairs, kind):
    fn = {"global": pr.predict_global, "user_avg": pr.predict_user_avg,
          "item_avg": pr.predict_item_avg, "baseline": pr.predict_baseline,
          "uniform": pr.predict_uniform, "cosine": pr.predict_cosine,
          "jaccard": pr.predict_jaccard}[kind]
    for r in fn(prep, pairs).collect():
        want = brute.predict(kind, r.user_id, r.item_id)
        assert math.isclose(r.prediction, want, abs_tol=1e-9), (kind, r, want)


@pytest.mark.parametrize("k", [1, 2, 3, 7])
@pytest.mark.parametrize("order", ["raters", "neighbours", "salted raters"])
def test_knn_predictor_matches_brute(prep, brute, pairs, k, order, monkeypatch):
    monkeypatch.setattr(pr, "neighbours_first", lambda *a: order == "neighbours")
    hot = None if order == "raters" else HotItems(prep.train, block=2)
    for r in pr.predict_knn(prep, pairs, k, hot=hot).collect():
        want = brute.predict("knn", r.user_id, r.item_id, k)
        assert math.isclose(r.prediction, want, abs_tol=1e-9), (k, r, want)


def test_keep_known_returns_train_ratings(spark, prep, brute):
    ps = spark.createDataFrame([(3, 2), (3, 5), (99, 1)], "user_id bigint, item_id bigint")
    got = {(r.user_id, r.item_id): r.prediction for r in pr.predict_knn(prep, ps, 2, keep_known=True).collect()}
    assert got[(3, 2)] == 5.0
    assert math.isclose(got[(3, 5)], brute.predict("knn", 3, 5, 2), abs_tol=1e-9)
    assert math.isclose(got[(99, 1)], brute.g, abs_tol=1e-12)


@pytest.mark.parametrize("k", [1, 3, 7])
def test_recommend_matches_brute(spark, prep, brute, k):
    users = spark.createDataFrame([(u,) for u in list(USERS) + [99]], "user_id bigint")
    got = {}
    for r in rc.recommend(prep, users, 3, k).collect():
        got.setdefault(r.user_id, []).append((r.rank, r.item_id, r.prediction))
    for u in list(USERS) + [99]:
        want = brute.recommend(u, 3, k)
        have = [(i, p) for _, i, p in sorted(got.get(u, []))]
        assert [i for i, _ in have] == [i for i, _ in want], (u, k, have, want)
        for (_, p1), (_, p2) in zip(have, want):
            assert math.isclose(p1, p2, abs_tol=1e-9)


def test_salted_pairs_equal_plain_pairs(prep):
    hot = HotItems(prep.train, block=2)
    assert hot.n > 0
    plain = {(r.u, r.v): (r.n_common, round(r.cos, 12)) for r in sim.pair_stats(prep).collect()}
    salted = {(r.u, r.v): (r.n_common, round(r.cos, 12)) for r in sim.pair_stats(prep, hot).collect()}
    assert plain == salted


@pytest.mark.parametrize("block", [1, 2])
def test_predictions_with_hot_items_in_blocks(prep, pairs, block):
    hot = HotItems(prep.train, block=block)
    assert hot.n > 0

    def values(df, *more):
        return {tuple(r[c] for c in ("user_id", "item_id", *more)): round(r.prediction, 10) for r in df.collect()}
    for fn in (pr.predict_cosine, pr.predict_jaccard):
        assert values(fn(prep, pairs)) == values(fn(prep, pairs, hot))
    assert values(pr.predict_knn_sweep(prep, pairs, [1, 3]), "k") == values(
        pr.predict_knn_sweep(prep, pairs, [1, 3], hot=hot), "k")
    plan = pr.weighted_deviation_full(prep, pairs, "cosine", hot)._jdf.queryExecution().optimizedPlan().toString()
    assert "_lb" in plan and "_rb" in plan


def test_pair_lookups(spark, prep, brute):
    ps = [(u, v) for u in [*USERS, 99] for v in USERS if u != v]
    pairs = spark.createDataFrame(ps + ps[:3], "u bigint, v bigint")
    got = {(r.u, r.v): r for r in sim.similarity_of(prep, pairs).collect()}
    assert set(got) == set(ps)
    items = {}
    for r in sim.common_items_of(prep, pairs).collect():
        items.setdefault((r.u, r.v), []).append(r.item_id)
    kept = {(r.u, r.v): r.weight for r in nbm.neighbor_weights(nbm.knn(prep, 3), pairs).collect()}
    for u, v in ps:
        common = set(brute.by_user.get(u, {})) & set(brute.by_user[v])
        assert sorted(items.get((u, v), [])) == sorted(common) and got[(u, v)].n_common == len(common)
        if u == 99:
            assert (got[(u, v)].cos, got[(u, v)].jac, kept[(u, v)]) == (0, 0, 0)
            continue
        assert math.isclose(got[(u, v)].cos, brute.cos(u, v), abs_tol=1e-12)
        assert math.isclose(got[(u, v)].jac, brute.jac(u, v), abs_tol=1e-12)
        assert math.isclose(kept[(u, v)], brute.knn(u, 3).get(v, 0.0), abs_tol=1e-9)


def test_uniform_equals_baseline(prep, pairs):
    a = {(r.user_id, r.item_id): r.prediction for r in pr.predict_uniform(prep, pairs).collect()}
    b = {(r.user_id, r.item_id): r.prediction for r in pr.predict_baseline(prep, pairs).collect()}
    assert a.keys() == b.keys()
    assert all(math.isclose(a[x], b[x], abs_tol=1e-12) for x in a)


def test_unrated_items(spark, table):
    want = [(2, i) for i in ITEMS if i != 1] + [(99, i) for i in ITEMS]
    for block in (1000, 1):  # blocks of users
        assert sorted((r.user_id, r.item_id) for r in rc.unrated_items(table, [2, 99], block).collect()) == want
    assert rc.unrated_items(table, []).count() == 0


def test_predictions_in_rating_range(prep, pairs):
    for kind in [pr.predict_baseline, pr.predict_cosine, pr.predict_jaccard]:
        vals = [r.prediction for r in kind(prep, pairs).collect()]
        assert all(1.0 - 1e-9 <= v <= 5.0 + 1e-9 for v in vals)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_dense_index_without_exchange_reuse(spark, reuse):
    from kinrank.functions.ranking import dense_index
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        ids = dense_index(spark.range(2_000_000), "id", "rank", num_partitions=200)
        row = ids.agg(F.countDistinct("rank").alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"),
                      F.sum((F.col("rank") != F.col("id") + 1).cast("int")).alias("bad")).first()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    assert tuple(row) == (2_000_000, 1, 2_000_000, 0)


@pytest.mark.parametrize("n, chunk", [(3, 4), (1, 1), (5, 8), (3, 256)])
def test_first_unseen(spark, n, chunk):
    import random
    rng = random.Random(n)
    items = sorted(rng.sample(range(1000), 40))
    seen = {0: items, 1: [], 2: items[:9], 3: items[1:30], 4: items[:-1], 5: rng.sample(items, 20), 6: items[::2]}
    rows = [(u, i) for u, s in seen.items() for i in s]
    got = rc.first_unseen(spark.createDataFrame([(u,) for u in seen], "user_id bigint"),
                          spark.createDataFrame(rows, "user_id bigint, item_id bigint"),
                          rc.item_order(spark.createDataFrame([(i,) for i in items], "item_id bigint"), F.lit(0)),
                          n, chunk=chunk, per_copy=3)
    want = sorted((u, i) for u, s in seen.items() for i in [x for x in items if x not in s][:n])
    assert sorted((r.user_id, r.item_id) for r in got.collect()) == want


def test_grouped_lists_in_chunks(spark, table):
    """Several chunks in both engines: the same rows, the whole size in each."""
    import duckdb

    from kinrank.operators import sets as st
    from kinrank.plans import oracle
    got = {tuple(r) for r in st.grouped_lists(table, "item_id", "user_id", 2, "users")
           .select("item_id", "n", "n_chunks", "chunk", "users").collect()}
    con = duckdb.connect()
    con.register("given", table.toPandas())
    base = dict(oracle.BASE)
    try:
        oracle.BASE["train"] = ("SELECT * FROM given", [])
        want = con.sql(oracle._lists("item_id", "user_id", "users", 2))
        cols = [want.columns.index(c) for c in ("item_id", "n", "n_chunks", "chunk", "users")]
        rows = {tuple(r[c] for c in cols) for r in want.fetchall()}
    finally:
        oracle.BASE.clear()
        oracle.BASE.update(base)
    assert got == rows and max(r[2] for r in got) > 1
    members = {}
    for i, n, _, _, users in got:
        members.setdefault((i, n), []).extend(users.split(","))
    assert all(len(m) == n for (_, n), m in members.items())


def test_many_buckets_cost_no_more(spark):
    import time
    users = spark.range(200).withColumnRenamed("id", "user_id")
    took = {}
    for p in (10, 10, 2000):
        t = time.time()
        assert nbm.user_buckets(users, p, 2).count() == 400
        took[p] = time.time() - t
    assert took[2000] < took[10] + 10


def test_dense_index(spark):
    from kinrank.functions.ranking import dense_index
    ids = [17, 3, 99, 3, 42, -5, 1000, 8, 17]
    df = spark.createDataFrame([(i,) for i in ids], "x bigint").repartition(3)
    got = sorted((r.x, r.rank) for r in dense_index(df, "x", "rank", num_partitions=4).collect())
    assert got == [(x, n + 1) for n, x in enumerate(sorted(set(ids)))]


def test_zero_norm_user_has_no_cosine_neighbours(prep):
    assert nbm.knn(prep, 3).filter(F.col("user_id") == 1).count() == 0


def test_report_sink_and_user_restriction(spark, table, prep):
    from kinrank.operators import evaluate as ev
    from kinrank.operators import sets as st
    rep = ev.report([("averages", "global_avg", table.agg(F.avg("rating").alias("g")), "g")])
    path = scratch_path(spark, "report")
    ev.write_report(rep, path)
    back = spark.read.json(path).collect()
    assert [(r.section, r.metric) for r in back] == [("averages", "global_avg")]
    users = spark.createDataFrame([(3,), (3,), (7,)], "user_id bigint")
    got = sorted((r.user_id, r.item_id) for r in st.restrict_users(table, users).collect())
    assert got == sorted((u, i) for u, i, _ in TRAIN if u in (3, 7))
    assert st.for_item(st.for_user(table, 3), 2).collect()[0].rating == 5.0


@pytest.mark.parametrize("k", [1, 3, 5, 7])
def test_low_users_bound_the_lists_with_negatives(prep, brute, k):
    low = {r.user_id for r in nbm.low_users(prep, k).collect()}
    met = {u: sum(len(brute.by_item[i]) - 1 for i in brute.by_user[u]) for u in USERS}
    assert low == {u for u in USERS if met[u] >= len(USERS) - k}
    assert {u for u in USERS if any(round(s, 9) < 0 for _, s in brute.ranked(u)[:k])} <= low


@pytest.mark.parametrize("k", [2, 9, 10, 11])
def test_knn_with_and_without_reachable_negatives(spark, k):
    """Twelve users in pairs of opposite tastes: a list reaches its negative
    at k = 11, so up to k = 9 no user is low and negatives are not ranked."""
    rows = [(u, i, float(1 + 4 * ((u + i) % 2))) for u in range(12) for i in (2 * (u // 2), 2 * (u // 2) + 1)]
    prep, brute = Prepared(spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")), Brute(rows)
    assert (nbm.low_users(prep, k).count() == 0) == (k < 10)
    got = {(r.user_id, r.neighbor_id): (r.pos, round(r.sim, 9)) for r in nbm.knn(prep, k, HotItems(prep.train)).collect()}
    want = {(u, v): (n + 1, round(s, 9)) for u in range(12) for n, (v, s) in enumerate(brute.ranked(u)[:k])
            if round(s, 9) != 0}
    assert got == want and bool(want) == (k == 11)
