"""SQL oracles (DuckDB dialect) for the registered queries.

Each query is a ``WITH`` list assembled from named CTEs plus a final
``SELECT``; ``_sql`` pulls in the CTEs a query needs, in dependency order.
The SQL restates the formulas directly (self-joins, windows, brute-force
candidate lists), independently of how the Spark operators are laid out.
"""

from __future__ import annotations

from kinrank.plans.catalog import (GRID, K, K_REC, LIST_CHUNK, N_BUCKETS, N_REC, PLAIN, PREDICTORS,
                                   REPLICATION, SWEEP_KS)

R6 = 6


def scale(x: str, a: str) -> str:
    return f"(CASE WHEN ({x}) > ({a}) THEN 5.0 - ({a}) WHEN ({x}) < ({a}) THEN ({a}) - 1.0 ELSE 1.0 END)"


def predict(a: str, d: str) -> str:
    return f"(({a}) + ({d}) * {scale(f'({a}) + ({d})', a)})"


def bhash(x: str, b: str) -> str:
    h1 = f"((({x}) % 2147483647) * 506952114 + ({b}) * 320743257 + 1337) % 2147483647"
    return f"((({h1}) * ({h1})) % 2147483647)"


def positions(name: str, src: str, k: int, where: str = "") -> dict:
    w = f"AND {where}" if where else ""
    return {
        f"{name}_nz": (f"SELECT user_id, neighbor_id, sim, round(sim, 9) AS sr FROM {src} "
                       f"WHERE round(sim, 9) <> 0 {w}", [src]),
        f"{name}_rk": (f"SELECT *, row_number() OVER (PARTITION BY user_id, sr > 0 "
                       f"ORDER BY sr DESC, neighbor_id DESC) AS rn, "
                       f"count(*) FILTER (WHERE sr < 0) OVER (PARTITION BY user_id) AS nneg "
                       f"FROM {name}_nz", [f"{name}_nz"]),
        f"{name}_all": (f"SELECT user_id, CASE WHEN sr > 0 THEN rn "
                        f"ELSE (SELECT n FROM nusers) - 1 - nneg + rn END AS pos, neighbor_id, sim "
                        f"FROM {name}_rk", [f"{name}_rk", "nusers"]),
        name: (f"SELECT user_id, CAST(pos AS BIGINT) AS pos, neighbor_id, sim FROM {name}_all "
               f"WHERE pos <= {k}", [f"{name}_all"]),
    }


BASE: dict[str, tuple[str, list[str]]] = {
    "ratings": ("SELECT o_custkey AS user_id, l_partkey AS item_id, "
                "max(1 + floor((l_quantity - 1) / 10)) AS rating "
                "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey", []),
    "test": ("SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 5 = 0", ["ratings"]),
    "train_split": ("SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 5 <> 0", ["ratings"]),
    "personal": ("SELECT CAST(-1 AS BIGINT) AS user_id, p_partkey AS item_id, "
                 "CAST(p_partkey % 6 AS DOUBLE) AS rating FROM part WHERE p_partkey % 6 <> 0", []),
    "train": ("SELECT * FROM train_split", ["train_split"]),
    "cold": ("SELECT CAST(user_id AS BIGINT) AS user_id, CAST(item_id AS BIGINT) AS item_id "
             "FROM (VALUES (-5, 1), (1, -5), (-5, -5)) t(user_id, item_id)", []),
    "pairs": ("SELECT user_id, item_id FROM test UNION ALL SELECT user_id, item_id FROM cold",
              ["test", "cold"]),
    "probe": ("SELECT CAST(1 AS BIGINT) AS user_id, CAST(1 AS BIGINT) AS item_id", []),
    "g": ("SELECT avg(rating) AS g FROM train", ["train"]),
    "ua": ("SELECT user_id, count(*) AS n, avg(rating) AS user_avg FROM train GROUP BY user_id", ["train"]),
    "ia": ("SELECT item_id, count(*) AS n, avg(rating) AS item_avg FROM train GROUP BY item_id", ["train"]),
    "dev": (f"SELECT t.user_id, t.item_id, t.rating, u.user_avg, u.n AS n_user, "
            f"(t.rating - u.user_avg) / {scale('t.rating', 'u.user_avg')} AS dev "
            f"FROM train t JOIN ua u ON t.user_id = u.user_id", ["train", "ua"]),
    "norms": ("SELECT user_id, sqrt(sum(dev * dev)) AS norm FROM dev GROUP BY user_id", ["dev"]),
    "w": ("SELECT d.user_id, d.item_id, d.dev, d.n_user, "
          "CASE WHEN n.norm <> 0 THEN d.dev / n.norm ELSE 0.0 END AS w "
          "FROM dev d JOIN norms n ON d.user_id = n.user_id", ["dev", "norms"]),
    "idev": ("SELECT item_id, count(*) AS n, avg(dev) AS avg_dev FROM dev GROUP BY item_id", ["dev"]),
    "pst": ("SELECT a.user_id AS u, b.user_id AS v, count(*) AS n_common, sum(a.w * b.w) AS cos, "
            "count(*) / (max(a.n_user) + max(b.n_user) - count(*)) AS jac "
            "FROM w a JOIN w b ON a.item_id = b.item_id AND a.user_id < b.user_id GROUP BY 1, 2", ["w"]),
    "cosdir": ("SELECT u AS user_id, v AS neighbor_id, cos AS sim FROM pst "
               "UNION ALL SELECT v, u, cos FROM pst", ["pst"]),
    "jacdir": ("SELECT u AS user_id, v AS neighbor_id, jac AS sim FROM pst "
               "UNION ALL SELECT v, u, jac FROM pst", ["pst"]),
    "cosfull": ("SELECT * FROM cosdir WHERE round(sim, 9) <> 0 UNION ALL "
                "SELECT user_id, user_id, sum(w * w) FROM w GROUP BY user_id HAVING round(sum(w * w), 9) <> 0",
                ["cosdir", "w"]),
    "jacfull": ("SELECT * FROM jacdir WHERE round(sim, 9) <> 0 UNION ALL "
                "SELECT user_id, user_id, 1.0 FROM ua", ["jacdir", "ua"]),
    "nusers": ("SELECT count(*) AS n FROM ua", ["ua"]),
    "ub_h": (f"SELECT u.user_id, p.bucket, {bhash('u.user_id', 'p.bucket')} AS h "
             f"FROM ua u, (SELECT range AS bucket FROM range(0, {N_BUCKETS})) p", ["ua"]),
    "ub": (f"SELECT bucket, user_id FROM (SELECT *, row_number() OVER "
           f"(PARTITION BY user_id ORDER BY h, bucket) AS rn FROM ub_h) x WHERE rn <= {REPLICATION}",
           ["ub_h"]),
    "apst": ("SELECT p.* FROM pst p WHERE EXISTS (SELECT 1 FROM ub x JOIN ub y ON x.bucket = y.bucket "
             "WHERE x.user_id = p.u AND y.user_id = p.v)", ["pst", "ub"]),
    "acosdir": ("SELECT u AS user_id, v AS neighbor_id, cos AS sim FROM apst "
                "UNION ALL SELECT v, u, cos FROM apst", ["apst"]),
    "ks": ("SELECT * FROM (VALUES " + ", ".join(f"({k})" for k in SWEEP_KS) + ") t(k)", []),
    "allpairs": ("SELECT user_id, item_id FROM ratings UNION ALL SELECT user_id, item_id FROM cold",
                 ["ratings", "cold"]),
}
BASE.update(positions("knn", "cosdir", K))
BASE.update(positions("aknn", "acosdir", K))
BASE.update(positions("knnmax", "cosdir", max(SWEEP_KS)))

PERSONAL = {"train": ("SELECT * FROM ratings UNION ALL SELECT * FROM personal", ["ratings", "personal"])}


def _wdev(name: str, src: str, nb: str) -> dict:
    return {name: (f"SELECT p.user_id, p.item_id, sum(nb.sim * d.dev) AS num, sum(abs(nb.sim)) AS den "
                   f"FROM {src} p JOIN dev d ON d.item_id = p.item_id "
                   f"JOIN {nb} nb ON nb.user_id = p.user_id AND nb.neighbor_id = d.user_id "
                   f"GROUP BY p.user_id, p.item_id", [src, "dev", nb])}


def predictor(kind: str, src: str) -> tuple[str, dict]:
    """CTEs computing ``user_id, item_id, prediction`` (+ ``rating`` if
    ``src`` has one) for every row of ``src``; returns (cte name, ctes)."""
    name = f"pred_{kind}_{src}"
    cols = "p.*"
    g = "(SELECT g FROM g)"
    if kind == "global":
        return name, {name: (f"SELECT {cols}, {g} AS prediction FROM {src} p", [src, "g"])}
    if kind == "user_avg":
        return name, {name: (f"SELECT {cols}, coalesce(u.user_avg, {g}) AS prediction FROM {src} p "
                             f"LEFT JOIN ua u ON u.user_id = p.user_id", [src, "ua", "g"])}
    if kind == "item_avg":
        return name, {name: (f"SELECT {cols}, coalesce(i.item_avg, {g}) AS prediction FROM {src} p "
                             f"LEFT JOIN ia i ON i.item_id = p.item_id", [src, "ia", "g"])}
    if kind in ("baseline", "uniform"):
        # baseline: item known -> (user known ? ua + idev*scale : g); item unknown -> ua or g
        body = (f"SELECT {cols}, CASE WHEN i.item_id IS NOT NULL THEN "
                f"(CASE WHEN u.user_id IS NOT NULL THEN {predict('u.user_avg', 'i.avg_dev')} ELSE {g} END) "
                f"ELSE coalesce(u.user_avg, {g}) END AS prediction FROM {src} p "
                f"LEFT JOIN ua u ON u.user_id = p.user_id LEFT JOIN idev i ON i.item_id = p.item_id")
        if kind == "uniform":
            # uniform weights: average deviation over the raters, written out
            wd = f"wd_uniform_{src}"
            ctes = {wd: (f"SELECT p.user_id, p.item_id, sum(d.dev) AS num, count(*) AS den "
                         f"FROM {src} p JOIN dev d ON d.item_id = p.item_id GROUP BY 1, 2", [src, "dev"])}
            ctes.update(_finish(name, src, wd))
            return name, ctes
        return name, {name: (body, [src, "ua", "idev", "g"])}
    nb = {"cosine": "cosfull", "jaccard": "jacfull", "knn": "knn", "approx_knn": "aknn"}[kind]
    wd = f"wd_{kind}_{src}"
    ctes = _wdev(wd, src, nb)
    ctes.update(_finish(name, src, wd))
    return name, ctes


def _finish(name: str, src: str, wd: str) -> dict:
    d = "coalesce(CASE WHEN w.den <> 0 THEN w.num / w.den ELSE 0.0 END, 0.0)"
    return {name: (f"SELECT p.*, CASE WHEN u.user_id IS NULL THEN (SELECT g FROM g) "
                   f"ELSE {predict('u.user_avg', d)} END AS prediction FROM {src} p "
                   f"LEFT JOIN ua u ON u.user_id = p.user_id "
                   f"LEFT JOIN {wd} w ON w.user_id = p.user_id AND w.item_id = p.item_id",
                   [src, "ua", wd, "g"])}


def _half_up(sql: str) -> str:
    """Rewrite every ``round(expr, d)`` into ``floor(expr * 10^d + 0.5) / 10^d``
    (the rounding the Spark side uses; see ``round_half_up``)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k, comma = 0, j + len("round("), -1
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        expr = _half_up(sql[j + len("round("):comma])
        digits = int(sql[comma + 1:k])
        out.append(f"(floor(({expr}) * {float(10 ** digits)} + 0.5) / {float(10 ** digits)})")
        i = k + 1


def _sql(final: str, needs: list[str], extra: dict | None = None, override: dict | None = None) -> str:
    lib = dict(BASE)
    if extra:
        lib.update(extra)
    if override:
        lib.update(override)
    order: list[str] = []
    seen: set[str] = set()

    def visit(n: str):
        if n in seen:
            return
        seen.add(n)
        for dep in lib[n][1]:
            visit(dep)
        order.append(n)
    for n in needs:
        visit(n)
    body = ",\n".join(f"{n} AS ({lib[n][0]})" for n in order)
    return _half_up(f"WITH {body}\n{final}")


def _pred_query(kind: str) -> str:
    name, ctes = predictor(kind, "pairs")
    return _sql(f"SELECT user_id, item_id, round(prediction, {R6}) AS prediction FROM {name}", [name], ctes)


def _mae_query(kind: str) -> str:
    name, ctes = predictor(kind, "test")
    return _sql(f"SELECT count(*) AS n, round(avg(abs(prediction - rating)), {R6}) AS mae FROM {name}",
                [name], ctes)


def _lists(key: str, member: str, name: str, chunk: int = LIST_CHUNK) -> str:
    h = bhash(f"t.{member}", "0")
    return _sql(
        f"SELECT {key}, max(size) AS n, max(n_chunks) AS n_chunks, chunk, "
        f"string_agg(CAST({member} AS VARCHAR), ',' ORDER BY {member}) AS {name} FROM ("
        f"SELECT t.{key}, t.{member}, s.size, CAST(ceil(s.size / {chunk}) AS BIGINT) AS n_chunks, "
        f"CAST({h} % ceil(s.size / {chunk}) AS BIGINT) AS chunk "
        f"FROM train t JOIN (SELECT {key}, count(*) AS size FROM train GROUP BY {key}) s "
        f"ON s.{key} = t.{key}) x GROUP BY {key}, chunk", ["train"])


def _recommend(users: str, k: int, personal: bool, n: int, src: str = "cosdir") -> tuple[list[str], dict, dict]:
    """Brute force: every unrated item of every listed user, scored."""
    extra = positions("rknn", src, k, where=f"user_id IN (SELECT user_id FROM {users})")
    extra.update({
        "items": ("SELECT DISTINCT item_id FROM train", ["train"]),
        "cands": (f"SELECT u.user_id, i.item_id FROM {users} u, items i "
                  f"WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id "
                  f"AND t.item_id = i.item_id)", [users, "items", "train"]),
    })
    extra.update(_wdev("rwd", "cands", "rknn"))
    extra.update(_finish("rpred", "cands", "rwd"))
    extra["rtop"] = (f"SELECT user_id, CAST(rank AS BIGINT) AS rank, item_id, prediction FROM ("
                     f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(prediction, 9) DESC, "
                     f"item_id ASC) AS rank FROM rpred) x WHERE rank <= {n}", ["rpred"])
    return ["rtop"], extra, (PERSONAL if personal else {})


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["rating_stats"] = _sql(f"SELECT count(*) AS n, round(avg(rating), {R6}) AS avg_rating, "
                             f"round(stddev_pop(rating), {R6}) AS std_rating FROM train", ["train"])
    q["global_average"] = _sql(f"SELECT round(avg(rating), {R6}) AS avg_rating FROM train", ["train"])
    q["user_average"] = _sql(f"SELECT user_id, n, round(user_avg, {R6}) AS user_avg FROM ua", ["ua"])
    q["item_average"] = _sql(f"SELECT item_id, n, round(item_avg, {R6}) AS item_avg FROM ia", ["ia"])
    q["item_average_deviation"] = _sql(f"SELECT item_id, n, round(avg_dev, {R6}) AS avg_dev FROM idev", ["idev"])
    q["normalized_deviations"] = _sql(f"SELECT user_id, item_id, round(dev, {R6}) AS dev FROM dev", ["dev"])
    q["l2_normalized_deviations"] = _sql(f"SELECT user_id, item_id, round(w, {R6}) AS w FROM w", ["w"])
    q["rating_lookup"] = _sql("SELECT p.user_id, p.item_id, r.rating FROM pairs p LEFT JOIN ratings r "
                              "ON r.user_id = p.user_id AND r.item_id = p.item_id", ["pairs", "ratings"])
    q["items_by_user"] = _lists("user_id", "item_id", "items")
    q["raters_by_item"] = _lists("item_id", "user_id", "users")
    q["common_items"] = _sql("SELECT u, v, n_common FROM pst", ["pst"])
    q["cosine_similarity"] = _sql(f"SELECT u, v, round(cos, {R6}) AS sim FROM pst WHERE round(cos, 9) <> 0",
                                  ["pst"])
    q["jaccard_similarity"] = _sql(f"SELECT u, v, round(jac, {R6}) AS sim FROM pst WHERE round(jac, 9) <> 0",
                                   ["pst"])
    q["knn_neighbors"] = _sql(f"SELECT user_id, pos, neighbor_id, round(sim, {R6}) AS sim FROM knn", ["knn"])
    q["user_buckets"] = _sql("SELECT CAST(bucket AS INTEGER) AS bucket, user_id FROM ub", ["ub"])
    q["approx_knn_neighbors"] = _sql(f"SELECT user_id, pos, neighbor_id, round(sim, {R6}) AS sim FROM aknn",
                                     ["aknn"])
    wd = _wdev("wdk", "pairs", "knn")
    q["weighted_deviation_knn"] = _sql(
        f"SELECT p.user_id, p.item_id, round(coalesce(CASE WHEN w.den <> 0 THEN w.num / w.den ELSE 0.0 END, 0.0), "
        f"{R6}) AS wdev FROM pairs p LEFT JOIN wdk w ON w.user_id = p.user_id AND w.item_id = p.item_id",
        ["pairs", "wdk"], wd)
    for kind in PREDICTORS:
        q[f"predict_{kind}"] = _pred_query(kind)
    # keep_known: a rating already in train is returned as it is
    name, ctes = predictor("knn", "unknown_pairs")
    ctes["unknown_pairs"] = ("SELECT * FROM allpairs a WHERE NOT EXISTS (SELECT 1 FROM train t "
                             "WHERE t.user_id = a.user_id AND t.item_id = a.item_id)", ["allpairs", "train"])
    q["predict_knn_keep_known"] = _sql(
        f"SELECT a.user_id, a.item_id, round(t.rating, {R6}) AS prediction FROM allpairs a "
        f"JOIN train t ON t.user_id = a.user_id AND t.item_id = a.item_id "
        f"UNION ALL SELECT user_id, item_id, round(prediction, {R6}) FROM {name}",
        ["allpairs", "train", name], ctes)
    for kind in PREDICTORS:
        q[f"mae_{kind}"] = _mae_query(kind)
    sweep = {
        "nbk": ("SELECT ks.k, n.* FROM knnmax n JOIN ks ON n.pos <= ks.k", ["knnmax", "ks"]),
        "wdsweep": ("SELECT nb.k, p.user_id, p.item_id, sum(nb.sim * d.dev) AS num, sum(abs(nb.sim)) AS den "
                    "FROM test p JOIN dev d ON d.item_id = p.item_id "
                    "JOIN nbk nb ON nb.user_id = p.user_id AND nb.neighbor_id = d.user_id GROUP BY 1, 2, 3",
                    ["test", "dev", "nbk"]),
        "predsweep": ("SELECT ks.k, p.rating, CASE WHEN u.user_id IS NULL THEN (SELECT g FROM g) ELSE "
                      + predict("u.user_avg",
                                "coalesce(CASE WHEN w.den <> 0 THEN w.num / w.den ELSE 0.0 END, 0.0)")
                      + " END AS prediction FROM test p CROSS JOIN ks LEFT JOIN ua u ON u.user_id = p.user_id "
                      "LEFT JOIN wdsweep w ON w.k = ks.k AND w.user_id = p.user_id AND w.item_id = p.item_id",
                      ["test", "ks", "ua", "wdsweep", "g"]),
    }
    q["mae_knn_sweep"] = _sql(f"SELECT CAST(k AS BIGINT) AS k, count(*) AS n, "
                              f"round(avg(abs(prediction - rating)), {R6}) AS mae FROM predsweep GROUP BY k",
                              ["predsweep"], sweep)
    q["union_personal"] = _sql("SELECT * FROM ratings UNION ALL SELECT * FROM personal", ["ratings", "personal"])
    q["unrated_candidates"] = _sql(
        "SELECT CAST(-1 AS BIGINT) AS user_id, i.item_id FROM (SELECT DISTINCT item_id FROM train) i "
        "WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = -1 AND t.item_id = i.item_id)",
        ["train"], override=PERSONAL)
    q["unrated_counts"] = _sql(
        "SELECT user_id, (SELECT count(DISTINCT item_id) FROM train) - count(DISTINCT item_id) AS n_candidates "
        "FROM train GROUP BY user_id", ["train"])
    one = {"target": ("SELECT CAST(-1 AS BIGINT) AS user_id", [])}
    needs, extra, ov = _recommend("target", K_REC, True, N_REC)
    extra.update(one)
    q["recommend_top_n"] = _sql(f"SELECT user_id, rank, item_id, round(prediction, {R6}) AS prediction FROM rtop",
                                needs, extra, ov)
    q["recommend_with_titles"] = _sql(
        f"SELECT r.rank, r.item_id, p.p_name AS title, round(r.prediction, {R6}) AS prediction "
        f"FROM rtop r LEFT JOIN part p ON p.p_partkey = r.item_id", needs, extra, ov)
    needs, extra, ov = _recommend("allusers", K, False, N_REC)
    extra["allusers"] = ("SELECT user_id FROM ua", ["ua"])
    q["recommend_top_n_all"] = _sql(
        f"SELECT user_id, rank, item_id, round(prediction, {R6}) AS prediction FROM rtop", needs, extra, ov)

    needs, extra, ov = _recommend("allusers", K, False, N_REC, "acosdir")
    extra["allusers"] = ("SELECT user_id FROM ua", ["ua"])
    q["recommend_top_n_approx"] = _sql(
        f"SELECT user_id, rank, item_id, round(prediction, {R6}) AS prediction FROM rtop", needs, extra, ov)
    name, extra = predictor("baseline", "cands")
    extra.update(one)
    extra["cands"] = ("SELECT u.user_id, i.item_id FROM target u, (SELECT DISTINCT item_id FROM train) i "
                      "WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id "
                      "AND t.item_id = i.item_id)", ["target", "train"])
    q["recommend_top_n_baseline"] = _sql(
        f"SELECT user_id, CAST(rank AS BIGINT) AS rank, item_id, round(prediction, {R6}) AS prediction FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(prediction, 9) DESC, item_id) AS rank "
        f"FROM {name}) x WHERE rank <= {N_REC}", [name], extra, PERSONAL)

    # lookups for given pairs: each test user with every rater of its test items
    met = {"met": ("SELECT DISTINCT p.user_id AS u, t.user_id AS v FROM test p JOIN train t "
                   "ON t.item_id = p.item_id WHERE p.user_id <> t.user_id", ["test", "train"])}
    q["similarity_of_pairs"] = _sql(
        f"SELECT m.u, m.v, coalesce(p.n_common, 0) AS n_common, round(coalesce(p.cos, 0.0), {R6}) AS cos, "
        f"round(coalesce(p.jac, 0.0), {R6}) AS jac FROM met m LEFT JOIN pst p "
        f"ON p.u = least(m.u, m.v) AND p.v = greatest(m.u, m.v)", ["met", "pst"], met)
    q["common_items_of_pairs"] = _sql(
        "SELECT m.u, m.v, a.item_id FROM met m JOIN train a ON a.user_id = m.u "
        "JOIN train b ON b.user_id = m.v AND b.item_id = a.item_id", ["met", "train"], met)
    q["neighbor_weights_of_pairs"] = _sql(
        f"SELECT m.u, m.v, round(coalesce(n.sim, 0.0), {R6}) AS weight FROM met m LEFT JOIN knn n "
        f"ON n.user_id = m.u AND n.neighbor_id = m.v", ["met", "knn"], met)
    q["restrict_users"] = _sql("SELECT * FROM train WHERE user_id IN (SELECT user_id FROM test)", ["train", "test"])
    q["rows_of_user"] = _sql("SELECT * FROM ratings WHERE user_id = 1", ["ratings"])
    q["rows_of_item"] = _sql("SELECT * FROM ratings WHERE item_id = 1", ["ratings"])
    q["read_titles"] = "SELECT p_partkey AS item_id, trim(p_name) AS title FROM part"
    name, ctes = predictor("approx_knn", "unknown_pairs")
    ctes["unknown_pairs"] = ("SELECT * FROM allpairs a WHERE NOT EXISTS (SELECT 1 FROM train t "
                             "WHERE t.user_id = a.user_id AND t.item_id = a.item_id)", ["allpairs", "train"])
    q["predict_approx_knn_keep_known"] = _sql(
        f"SELECT a.user_id, a.item_id, round(t.rating, {R6}) AS prediction FROM allpairs a "
        f"JOIN train t ON t.user_id = a.user_id AND t.item_id = a.item_id "
        f"UNION ALL SELECT user_id, item_id, round(prediction, {R6}) FROM {name}",
        ["allpairs", "train", name], ctes)
    ctes = positions("rknn", "cosdir", K_REC, where="user_id = -1")
    ctes["pall"] = ("SELECT CAST(-1 AS BIGINT) AS user_id, p_partkey AS item_id FROM part", [])
    ctes.update(_wdev("pwd", "pall", "rknn"))
    ctes.update(_finish("ppred", "pall", "pwd"))
    q["predict_personal"] = _sql(
        f"SELECT p.user_id, p.item_id, round(coalesce(t.rating, p.prediction), {R6}) AS prediction FROM ppred p "
        f"LEFT JOIN train t ON t.user_id = p.user_id AND t.item_id = p.item_id", ["ppred", "train"], ctes, PERSONAL)

    # metrics report
    parts, extra = [], {}
    parts.append("SELECT 'averages' AS section, 'global_avg' AS metric, avg(rating) AS value FROM train")
    parts.append("SELECT 'averages', 'user_1_avg', user_avg FROM ua WHERE user_id = 1")
    parts.append("SELECT 'averages', 'item_1_avg', item_avg FROM ia WHERE item_id = 1")
    parts.append("SELECT 'averages', 'item_1_avg_dev', avg_dev FROM idev WHERE item_id = 1")
    needs = ["train", "ua", "ia", "idev"]
    for kind in PREDICTORS:
        for src in ("test", "probe"):
            name, ctes = predictor(kind, src)
            extra.update(ctes)
            needs.append(name)
            parts.append(f"SELECT 'mae', '{kind}', avg(abs(prediction - rating)) FROM {name}" if src == "test" else
                         f"SELECT 'prediction_1_1', '{kind}', prediction FROM {name}")
    for metric, col in (("cosine", "cos"), ("jaccard", "jac")):
        parts.append(f"SELECT 'similarity_1_2', '{metric}', coalesce((SELECT {col} FROM pst WHERE u = 1 AND v = 2), 0.0)")
    extra.update(sweep)
    needs += ["pst", "predsweep"]
    parts.append("SELECT 'mae_knn_sweep', 'k=' || k, avg(abs(prediction - rating)) FROM predsweep GROUP BY k")
    q["metrics_report"] = _sql(
        f"SELECT section, metric, round(value, {R6}) AS value FROM ({' UNION ALL '.join(parts)}) r",
        needs, extra)
    # the plain predictors' answers
    plain = [x for x in parts if "kNN" not in x and any(f"'{m}'" in x for m in (
        "global_avg", "user_1_avg", "item_1_avg", "item_1_avg_dev", *PLAIN))]
    q["answers_report"] = _sql(
        f"SELECT section, metric, round(value, {R6}) AS value FROM ({' UNION ALL '.join(plain)}) r",
        ["train", "ua", "ia", "idev", *[predictor(kind, src)[0] for kind in PLAIN for src in ("test", "probe")]], extra)
    q["knn_neighbors_pruned"] = q["knn_neighbors"]

    def ranked(group: str) -> dict:
        """Positions inside groups (columns ``group`` and user) of ``gdir``."""
        return {
            "gnz": (f"SELECT *, round(sim, 9) AS sr FROM gdir WHERE round(sim, 9) <> 0", ["gdir"]),
            "grk": (f"SELECT *, row_number() OVER (PARTITION BY {group}, user_id, sr > 0 ORDER BY sr DESC, neighbor_id DESC) "
                    f"AS rn, count(*) FILTER (WHERE sr < 0) OVER (PARTITION BY {group}, user_id) AS nneg FROM gnz", ["gnz"]),
            "gpos": (f"SELECT * FROM (SELECT *, CASE WHEN sr > 0 THEN rn ELSE (SELECT n FROM nusers) - 1 - nneg + rn END "
                     f"AS pos FROM grk) x WHERE pos <= {K}", ["grk", "nusers"]),
        }
    inside = {"gpair": ("SELECT x.bucket, p.u, p.v, p.cos FROM pst p JOIN ub x ON x.user_id = p.u "
                        "JOIN ub y ON y.user_id = p.v AND y.bucket = x.bucket", ["pst", "ub"]),
              "gdir": ("SELECT bucket, u AS user_id, v AS neighbor_id, cos AS sim FROM gpair "
                       "UNION ALL SELECT bucket, v, u, cos FROM gpair", ["gpair"]), **ranked("bucket")}
    q["bucket_knn_neighbors"] = _sql(
        f"SELECT CAST(bucket AS INTEGER) AS bucket, user_id, CAST(pos AS BIGINT) AS pos, neighbor_id, "
        f"round(sim, {R6}) AS sim FROM gpos", ["gpos"], inside)
    settings = ", ".join(f"({g}, {n}, {r})" for g, (n, r) in enumerate(GRID))
    over = {"grid": (f"SELECT * FROM (VALUES {settings}) t(g, n_buckets, replication)", []),
            "gh": (f"SELECT g.*, u.user_id, p.bucket, {bhash('u.user_id', 'p.bucket')} AS h FROM ua u, grid g, "
                   f"(SELECT range AS bucket FROM range(0, {max(n for n, _ in GRID)})) p WHERE p.bucket < g.n_buckets",
                   ["ua", "grid"]),
            "gub": ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g, user_id ORDER BY h, bucket) AS rn FROM gh) x "
                    "WHERE rn <= replication", ["gh"]),
            "gsees": ("SELECT DISTINCT x.g, x.user_id AS u, y.user_id AS v FROM gub x JOIN gub y "
                      "ON x.g = y.g AND x.bucket = y.bucket AND x.user_id < y.user_id", ["gub"]),
            "gpair": ("SELECT s.g, p.u, p.v, p.cos FROM pst p JOIN gsees s ON s.u = p.u AND s.v = p.v", ["pst", "gsees"]),
            "gdir": ("SELECT g, u AS user_id, v AS neighbor_id, cos AS sim FROM gpair "
                     "UNION ALL SELECT g, v, u, cos FROM gpair", ["gpair"]), **ranked("g")}
    q["approx_knn_recall"] = _sql(
        f"SELECT g.n_buckets, g.replication, (SELECT count(*) FROM knn) AS n_exact, count(k.user_id) AS n_found, "
        f"round(count(k.user_id) / (SELECT count(*) FROM knn), {R6}) AS recall FROM grid g JOIN gpos p ON p.g = g.g "
        f"LEFT JOIN knn k ON k.user_id = p.user_id AND k.neighbor_id = p.neighbor_id GROUP BY 1, 2",
        ["grid", "gpos", "knn"], over)
    q["item_set_sizes"] = _sql(
        "SELECT a.user_id AS u, a.user_id + 1 AS v, len(list_distinct(list_concat(a.items, coalesce(b.items, [])))) AS n_union, "
        "len(list_intersect(a.items, coalesce(b.items, []))) AS n_common FROM lists a LEFT JOIN lists b "
        "ON b.user_id = a.user_id + 1", ["lists"],
        {"lists": ("SELECT user_id, list(item_id) AS items FROM train GROUP BY user_id", ["train"])})
    q["append_personal"] = _sql(f"SELECT item_id, n, round(avg_dev, {R6}) AS avg_dev FROM idev", ["idev"],
                                override=PERSONAL)
    name, ctes = predictor("baseline", "pairs")
    q["append_ratings"] = _sql(
        f"SELECT user_id, item_id, round(prediction, {R6}) AS prediction FROM {name}", [name], ctes,
        {"train": ("SELECT * FROM train_split UNION ALL SELECT * FROM test WHERE user_id % 2 = 0", ["train_split", "test"])})
    q["layout_by_user"] = _sql(f"SELECT t.user_id, t.item_id, t.rating, u.n, round(u.user_avg, {R6}) AS user_avg "
                               "FROM test t JOIN ua u ON u.user_id = t.user_id", ["test", "ua"])
    q["layout_by_item"] = _sql(f"SELECT t.user_id, t.item_id, t.rating, i.n, round(i.item_avg, {R6}) AS item_avg "
                               "FROM test t JOIN ia i ON i.item_id = t.item_id", ["test", "ia"])
    # everybody's top n, every unrated item ranked; equal at nine decimals of
    # what the prediction depends on means equal
    unrated = {"cands": ("SELECT u.user_id, i.item_id FROM ua u, (SELECT DISTINCT item_id FROM train) i "
                         "WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = i.item_id)",
                         ["ua", "train"])}
    keys = {"global": "0.0", "user_avg": "0.0", "item_avg": "i.item_avg",
            "baseline": "CASE WHEN u.user_avg >= 5 THEN least(d.avg_dev, 0.0) WHEN u.user_avg <= 1 "
                        "THEN greatest(d.avg_dev, 0.0) ELSE d.avg_dev END"}
    for kind, key in keys.items():
        name, ctes = predictor(kind, "cands")
        q[f"recommend_top_n_{kind}_all"] = _sql(
            f"SELECT user_id, CAST(rank AS BIGINT) AS rank, item_id, round(prediction, {R6}) AS prediction FROM ("
            f"SELECT p.*, row_number() OVER (PARTITION BY p.user_id ORDER BY round({key}, 9) DESC, p.item_id) AS rank "
            f"FROM {name} p JOIN ua u ON u.user_id = p.user_id JOIN ia i ON i.item_id = p.item_id "
            f"JOIN idev d ON d.item_id = p.item_id) x WHERE rank <= {N_REC}",
            [name, "ua", "ia", "idev"], {**ctes, **unrated})
    q["read_ratings"] = _sql("SELECT user_id, item_id, rating FROM ratings", ["ratings"])
    q["read_personal"] = _sql("SELECT user_id, item_id, rating FROM personal", ["personal"])
    return q
