"""Conversation repair, ranked search and source mixing against brute force,
with small segments, shards and blocks so that all seams are met."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kinrank.llm import conversations as conv
from kinrank.llm import mixing, registry, search

from ..conftest import SF_SMALL
from .conftest import edge_rows, frame

ROWS = edge_rows()
TALK = "conv long, turn long, role string, text string, conv_id string"


# ------------------------------------------------------------ conversations

def least_repair(rows):
    """(cost, audit, lines) of one conversation's rows (role, text) in order:
    every state's least (cost, audit) so far, over all edits."""
    seen, best = set(), {0: (0, "", [])}
    due = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}

    def add(into, state, entry):
        if state not in into or entry[:2] < into[state][:2]:
            into[state] = entry

    def inserted(now):
        for _ in range(3):
            more = dict(now)
            for s, (c, a, t) in now.items():
                add(more, due[s][1], (c + 2, a + "I", t + [due[s][0] + ":"]))
            now = more
        return now
    for role, text in rows:
        blank = not re.search(r"[^ \t-\r]", text)
        must = blank or (role, text) in seen
        seen.add((role, text))
        cut = 0 if blank or re.search(r"[^ \t-\r]", text) and text.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?" else 1
        after = {}
        for s, (c, a, t) in inserted(best).items():
            add(after, s, (c + 3, a + "D", t))
            if must:
                continue
            add(after, due[s][1], (c + 2 + cut, a + "R", t + [f"{due[s][0]}:{text}"]))
            to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], s))
            if to is not None:
                add(after, to, (c + cut, a + "K", t + [f"{role}:{text}"]))
        best = after
    return min(x for s, x in inserted(best).items() if s in (0, 3))


def brute_summary(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = {}
    for c, group in by.items():
        def key(r):
            role, text = " " if r[2] is None else r[2], " " if r[3] is None else r[3]
            return (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())
        group = sorted(group, key=key)
        group = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x, *_ in group]
        turns = [t for t, _, _ in group if t is not None]
        fault, seen = Counter(), set()
        for _, r, x in group:
            if not re.search(r"[^ \t-\r]", x):
                fault["blank"] += 1
            elif (r, x) in seen:
                fault["duplicate"] += 1
            elif x.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
                fault["truncated"] += 1
            seen.add((r, x))
        wrong = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(group, group[1:], strict=False))
        cost, audit, lines = least_repair([(r, x) for _, r, x in group])
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = (gaps, fault["blank"], fault["duplicate"], fault["truncated"], wrong, cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talks():
    rng = random.Random(4)
    rows = []
    for c in [*range(40), None]:
        for t in range(rng.choice([1, 2, 3, 7, 12])):
            rows.append((c, rng.choice([t, t, t, t // 2, None]),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "agent"]),
                         rng.choice([f"line {t}.", f"cut {t}", "", " \t", "same.", "same.", None, "日本語。", "ok!\n "]), "x"))
    for c, n in ((100, 300), (101, 90), (102, 41)):  # over many segments
        rows += [(c, t, rng.choice(["user", "assistant", "assistant", "system"]),
                  rng.choice([f"t{t}.", f"t{t}", "again.", ""]), "x") for t in range(n)]
    rows += [(103, 5, "user", "copy.", "x")] * 60  # equal rows
    return rows


@pytest.mark.parametrize("segment", [1, 2, 7, 64, 8192])
def test_repair(spark, segment):
    rows = talks()
    got, summary = conv.repair(spark.createDataFrame(rows, TALK).repartition(3), "conv", segment=segment)
    sha = {r["conv"]: r["sha256"] for r in conv.digests(conv.repaired(got)).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    found = {r["conv"]: (*[r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")],
                         sha.get(r["conv"], nothing)) for r in summary.collect()}
    assert found == brute_summary(rows)


def test_repair_of_nothing(spark):
    got, summary = conv.repair(spark.createDataFrame([], TALK), "conv")
    assert got.count() == summary.count() == 0 and conv.digests(conv.repaired(got)).count() == 0


def test_ranks_choose_the_least_of_all_optimal_audits():
    rng = random.Random(9)
    for _ in range(60):
        n = rng.randrange(1, 7)
        initial = np.array([rng.choice("sua") for _ in range(n)], dtype=object)
        must, cut = np.array([rng.random() < 0.2 for _ in range(n)]), np.array([rng.random() < 0.3 for _ in range(n)])
        p = conv.Pieces(np.array([0, n]), initial, must, cut)
        cost = p.costs(conv.END[None])
        _, audit, _ = p.edits(cost, np.ones(1, bool), np.array([0]), np.array([0]))
        to, final = p.arcs(cost, np.ones(1, bool))

        def all_audits(node, to=to, final=final):
            if final[node]:
                return [""]
            return [x + rest for x, t in zip(conv.LETTERS, to[node], strict=True) if t >= 0 for rest in all_audits(t)]
        assert audit[0] == min(all_audits(0))


def test_conversations_query_with_nulls(spark, tmp_path):
    rows = [(c, t, r, x) for c, t, r, x, _ in talks() if c != 103]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    from kinrank.plans.compare import _norm
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(conv.SQL).fetchall()
    got = [tuple(map(_norm, r)) for r in registry.queries()["op11_conversations"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted([tuple(r) for r in want], key=repr)


# ------------------------------------------------------------ search

def terms_of(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def brute_search(docs, items, k):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in set(items):
        q, scored = Counter(terms_of(text)), []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n // total
            s = sum(x * w[t] * (10 ** 9 * b[t] // (1000 * b[t] + 12 * m)) for t, x in q.items() if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k, shard_rows, query_bytes", [(20, 8192, 1 << 20), (3, 4, 40), (1, 1, 1 << 20)])
def test_search(spark, edges, nothing, k, shard_rows, query_bytes):
    items = [(0, "Thing onx éa"), (1, "one two"), (2, None), (3, ""), (4, " .,!"), (5, "same same line"), (None, "日本語 ab"),
             (6, ROWS[7][1]), (7, "nowhere else found"), (7, "one"), (8, "one two"), (8, "one two"), (9, ROWS[15][1][:400])]
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, id string")
    got = search.search(edges, asked, k=k, shard_rows=shard_rows, query_bytes=query_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search([r[:2] for r in ROWS], items, k)
    assert search.search(nothing, asked).count() == 0
    assert search.search(edges, asked.limit(0)).count() == 0


def test_nra_reads_until_all_is_resolved():
    rng = np.random.default_rng(3)
    for _ in range(150):
        n, k = int(rng.integers(1, 60)), int(rng.integers(1, 8))
        lists, full = [], np.zeros(n, np.int64)
        for _ in range(rng.integers(1, 9)):
            docs = rng.choice(n, rng.integers(1, n + 1), replace=False)
            impact = -np.sort(-rng.integers(0, 12, len(docs)))
            lists.append((docs, impact))
            full[docs] += impact
        found, score = search.nra(lists, n, k, step=int(rng.integers(1, 5)))
        assert (full[found] == score).all()
        order = sorted(range(n), key=lambda d: (-full[d], d))
        assert set(d for d in order[:k] if full[d] > 0) <= set(found.tolist())


def test_vocabulary_compares_bytes():
    words = search.Vocabulary([b"ab", b"abc", b"z"])
    data = np.frombuffer(b"abcabz", np.uint8)
    hit, v = words.find(data, np.array([0, 3, 5, 1]), np.array([3, 5, 6, 3]))
    assert [words.terms[i] for i in v] == [b"abc", b"ab", b"z"] and hit.tolist() == [0, 1, 2]
    words.data = np.frombuffer(words.data.tobytes().replace(b"z", b"q"), np.uint8)  # a hash alone does not count
    assert 2 not in words.find(data, np.array([0, 3, 5]), np.array([3, 5, 6]))[0]


# ------------------------------------------------------------ mixing

def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        share = (total - sum(most * sizes[s] for s in full)) / (sum(w[s] for s in open_) or 1)
        more = {s for s in open_ if w[s] * share > most * sizes[s]}
        if not more:
            return {s: float(most * sizes[s]) if s in full else w[s] * share for s in names}
        full |= more


def check_mix(rows, got):
    sizes, largest = Counter(), Counter()
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
        sizes[r[3]] += n
        largest[r[3]] = max(n, largest[r[3]])
    want, taken = brute_targets(sizes), Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["copies"] <= 3
        rate = want[r["source"]] / max(1, sizes[r["source"]])
        assert math.floor(rate + 1e-9) <= r["copies"] <= math.ceil(rate - 1e-9) or r["copies"] == round(rate)
        taken[r["source"]] += r["size"] * r["copies"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s], (s, taken[s], want[s])  # whole documents


def test_targets_stop_and_share_again(spark):
    rows = [(i, "w " * (i % 7), "en", s) for i, s in enumerate(["a"] * 3 + ["b"] * 200 + ["c"] * 30 + [None] * 9 + ["Z"] * 4)]
    rows += [(900 + i, "", "en", "empty") for i in range(3)]
    got = mixing.mix(frame(spark, rows), block=8).collect()  # many blocks and levels
    check_mix(rows, got)
    assert {r["copies"] for r in got if r["source"] == "empty"} == {0}
    assert {r["target"] for r in got if r["source"] == "Z"} == {3.0 * sum((i % 7) for i in range(242, 246))}


@pytest.mark.parametrize("broadcast", [100, 0])
def test_mix_of_edge_rows(spark, nothing, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    rng = random.Random(2)
    rows = [(*r, "en", rng.choice(["a", "b", None])) for r in ROWS]
    rows += [(1000 + i, "word " * rng.randrange(1, 60), "en", rng.choice(["a", "a", "b", "c", None])) for i in range(400)]
    df = frame(spark, rows)
    one = mixing.mix(df, block=64).collect()
    check_mix(rows, one)
    again = mixing.mix(df.repartition(5), block=64).collect()
    assert sorted(map(str, one)) == sorted(map(str, again))  # reruns agree
    assert mixing.mix(nothing).count() == 0


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(5)
    for _ in range(40):
        n = int(rng.integers(1, 80))
        size, p = rng.integers(0, 30, n), rng.random(n)
        out = mixing.flight(size, p, rng)
        assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2 and out.min() >= 0 and out.max() <= 1
        assert abs(out.sum() - p.sum()) < 1e-6 and abs((out * size).sum() - (p * size).sum()) < 1e-5
        done = mixing.landing(size, out)
        assert set(done.tolist()) <= {0.0, 1.0}


def test_flight_keeps_each_probability():
    size = np.array([3, 8, 2, 9, 4, 4])
    p = np.array([0.2, 0.5, 0.7, 0.3, 0.4, 0.6])
    mean = np.mean([mixing.flight(size, p, np.random.default_rng(i)) for i in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


def test_mixing_query_comes_near_its_targets(spark):
    rows = registry.queries()["op13_mixing"](spark, "/root/testdata/sf0.1").collect()
    docs = {r["doc_id"]: r["source"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()}
    taken, target = Counter(), {}
    for r in rows:
        taken[docs[r["doc_id"]]] += r["taken"]
        target[docs[r["doc_id"]]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert len(rows) == len(docs)
    assert all(abs(taken[s] - t) <= 0.01 * t for s, t in target.items())
    assert SF_SMALL
