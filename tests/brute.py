"""A brute-force, pure-Python statement of the rating formulas, used only by
the tests. It follows the list-based semantics directly: every neighbour
candidate is every other user, sorted ascending by similarity (stable, so
equal similarities keep ascending id order) and the last k are kept."""

from __future__ import annotations

import math
from collections import defaultdict


def scale(x, a):
    return 5.0 - a if x > a else (a - 1.0 if x < a else 1.0)


class Brute:
    def __init__(self, train):
        self.r = {(u, i): r for u, i, r in train}
        self.by_user = defaultdict(dict)
        self.by_item = defaultdict(dict)
        for (u, i), r in self.r.items():
            self.by_user[u][i] = r
            self.by_item[i][u] = r
        self.g = sum(self.r.values()) / len(self.r)
        self.ua = {u: sum(d.values()) / len(d) for u, d in self.by_user.items()}
        self.ia = {i: sum(d.values()) / len(d) for i, d in self.by_item.items()}
        self.dev = {(u, i): (r - self.ua[u]) / scale(r, self.ua[u]) for (u, i), r in self.r.items()}
        self.norm = {u: math.sqrt(sum(self.dev[(u, i)] ** 2 for i in d)) for u, d in self.by_user.items()}
        self.w = {(u, i): (self.dev[(u, i)] / self.norm[u] if self.norm[u] != 0 else 0.0)
                  for (u, i) in self.r}
        self.users = sorted(self.by_user)
        self.idev = {i: sum(self.dev[(u, i)] for u in d) / len(d) for i, d in self.by_item.items()}

    def cos(self, u, v):
        common = set(self.by_user[u]) & set(self.by_user[v])
        return sum(self.w[(u, i)] * self.w[(v, i)] for i in common)

    def jac(self, u, v):
        a, b = set(self.by_user[u]), set(self.by_user[v])
        return len(a & b) / len(a | b) if a | b else 0.0

    def knn(self, u, k):
        cands = [(v, self.cos(u, v)) for v in self.users if v != u]
        cands.sort(key=lambda t: round(t[1], 9))  # stable: equal sims keep ascending id
        kept = cands[len(cands) - k:] if k > 0 else []
        return dict(kept)

    def ranked(self, u):
        """All other users, best first: the sorted list read from its end."""
        cands = [(v, self.cos(u, v)) for v in self.users if v != u]
        cands.sort(key=lambda t: round(t[1], 9))
        return cands[::-1]

    def wdev(self, u, i, simf):
        num = den = 0.0
        for v in self.by_item.get(i, {}):
            s = simf(u, v)
            num += s * self.dev[(v, i)]
            den += abs(s)
        return num / den if den != 0 else 0.0

    def predict(self, kind, u, i, k=None):
        if kind == "global":
            return self.g
        if kind == "user_avg":
            return self.ua.get(u, self.g)
        if kind == "item_avg":
            return self.ia.get(i, self.g)
        if kind == "baseline":
            if i in self.idev:
                if u in self.ua:
                    a, d = self.ua[u], self.idev[i]
                    return a + d * scale(a + d, a)
                return self.g
            return self.ua.get(u, self.g)
        if u not in self.ua:
            return self.g
        if kind == "uniform":
            d = self.wdev(u, i, lambda a, b: 1.0)
        elif kind == "cosine":
            d = self.wdev(u, i, self.cos)
        elif kind == "jaccard":
            d = self.wdev(u, i, self.jac)
        elif kind == "knn":
            nb = self.knn(u, k)
            d = self.wdev(u, i, lambda a, b: nb.get(b, 0.0))
        else:
            raise ValueError(kind)
        a = self.ua[u]
        return a + d * scale(a + d, a)

    def recommend(self, u, n, k, items=None):
        items = sorted(items if items is not None else self.by_item)
        rated = set(self.by_user.get(u, {}))
        scored = [(i, self.predict("knn", u, i, k)) for i in items if i not in rated]
        scored.sort(key=lambda t: (-round(t[1], 9), t[0]))
        return scored[:n]
