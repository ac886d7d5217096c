"""N-gram Jaccard join by T-occurrence search (DivideSkip).

A document's set holds the hashes of its runs of ``words`` words. Documents
with the same set (the same 128 bits made of its hashes) are one class, and
only classes are compared.

1. How many classes have each shingle is counted exactly (``exchange.ask``).
2. Two linked sets share one of the rarest shingles of each (the prefix that
   the overlap leaves open), so classes that share a shingle in their prefixes
   are candidates. Classes connected by such shingles are a family; a class
   whose prefix holds shingles of its own only has no partner and ends here.
3. A family is cut into blocks of bounded size by bands of set size (partners
   are in the same or the next band) and by hash, and every two blocks that
   can hold partners meet in one task, once.
4. There the T-occurrence problem is solved for each set: its shingles'
   inverted lists are divided; short ones are merged, long ones are only
   probed by binary search for what the merge leaves, and the sets that reach
   the required overlap are links. A task gives back each set's number of
   links and a spanning forest, never the pairs.
5. Connected components of the forests are the groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm import arrays as A
from kinrank.llm import exchange as X
from kinrank.llm.common import pack, table, text_bytes, written
from kinrank.llm.graph import components

WORDS = 5
PERCENT = 80
WORD_BYTES = 6            # bytes of text for each shingle, about
BLOCK_SHINGLES = 1 << 18  # shingles of a block
BLOCK_SETS = 1024         # sets of a block
PROBE_COST = 1.0          # DivideSkip's weight of a probe against a merge step

_U = np.uint64


class Sets:
    """Shingle sets of texts: sorted distinct hashes ``h`` with offsets ``off``,
    sizes ``n`` and two numbers for each whole set, ``key`` and ``second``."""

    def __init__(self, texts: pa.ChunkedArray | pa.Array, words: int):
        block = A.block_of(texts)
        starts, ends, off = block.words()
        w = A.spans_hash(A.FOLD[block.data], starts, ends)
        count = np.diff(off)
        at = A.window_starts(off, words)
        short = np.flatnonzero((count > 0) & (count < words))
        h = np.concatenate([A.windows_hash(w, at, words), A.windows_hash(w, off[short], count[short])])
        doc = np.concatenate([A.text_of(off, at), short])
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        self.h, self.doc = h[new], doc[new]
        self.n = np.bincount(self.doc, minlength=block.n).astype(np.int64)
        self.off = np.concatenate([[0], np.cumsum(self.n)])
        a, b = (t[self.off[1:]] - t[self.off[:-1]] for t in
                (np.concatenate([np.zeros(1, _U), np.cumsum(A.mix(self.h ^ _U(k)), dtype=_U)])
                 for k in (0x2545F4914F6CDD1D, 0x6A09E667F3BCC909)))
        self.key = A.mix(A.mix(a) + b * _U(0x9E3779B97F4A7C15)).view(np.int64)
        self.second = A.mix(b).view(np.int64)

    def chosen(self, sets: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(one text for each of these sets ``c, d, u``, in the order of the
        texts, the sets' ``u``, flags of the texts' shingles)."""
        c, d, u = (sets.column(x).drop_null().to_numpy() for x in ("c", "d", "u"))
        keys, seconds, first, _, _ = X.distinct(self.key, self.second)
        of = X.distinct(np.concatenate([keys, c]), np.concatenate([seconds, d]))[3]
        which = np.full(len(of), -1)
        which[of[len(keys):]] = np.arange(len(c))
        which = which[of[:len(keys)]]
        order = np.argsort(first)
        order = order[(which[order] >= 0) & (self.n[first[order]] > 0)]
        flag = np.zeros(len(self.n), dtype=bool)
        flag[first[order]] = True
        return first[order], u[which[order]], flag[self.doc]


def least_overlap(n, percent: int):
    """Shingles that a set of n must share with any partner, at least."""
    return -(-n * percent // 100)


def t_occurrence(lists: list[np.ndarray], need: int, needs: np.ndarray) -> np.ndarray:
    """Members found in at least ``needs[member]`` of the sorted lists
    (``need``: the least of these numbers). DivideSkip: the longest lists are
    left out of the merge; a member can miss them all, so the merge keeps
    members with ``need`` less their number, and these are looked up in the
    long lists by binary search."""
    if len(lists) < need:
        return np.zeros(0, np.int64)
    lists = sorted(lists, key=len)
    longest = len(lists[-1])
    n_long = min(need - 1, int(need / (PROBE_COST * math.log2(longest + 1) + 1)))
    short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
    merged = np.sort(np.concatenate(short), kind="stable")  # the lists are sorted runs: a merge
    at = X.run_starts(merged)
    member, n = merged[at], np.diff(np.append(at, len(merged)))
    some = n >= needs[member] - n_long
    member, n = member[some], n[some]
    for k, one in enumerate(long):
        if not len(member):
            break
        place = np.searchsorted(one, member)
        n = n + (one[np.minimum(place, len(one) - 1)] == member)
        some = n >= needs[member] - (n_long - 1 - k)
        member, n = member[some], n[some]
    return member[n >= needs[member]]


def linked(h: np.ndarray, off: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> Iterator[tuple]:
    """(set, its partners) for the sets of ``left`` against those of ``right``;
    with ``left`` equal to ``right`` every pair once, from its first set."""
    n = np.diff(off)
    same = len(left) == len(right) and (left == right).all()
    items = np.concatenate([h[off[i]:off[i + 1]] for i in right])
    owner = np.repeat(np.arange(len(right)), n[right])
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    at = X.run_starts(items)
    known, ends = items[at], np.append(at[1:], len(items))
    for k, i in enumerate(left):
        mine = h[off[i]:off[i + 1]]
        place = np.searchsorted(known, mine)
        place = np.minimum(place, len(known) - 1)
        place = place[known[place] == mine]
        lists = [owner[at[p]:ends[p]] for p in place]
        if same:
            lists = [x for x in (one[np.searchsorted(one, k, side="right"):] for one in lists) if len(x)]
        if lists:
            needs = -(-percent * (n[i] + n[right]) // (100 + percent))
            got = t_occurrence(lists, int(least_overlap(n[i], percent)), needs)
            if len(got):
                yield i, right[got]


def _numbered(classes: DataFrame) -> DataFrame:
    """Classes ``c, d, ...`` with a number of their own, ``u``: ``c``, but for
    those that share it by chance with a smaller ``d``, which get a hash of
    both numbers."""
    own = F.col("d") == F.min("d").over(Window.partitionBy("c"))
    return classes.withColumn("u", F.when(own, F.col("c")).otherwise(F.xxhash64("c", "d")))


def _families(pre: DataFrame) -> DataFrame:
    """``c, family``: classes joined by shingles of their prefixes."""
    posting = pre.select("c", F.explode("tokens").alias("t"))
    hub = posting.groupBy("t").agg(F.min("c").alias("hub"), F.count("*").alias("n")).filter("n > 1").select("t", "hub")
    edges = posting.join(hub, "t").filter("c <> hub").select(F.col("c").alias("a"), F.col("hub").alias("b"))
    return components(edges).select(F.col("node").alias("c"), F.col("root").alias("family"))


def _meetings(members: DataFrame, percent: int, block_shingles: int, block_sets: int) -> DataFrame:
    """Every set once for each two blocks that it meets in, with its side
    (0 left, 1 right, 2 a block against itself)."""
    step = math.log(100 / (percent - 1))  # a little wider than the sizes of partners
    banded = members.withColumn("band", F.floor(F.log("n") / step).cast("int"))

    def blocks(n, sets):
        return F.greatest(F.ceil(n / block_shingles), F.ceil(sets / block_sets)).cast("int")
    sized = banded.groupBy("family", "band").agg(F.sum("n").alias("n"), F.count("*").alias("sets"))
    whole = sized.groupBy("family").agg(blocks(F.sum("n"), F.sum("sets")).alias("all"))
    sized = sized.join(whole, "family").withColumn("blocks", blocks(F.col("n"), F.col("sets")))
    near = sized.select("family", F.col("band").alias("other"), F.col("blocks").alias("there"))
    for name, shift in (("up", 1), ("down", -1)):
        sized = sized.join(near.select("family", (F.col("other") - shift).alias("band"),
                                       F.col("there").alias(name)), ["family", "band"], "left")
    sized = sized.select("family", "band", "all", "blocks", F.coalesce("up", F.lit(0)).alias("up"),
                         F.coalesce("down", F.lit(0)).alias("down"))
    i = F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")

    def meeting(low, a, b, side):
        return F.struct(low.alias("low"), a.cast("int").alias("i"), b.cast("int").alias("j"),
                        side.cast("int").alias("side"))

    def each(n, fn):
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), fn)).otherwise(F.array())
    b = F.col("band")
    same = each(F.col("blocks"), lambda j: meeting(
        2 * b, F.least(i, j), F.greatest(i, j), F.when(i < j, 0).when(i > j, 1).otherwise(2)))
    up = each(F.col("up"), lambda j: meeting(2 * b + 1, i, j, F.lit(0)))
    down = each(F.col("down"), lambda j: meeting(2 * b - 1, j, i, F.lit(1)))
    alone = F.array(meeting(F.lit(-1), F.lit(0), F.lit(0), F.lit(2)))  # a family that is one block
    return (banded.join(sized, ["family", "band"])
            .withColumn("m", F.explode(F.when(F.col("all") == 1, alone).otherwise(F.concat(same, up, down))))
            .select("family", "m.low", "m.i", "m.j", "m.side", "c", "members", "shingles"))


def _meet(t: pa.Table, percent: int) -> pa.Table:
    """Links of one meeting: ``c, root`` (in a spanning forest), ``links``
    (documents linked to the set in this meeting)."""
    t = t.sort_by([("c", "ascending")])
    some = [X.unsqueeze_sorted(b) for b in t.column("shingles").to_pylist()]
    off = np.concatenate([[0], np.cumsum([len(s) for s in some])]).astype(np.int64)
    h = np.concatenate(some)
    c, members, side = (t.column(x).to_numpy() for x in ("c", "members", "side"))
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    root, links = np.arange(len(c)), np.zeros(len(c), np.int64)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    if len(left) and len(right):
        for x, partners in linked(h, off, left, right, percent):
            links[x] += members[partners].sum()
            links[partners] += members[x]
            for y in partners:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    used = np.flatnonzero(links)
    top = np.array([find(x) for x in used], dtype=np.int64)
    return pa.Table.from_arrays([pa.array(c[used], pa.int64()), pa.array(c[top], pa.int64()),
                                 pa.array(links[used], pa.int64())], names=["c", "root", "links"])


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                 percent: int = PERCENT, slice_bytes: int = X.SLICE_BYTES,
                 block_shingles: int = BLOCK_SHINGLES, block_sets: int = BLOCK_SETS) -> DataFrame:
    """Groups of documents whose shingle sets' Jaccard similarity is at least
    ``percent`` / 100, linked directly or through others.

    Returns ``id, rest, n_shingles, n_links`` (other rows linked directly,
    equal sets included), ``component`` (smallest id in the group) and
    ``group`` (a number of the group's own, whatever its ids; null for the
    empty set), one row per input row. Words are runs of anything but ASCII white space, A-Z
    folded; a text with fewer than ``words`` words has one shingle.

    Defined cases: a null or empty text, or one of white space alone, has the
    empty set, no links and its own id as component; rows with equal sets are
    linked whatever their ids, so repeated rows are too; a null id is ignored
    for the smallest id, and is the component only where no member has an id;
    an empty table gives an empty table. No partner is dropped: popular
    shingles only come last in the order of rarity, and large families are cut
    into blocks that all meet.
    """
    if words < 1 or not 2 <= percent <= 100:
        raise ValueError("words from 1, percent from 2 to 100")
    src = pack(docs, id_col, text_col)
    total = text_bytes(src)
    src = X.sliced(src, total, slice_bytes)
    buckets = max(1, -(-total // (WORD_BYTES * X.BUCKET_HASHES)))
    kinds = dict(src.dtypes)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, block in A.blocks(batch):
                part = batch.slice(i, j - i)
                sets = Sets(part.column("text"), words)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("rest"), part.column("s"),
                                                  pa.array(sets.n, pa.int64()), pa.array(sets.key, pa.int64()),
                                                  pa.array(sets.second, pa.int64())],
                                                 names=["id", "rest", "s", "n", "c", "d"])

    rows = written(src.mapInArrow(signed, f"id {kinds['id']}, rest {kinds['rest']}, s int, n bigint, c bigint, d bigint"),
                   "sets")
    sets = rows.filter("n > 0").groupBy("c", "d").agg(F.min("s").alias("s"), F.count("*").alias("members"),
                                                      F.min("id").alias("least"))
    named = written(_numbered(sets), "classes")
    chosen = named.select("s", "c", "d", "u")
    classes = named.select(F.col("u").alias("c"), "members", "least")

    def build(t: pa.Table, reps: pa.Table):
        sets = Sets(t.column("text"), words) if t.num_rows else None
        if sets is None or not reps.num_rows:
            return np.zeros(0, _U), [np.zeros(0, np.uint32)]
        _, _, flag = sets.chosen(reps)
        keys, n = np.unique(sets.h[flag], return_counts=True)
        return keys, [n]

    def prefixes(t: pa.Table, back: pa.Table) -> pa.Table:
        out = []
        if t.num_rows and back.num_rows:
            sets = Sets(t.column("text"), words)
            texts, numbers, flag = sets.chosen(back)
            h, doc = sets.h[flag], sets.doc[flag]
            keys, place = np.unique(h, return_inverse=True)
            n = X.answers(back.filter(back.column("bucket").is_valid()), len(keys))[place]
            order = np.lexsort((h, n, doc))
            off = np.searchsorted(doc, np.append(texts, len(sets.n)))
            for k, i in enumerate(texts):
                mine = order[off[k]:off[k + 1]][:sets.n[i] - least_overlap(int(sets.n[i]), percent) + 1]
                shared = mine[n[mine] > 1]
                if len(shared):
                    out.append((int(numbers[k]), int(sets.n[i]), h[shared].view(np.int64),
                                X.squeeze_sorted(sets.h[sets.off[i]:sets.off[i + 1]])))
        c, size, tokens, packed = zip(*out, strict=True) if out else ([], [], [], [])
        return pa.Table.from_arrays([pa.array(c, pa.int64()), pa.array(size, pa.int64()),
                                     pa.array(tokens, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
                                    names=["c", "n", "tokens", "shingles"])

    by_slice = src.select("s", "text")
    back = X.ask(by_slice.groupBy("s").cogroup(chosen.groupBy("s")), buckets, build, [np.uint32],
                 lambda keys, p: X.total_of_runs(keys, p[0]), pair=True)
    told = chosen.unionByName(back, allowMissingColumns=True)
    pre = written(by_slice.groupBy("s").cogroup(told.groupBy("s"))
                  .applyInArrow(prefixes, "c bigint, n bigint, tokens array<bigint>, shingles binary"), "prefixes")
    members = (pre.select("c", "n", "shingles").join(_families(pre), "c")
               .join(classes.select("c", "members"), "c"))
    met = written(_meetings(members, percent, block_shingles, block_sets).groupBy("family", "low", "i", "j")
                  .applyInArrow(lambda t: _meet(t, percent), "c bigint, root bigint, links bigint"), "links")
    groups = components(met.select(F.col("c").alias("a"), F.col("root").alias("b")))
    least = (groups.join(classes.select(F.col("c").alias("node"), "least"), "node")
             .groupBy("root").agg(F.min("least").alias("component")))
    found = (groups.join(least, "root").select(F.col("node").alias("c"), "root", "component")
             .join(met.groupBy("c").agg(F.sum("links").alias("links")), "c"))
    per_class = (classes.join(found, "c", "left")
                 .select(F.col("c").alias("u"), F.coalesce("component", "least").alias("component"), F.coalesce("root", "c").alias("group"),
                         (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("links")))
    per_class = named.select("c", "d", "u").join(per_class, "u")
    return (rows.join(per_class, ["c", "d"], "left")
            .select("id", "rest", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"), "group"))


def q_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join(docs, words=4, percent=85).select(F.col("rest.doc_id").alias("doc_id"), "n_shingles",
                                     F.col("component").alias("component_id"), "n_links")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i + 3], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
df AS (SELECT h, count(*) AS f FROM sh GROUP BY h),
ranked AS (
  SELECT s.doc_id, s.h, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY f, s.h) AS r
  FROM sh s JOIN df USING (h) JOIN n ON n.doc_id = s.doc_id),
pre AS (SELECT doc_id, h, n FROM ranked WHERE r <= n - (85 * n + 99) // 100 + 1),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb
         FROM pre a JOIN pre b ON a.h = b.h AND a.doc_id < b.doc_id
         WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
ov AS (SELECT c.a, c.b, c.na, c.nb, count(*) AS i
       FROM cand c JOIN sh x ON x.doc_id = c.a JOIN sh y ON y.doc_id = c.b AND y.h = x.h GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM ov WHERE 100 * i >= 85 * (na + nb - i)),
sym AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a AS v, a AS u FROM sym UNION SELECT r.v, e.b FROM reach r JOIN sym e ON r.u = e.a),
comp AS (SELECT v, min(u) AS c FROM reach GROUP BY v),
deg AS (SELECT a, count(*) AS k FROM sym GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(comp.c, d.doc_id) AS component_id,
       coalesce(deg.k, 0)::BIGINT AS n_links
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp ON comp.v = d.doc_id LEFT JOIN deg ON deg.a = d.doc_id
"""
