"""Substring deduplication by compaction of a token de Bruijn graph.

Edges are the windows of ``K`` consecutive words (an edge joins its first and
its last K-1 words). Edges are counted over all documents by a hash. Where a
document runs through consecutive edges of one multiplicity above one, they
are compacted to a path. Each slice of documents sends its distinct paths,
named by an independent hash of their words, with their numbers, and a Spark
aggregate and join tells how often each whole path occurs:

* A path is nonbranching when it occurs as often as its edges do: every
  occurrence of an edge lies on a copy of the path. Two independent hashes
  agree there, and the path's words go wherever it stands.
* The edges of other paths also lie on paths of other words (or share a hash
  with other words by chance). They are counted once more, by the independent
  hash, and go one by one where they are found again.

Places themselves are never sent: near copies break a path wherever any of
them differs, so places grow with the square of a group, but distinct paths
with its texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm import arrays as A
from kinrank.llm import exchange as X
from kinrank.llm.common import pack, table, text_bytes

K = 35
WORD_BYTES = 6   # bytes of text for each window, about (sets the number of buckets)


def _edges(texts: pa.ChunkedArray, k: int):
    block = A.block_of(texts)
    starts, ends, off = block.words()
    words = A.spans_hash(block.data, starts, ends)
    at = A.window_starts(off, k)
    return block, starts, ends, off, words, at, A.windows_hash(words, at, k)


def _slices(docs: DataFrame, id_col: str, text_col: str, slice_bytes: int):
    src = pack(docs, id_col, text_col)
    total = text_bytes(src)
    return X.sliced(src, total, slice_bytes), max(1, -(-total // (WORD_BYTES * X.BUCKET_HASHES)))


class _Runs:
    """A slice's paths in place: its texts and words, and of each path the
    first word (``start``), the ``edges``, their multiplicity (``many``) and
    the independent hash of its words (``content``)."""

    def __init__(self, t: pa.Table, back: pa.Table, k: int):
        self.k = k
        self.block, self.starts, self.ends, self.off, _, at, h = _edges(t.column("text"), k)
        keys, place = np.unique(h, return_inverse=True)
        n = X.answers(back, len(keys))[place]
        some = n > 1
        at, n = at[some], n[some].astype(np.int64)
        doc = A.text_of(self.off, at)
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1]) | (n[1:] != n[:-1])
        first = np.flatnonzero(new)
        self.edges = np.diff(np.append(first, len(at)))
        self.start, self.many = at[first], n[first]
        self.words = A.spans_hash(self.block.data, self.starts, self.ends, 1) if len(first) else np.zeros(0, np.uint64)
        self.content = A.windows_hash(self.words, self.start, self.edges + k - 1, 1) if len(first) else self.words

    def decided(self, facts: pa.Table) -> np.ndarray:
        """Which paths are nonbranching, from the slice's joined paths."""
        name = facts.column("content").to_numpy()
        order = np.argsort(name, kind="stable")
        name, yes = name[order], facts.column("nonbranching").to_numpy(zero_copy_only=False).astype(bool)[order]
        mine = self.content.view(np.int64)
        if not len(mine):
            return np.zeros(0, bool)
        at = np.searchsorted(name, mine)
        if not len(name) or (name[np.minimum(at, len(name) - 1)] != mine).any():
            raise ValueError("a path of this slice is not among its joined paths")
        # paths of one content and other lengths (by chance) are all open
        last = np.searchsorted(name, mine, side="right")
        return yes[at] & (last - at == 1)

    def single(self, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first words, independent hashes) of the edges of open paths."""
        n = self.edges[open_]
        at = np.repeat(self.start[open_] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return at, A.windows_hash(self.words, at, self.k, 1) if len(at) else np.zeros(0, np.uint64)


def paths(sliced: DataFrame, buckets: int, k: int = K) -> tuple[DataFrame, DataFrame]:
    """Compacted repeated paths of each slice, and the counts of its edges.

    Paths: ``s, content`` (independent hash of the words), ``edges,
    multiplicity`` (of each edge), ``n`` (here), ``copies`` (in all slices),
    ``nonbranching``.
    """
    def build(t: pa.Table):
        _, _, _, _, _, _, h = _edges(t.column("text"), k)
        keys, n = np.unique(h, return_counts=True)
        return keys, [n]

    def here(t: pa.Table, back: pa.Table) -> pa.Table:
        if not t.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int32()), *[pa.array([], pa.int64())] * 4], names=names)
        r = _Runs(t, back, k)
        both = np.stack([r.content.view(np.int64), r.edges, r.many], axis=1)
        both, n = np.unique(both, axis=0, return_counts=True)
        return pa.Table.from_arrays([pa.array(np.full(len(n), t.column("s")[0].as_py()), pa.int32()),
                                     *(pa.array(x, pa.int64()) for x in (*both.T, n))], names=names)

    names = ["s", "content", "edges", "multiplicity", "n"]
    back = X.ask(sliced.groupBy("s"), buckets, build, [np.uint32], lambda keys, p: X.total_of_runs(keys, p[0]))
    # dealt once by path; a path has one row of each slice at most
    found = (sliced.groupBy("s").cogroup(back.groupBy("s"))
             .applyInArrow(here, "s int, content bigint, edges bigint, multiplicity bigint, n bigint")
             .repartition("content", "edges"))
    whole = found.groupBy("content", "edges").agg(F.sum("n").alias("copies"))
    return (found.join(whole, ["content", "edges"])
            .select("s", "content", "edges", "multiplicity", "n", "copies",
                    (F.col("copies") == F.col("multiplicity")).alias("nonbranching"))), back


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                    squash: bool = True, slice_bytes: int = X.SLICE_BYTES) -> DataFrame:
    """Remove every word covered by a window of ``k`` words whose words also
    start anywhere else (same document included).

    Returns ``id, rest, kept_text, n_words, n_removed``, one row per input
    row. With ``squash`` the kept words are joined by one space; else a text
    only loses its removed words and the white space after each.

    Defined cases: a null or empty text has no words; rows that share an id
    share a slice but are texts of their own; equal rows of ``k`` words or
    more repeat each other and lose these words in both; a null id is kept; an
    empty table gives an empty table. A text under ``k`` words stays. A very
    long text is one slice's and read whole there.
    """
    sliced, buckets = _slices(docs, id_col, text_col, slice_bytes)
    compact, back = paths(sliced, buckets, k)
    told = (back.withColumn("pass", F.lit(1)).unionByName(
        compact.select("s", "content", "nonbranching"), allowMissingColumns=True))

    def known(t: pa.Table, told: pa.Table) -> tuple[_Runs, np.ndarray]:
        runs = _Runs(t, told.filter(pc.equal(told.column("pass"), 1)), k)
        return runs, runs.decided(told.filter(told.column("content").is_valid()))

    def open_edges(t: pa.Table, told: pa.Table):
        if not t.num_rows:
            return np.zeros(0, np.uint64), [np.zeros(0, np.uint32)]
        runs, done = known(t, told)
        keys, n = np.unique(runs.single(~done)[1], return_counts=True)
        return keys, [n]

    # a bucket gets all edges at most
    again = X.ask(sliced.groupBy("s").cogroup(told.groupBy("s")), buckets, open_edges, [np.uint32],
                  lambda keys, p: X.total_of_runs(keys, p[0]), pair=True)
    told = told.unionByName(again.withColumn("pass", F.lit(2)), allowMissingColumns=True)

    def remove(t: pa.Table, told: pa.Table) -> pa.Table:
        if not t.num_rows:
            return t.select(["id", "rest", "text"]).rename_columns(["id", "rest", "kept_text"]).append_column(
                "n_words", pa.array([], pa.int64())).append_column("n_removed", pa.array([], pa.int64()))
        r, done = known(t, told)
        at, h = r.single(~done)
        keys, place = np.unique(h, return_inverse=True)
        at = at[X.answers(told.filter(pc.equal(told.column("pass"), 2)), len(keys))[place] > 1]
        start = np.concatenate([r.start[done], at])
        keep = ~A.covered(start, np.concatenate([r.start[done] + r.edges[done] + k - 1, at + k]), r.off[-1])
        text = (A.join_words if squash else A.cut_words)(r.block, r.starts, r.ends, r.off, keep)
        return pa.Table.from_arrays([t.column("id"), t.column("rest"), text, pa.array(np.diff(r.off), pa.int64()),
                                     pa.array(A.sums(~keep, r.off), pa.int64())],
                                    names=["id", "rest", "kept_text", "n_words", "n_removed"])

    kinds = dict(sliced.dtypes)
    return (sliced.groupBy("s").cogroup(told.groupBy("s"))
            .applyInArrow(remove, f"id {kinds['id']}, rest {kinds['rest']}, kept_text string, n_words bigint, "
                                  "n_removed bigint"))


def q_substring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs).select(
        F.col("rest.doc_id").alias("doc_id"), "n_words", "n_removed",
        F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 34], ' ')) AS h
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
last AS (SELECT w.doc_id, w.pos, w.word, a.i FROM words w ASOF LEFT JOIN again a
         ON w.doc_id = a.doc_id AND w.pos >= a.i),
kept AS (SELECT doc_id, pos, word, i IS NOT NULL AND pos - i < 35 AS gone FROM last),
agg AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
               string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS t FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN agg ON d.doc_id = agg.doc_id
"""
