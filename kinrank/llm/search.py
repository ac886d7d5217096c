"""Ranked lexical search by NRA: sorted access only, no random access.

The documents are the index's shards. Each task turns its rows' postings
into one list per query term, sorted by impact, and reads the lists of an
item side by side in growing steps. What has been read of a document is its
lower bound; with each unread list's next impact added it is the upper bound.
Documents whose upper bound falls under the k-th lower bound leave; reading
goes on until every document that is left has one score, so that membership,
ties and scores are final. A task carries its k best of each item from shard
to shard, and a window over the tasks' few rows ranks them.

Items come in blocks of bounded bytes, so the terms, weights and queries that
travel with the tasks are bounded whatever the number of items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm import arrays as A
from kinrank.llm.common import pack, table, text_bytes, written

TOP = 20
QUERY_BYTES = 1 << 20    # item texts of one block, about
SHARD_ROWS = 8192        # documents whose lists are read together
CELLS = 1 << 26          # lists x documents of a shard, at most about
STEP = 256               # postings of each list in the first read
# Fixed values of the scoring formula.
WEIGHT_SCALE, TF_SCALE, TF_UNIT, SATURATION, FLAT, BY_LENGTH = 1000, 1_000_000_000, 1000, 12, 75, 25

TERM = np.zeros(256, dtype=bool)
TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def term_spans(block: A.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, offsets by text) of the maximal runs of ASCII letters,
    ASCII digits and characters beyond ASCII."""
    ink = TERM[block.data]
    first, last = block.edges()
    before, after = np.zeros_like(ink), np.zeros_like(ink)
    before[1:], after[:-1] = ink[:-1], ink[1:]
    before[first], after[last] = False, False
    starts, ends = np.flatnonzero(ink & ~before), np.flatnonzero(ink & ~after) + 1
    return starts, ends, np.searchsorted(starts, block.off)


class Vocabulary:
    """The terms of a block of items: sorted hashes, and the bytes that prove
    a match."""

    def __init__(self, terms: list[bytes]):
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
        hashes = A.spans_hash(data, ends - [len(t) for t in terms], ends) if terms else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.terms = [terms[i] for i in order]
        self.hashes = hashes[order]
        if len(np.unique(hashes)) != len(terms):
            raise ValueError("two terms with one hash")
        self.size = np.array([len(t) for t in self.terms], dtype=np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.data = np.frombuffer(b"".join(self.terms), np.uint8)
        self.kind = np.dtype(np.uint16 if len(terms) < 1 << 16 else np.uint32)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which spans are terms, their numbers), compared byte by byte."""
        if not len(self.hashes) or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = A.spans_hash(data, starts, ends)
        v = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = np.flatnonzero((self.hashes[v] == h) & (self.size[v] == ends - starts))
        v = v[hit]
        if not len(hit):
            return hit, v
        size = self.size[v]
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        other = data[np.repeat(starts[hit], size) + step] != self.data[np.repeat(self.at[v], size) + step]
        same = np.add.reduceat(other.astype(np.int64), np.cumsum(size) - size) == 0
        return hit[same], v[same]


def postings(packed: DataFrame, words: Vocabulary) -> DataFrame:
    """``id, n, terms, tfs`` for each document: its length in terms, and the
    numbers of the vocabulary's terms in it with their occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.names.index("id"))
            for i, j, block in A.blocks(batch):
                data = A.FOLD[block.data]
                starts, ends, off = term_spans(block)
                hit, v = words.find(data, starts, ends)
                key, tf = np.unique(A.text_of(off, hit) * max(1, len(words.terms)) + v, return_counts=True)
                doc, v = np.divmod(key, max(1, len(words.terms)))
                cut = np.searchsorted(doc, np.arange(block.n + 1))

                def packed_numbers(x: np.ndarray, cut=cut) -> pa.Array:
                    return pa.BinaryArray.from_buffers(
                        pa.binary(), len(cut) - 1,
                        [None, pa.py_buffer((cut * x.dtype.itemsize).astype(np.int32)),
                         pa.py_buffer(np.ascontiguousarray(x))])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(np.diff(off), pa.int64()),
                     packed_numbers(v.astype(words.kind)), packed_numbers(tf.astype(np.uint32))],
                    names=["id", "n", "terms", "tfs"])
    return packed.select("id", "text").mapInArrow(
        run, f"id {dict(packed.dtypes)['id']}, n bigint, terms binary, tfs binary")


def _numbers(col: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of packed rows, where each row's begin)."""
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int32 if pa.types.is_binary(col.type) else np.int64)
    off = off[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = data.to_pybytes()[off[0]:off[-1]] if data is not None else b""
    return np.frombuffer(raw, kind), (off - off[0]) // kind.itemsize


def document_frequencies(kept: DataFrame, words: Vocabulary) -> np.ndarray:
    """In how many documents each term of the vocabulary stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words.terms), np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0), words.kind)[0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())],
                                         names=["term", "df"])
    counted = kept.select("terms").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(len(words.terms), np.int64)
    for r in counted.collect():  # the terms of one block of items
        out[r["term"]] = r["df"]
    return out


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n: int, k: int, least: int = 1,
        step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of all documents that can be among the ``k`` best
    of ``0..n-1`` with a score of ``least`` or more, each with its full score.

    ``lists``: (documents, impacts) by descending impact, a document once a
    list. Read in order, in steps that double.
    """
    lower = np.zeros(n, np.int64)
    unseen = np.ones((len(lists), n), dtype=bool)
    front = np.array([x[0] if len(x) else 0 for _, x in lists], np.int64)
    at, left = 0, np.arange(n)
    while True:
        for i, (docs, impact) in enumerate(lists):
            if at < len(docs):
                got = docs[at:at + step]
                lower[got] += impact[at:at + step]
                unseen[i, got] = False
                front[i] = impact[at + step] if at + step < len(impact) else 0
        at += step
        step *= 2
        live = np.flatnonzero(front)
        low = lower[left]
        high = low + (front[live] @ unseen[np.ix_(live, left)] if len(live) else 0)
        bar = max(least, int(np.partition(low, -k)[-k])) if len(low) >= k else least
        # both bounds only close in: who is out now stays out
        stays = high >= bar
        left, low, high = left[stays], low[stays], high[stays]
        if (low == high).all():
            return left, low


class Best:
    """The best ``k`` of each item so far: (score, document), ties to the
    smaller document, unknown ids last."""

    def __init__(self, items: int, k: int):
        self.rows: list[list[tuple]] = [[] for _ in range(items)]
        self.k = k

    def least(self, q: int) -> int:
        return -self.rows[q][-1][0] if len(self.rows[q]) == self.k else 1

    def add(self, q: int, ids: list, scores: np.ndarray) -> None:
        more = [(-int(s), i is None, i if i is not None else 0) for i, s in zip(ids, scores, strict=True)]
        self.rows[q] = sorted(self.rows[q] + more)[:self.k]


def _shards(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _searched(kept: DataFrame, words: Vocabulary, queries: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray,
              documents: int, terms: int, k: int, rows: int) -> DataFrame:
    """``q, id, score``: each task's ``k`` best documents of every query."""
    longest = max(len(t) for t, _ in queries)
    rows = max(1, min(rows, CELLS // max(1, longest)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kind = Best(len(queries), k), pa.int64()
        for shard in _shards(batches, rows):
            kind = shard.column(0).type
            shard = shard.take(pc.sort_indices(shard.column(0)))  # by id: the order of ties
            ids = shard.column(0)
            term, off = _numbers(shard.column(2), words.kind)
            tf = _numbers(shard.column(3), np.dtype(np.uint32))[0].astype(np.int64)
            n = shard.column(1).to_numpy()
            long = FLAT + BY_LENGTH * n * documents // terms
            doc = np.repeat(np.arange(len(n)), np.diff(off))
            impact = weight[term] * (TF_SCALE * tf // (TF_UNIT * tf + SATURATION * long[doc]))
            order = np.lexsort((-impact, term))
            term, doc, impact = term[order], doc[order], impact[order]
            begin = np.searchsorted(term, np.arange(len(words.terms) + 1))
            for q, (ts, times) in enumerate(queries):
                lists = [(doc[begin[t]:begin[t + 1]], impact[begin[t]:begin[t + 1]] * x)
                         for t, x in zip(ts, times, strict=True) if begin[t] < begin[t + 1]]
                if lists:
                    found, score = nra(lists, len(n), k, best.least(q))
                    top = np.lexsort((found, -score))[:k]
                    best.add(q, [ids[int(i)].as_py() for i in found[top]], score[top])
        flat = [(q, None if null else i, -s) for q, x in enumerate(best.rows) for s, null, i in x]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in flat], pa.int32()), pa.array([r[1] for r in flat], kind),
             pa.array([r[2] for r in flat], pa.int64())], names=["q", "id", "score"])
    return kept.select("id", "n", "terms", "tfs").mapInArrow(run, f"q int, id {dict(kept.dtypes)['id']}, score bigint")


def _split(text: str | None) -> list[bytes]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    block = A.Block(A.FOLD[raw], np.array([0, len(raw)]))
    starts, ends, _ = term_spans(block)
    return [block.data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", query_bytes: int = QUERY_BYTES,
           shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``item, rank, id, score``: the ``k`` best documents of each item with a
    score above 0, equal scores by ascending id (unknown ids last).

    Defined cases: a null or empty text, or one without terms, is no document
    of the collection and answers nothing; such an item has no rows. Repeated
    documents are ranked one by one; items equal in id and text are one item.
    Empty tables give an empty table. Texts are read whole; a long text's
    postings are at most the terms of one block of items.
    """
    src = pack(docs, id_col, text_col).select("id", "text")
    asked = pack(items, item_col, item_text).select("id", "text").distinct()
    blocks = max(1, -(-text_bytes(asked) // query_bytes))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    out = None
    for b in range(blocks):
        found = _block(src, asked.filter(F.col("block") == b).collect(), dict(asked.dtypes)["id"], k, shard_rows)
        out = found if out is None else out.unionByName(found)
    return out


def _block(src: DataFrame, rows: list, item_type: str, k: int, shard_rows: int) -> DataFrame:
    spark = src.sparkSession
    rows = [(r["id"], Counter(_split(r["text"]))) for r in rows]
    rows = [r for r in rows if r[1]]
    words = Vocabulary(sorted({t for _, c in rows for t in c}))
    number = {t: i for i, t in enumerate(words.terms)}
    queries = [(np.array([number[t] for t in c]), np.array(list(c.values()), np.int64)) for _, c in rows]
    nothing = spark.createDataFrame([], f"item {item_type}, rank int, id {dict(src.dtypes)['id']}, score bigint")
    if not rows:
        return nothing
    kept = written(postings(src, words), "postings")
    total = kept.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    if not total["documents"]:
        return nothing
    weight = weights(document_frequencies(kept, words), total["documents"])
    found = _searched(kept, words, queries, weight, total["documents"], total["terms"], k, shard_rows)
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(q, r[0]) for q, r in enumerate(rows)], f"q int, item {item_type}")
    return ranked.join(F.broadcast(names), "q").select("item", "rank", "id", "score")  # one block's items


def q_search(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, table(spark, sf_dir, "benchmark")).select(
        F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


SQL = r"""
WITH raw AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
  WHERE text IS NOT NULL),
d AS (SELECT row_number() OVER () AS k, doc_id, ts, len(ts)::BIGINT AS n FROM raw WHERE len(ts) > 0),
tot AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d),
p AS (SELECT k, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, count(*)::BIGINT AS tf
      FROM (SELECT k, unnest(ts) AS t FROM d) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM p, tot GROUP BY t, docs),
m AS (SELECT k, doc_id, 100 - 25 + ((25 * n * docs) // terms) AS m FROM d, tot),
i AS (SELECT DISTINCT item_id, text FROM benchmark),
q AS (SELECT item_id, text, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t,
             count(*)::BIGINT AS times
      FROM (SELECT item_id, text, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM i)
      GROUP BY ALL),
s AS (SELECT q.item_id, q.text, m.k, m.doc_id, sum(q.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * m.m))) AS score
      FROM q JOIN w ON w.t = q.t JOIN p ON p.t = q.t JOIN m ON m.k = p.k GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM r WHERE rank <= 20
"""
