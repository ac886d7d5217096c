"""Quality classifier: naive Bayes support vectors.

Indicators of a text's n-grams (bytes 1 to 4, words 1 to 2, hashed to ``DIMS``
places, and one place each for any word twice and three times in a
row) are scaled by the log-count ratio of the two classes; a
linear hinge-loss model on the scaled rows is fitted by dual coordinate
descent, and its margin is turned into a probability by a logistic fit on
rows kept aside.

The log-count ratios are counted over every labelled row that may be learned
from; the support vector machine is fitted on a bounded sample of them
(``SAMPLE`` rows, the first by a hash of the id, half from each class).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm import arrays as A
from kinrank.llm.common import hash_bounds, importable, pack, table, written
from kinrank.llm.langid import presence

DIMS = 1 << 16
GRAM_DIMS = DIMS // 2     # byte n-grams; the other half holds words and word pairs
SAME = (2, 3)             # any word so many times in a row: the places DIMS - 2 and DIMS - 3
SAMPLE = 4000             # rows that the support vector machine sees, at most
COST = 1.0
SMOOTHING = 1.0
EPOCHS = 30
BATCH = 64                # texts scored by one matrix product
THRESHOLD = 0.7


def indicators(block: A.Block) -> np.ndarray:
    """0/1 matrix (texts x DIMS)."""
    out = np.zeros((block.n, DIMS), dtype=np.uint8)
    out[:, :GRAM_DIMS] = presence(block, GRAM_DIMS, (1, 2, 3, 4))
    starts, ends, off = block.words()
    if len(starts):
        words = A.spans_hash(A.FOLD[block.data], starts, ends)
        width = np.uint64(DIMS - max(SAME) - GRAM_DIMS)
        for k in (1, 2):
            at = A.window_starts(off, k)
            h = A.windows_hash(words, at, k) % width
            out[A.text_of(off, at), GRAM_DIMS + h.astype(np.int64)] = 1
        for k in SAME:
            at = A.window_starts(off, k)
            for j in range(1, k):
                at = at[words[at] == words[at + j]]
            out[A.text_of(off, at), DIMS - k] = 1
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, A.Block]]:
    for batch in batches:
        for i, j, block in A.blocks(batch, limit=A.BLOCK_BYTES // 2):
            for r in range(0, j - i, BATCH):
                e = min(r + BATCH, j - i)
                lo, hi = block.off[r], block.off[e]
                some = A.Block(block.data[lo:hi], block.off[r:e + 1] - lo)
                yield batch.slice(i + r, e - r), indicators(some), some


@dataclass
class Model:
    weights: np.ndarray    # ratio x weight for each place
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float32)
        size = np.sqrt(x @ (self.ratios ** 2))
        return (x @ self.weights) / np.maximum(size, 1e-6) + self.bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * self.margins(x).astype(np.float64) + self.shift)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def log_count_ratios(positive: np.ndarray, negative: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    p, q = positive + smoothing, negative + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, dims: int,
                 epochs: int = EPOCHS) -> np.ndarray:
    """L1-loss support vector machine over sparse rows (places, values)."""
    w, alpha = np.zeros(dims), np.zeros(len(rows))
    norm = np.array([float(v @ v) for _, v in rows])
    rng = np.random.default_rng(3)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            gradient = y[i] * float(w[at] @ v) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                w[at] += step * y[i] * v
                alpha[i] = new
                most = max(most, abs(step))
        if most < 1e-4:
            break
    return w


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve (Newton steps, smoothed targets)."""
    n1, n0 = int((y > 0).sum()), int((y <= 0).sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = _logistic(a * margin + b)
        d, s = weight * (p - target), weight * p * (1 - p)
        g = np.array([(d * margin).sum() + 1e-6 * a, d.sum()])
        h = np.array([[(s * margin ** 2).sum() + 1e-6, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(places: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, share: float = 0.5) -> Model:
    """Fit the machine on rows of places (y: 1 or -1); every fifth row is kept
    aside for the logistic fit. In both the classes weigh as among all labelled
    rows (``share``: of class 1)."""
    def row(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = ratios[at]
        v = v / max(1e-6, float(np.sqrt(v @ v)))
        return np.append(at, DIMS), np.append(v, 1.0)  # the last place is the bias
    rows = [row(at) for at in places]
    aside = np.arange(len(rows)) % 5 == 4
    seen = np.flatnonzero(~aside) if aside.any() else np.arange(len(rows))
    ones = max(1, int((y[seen] > 0).sum()))
    each = {1: share / ones, -1: (1 - share) / max(1, len(seen) - ones)}  # classes weigh as among all rows
    cost = np.array([COST * len(seen) * each[y[i]] for i in seen])
    w = dual_descent([rows[i] for i in seen], y[seen], cost, DIMS + 1)
    held = np.flatnonzero(aside) if aside.any() else seen
    margin = np.array([float(w[rows[i][0]] @ rows[i][1]) for i in held])
    ones = np.maximum(1, (y[held] > 0).sum())
    weight = np.where(y[held] > 0, share / ones, (1 - share) / np.maximum(1, len(held) - ones)) * len(held)
    slope, shift = platt(margin, y[held], weight)
    return Model((w[:DIMS] * ratios).astype(np.float32), ratios.astype(np.float32), float(w[DIMS]), slope, shift)


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", rows: int = SAMPLE) -> Model | None:
    """Fit on the rows of ``labels`` with a label (1, or anything else as 0)
    and a text; None when a class has no row."""
    importable(docs.sparkSession)
    marks = labels.filter(F.col(label_col).isNotNull())
    if learn is not None:
        docs, marks = docs.filter(learn), marks.filter(learn)  # a condition on the id
    marks = marks.select(F.col(id_col).alias("id"), (F.col(label_col) == 1).cast("int").alias("y"))
    known = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(known) < 2:
        return None
    src = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
           .join(marks.hint("merge"), "id")  # the same plan whatever the labels' size
           .withColumn("o", F.xxhash64("id", "text")))
    src = src.withColumn("pick", F.col("o") <= hash_bounds(list(known.items()), "y", rows // 2))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One pass: rows of the sample with their places, and at the end the
        task's counts of each place."""
        n = np.zeros((2, DIMS), dtype=np.int64)
        for part, x, _ in _groups(batches):
            y = part.column("y").to_numpy()
            for c in (0, 1):
                n[c] += x[y == c].sum(0, dtype=np.int64)
            picked = np.flatnonzero(part.column("pick").to_numpy(zero_copy_only=False))
            if len(picked):
                some = part.take(pa.array(picked))
                yield rowed(len(picked), y=some.column("y"), o=some.column("o"),
                            places=pa.array([np.flatnonzero(x[i]).astype("<u2").tobytes() for i in picked],
                                            pa.binary()))
        some = np.flatnonzero(n.any(0))
        if len(some):
            yield rowed(len(some), place=pa.array(some), n0=pa.array(n[0, some]), n1=pa.array(n[1, some]))

    kinds = {"y": pa.int32(), "o": pa.int64(), "places": pa.binary(), "place": pa.int64(), "n0": pa.int64(),
             "n1": pa.int64()}

    def rowed(n: int, **cols: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([cols[c] if c in cols else pa.nulls(n, t) for c, t in kinds.items()],
                                          names=list(kinds))

    both = written(src.mapInArrow(gather, "y int, o bigint, places binary, place bigint, n0 bigint, n1 bigint"),
                   "quality")
    total = (both.filter("place is not null").groupBy("place")
             .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect())  # DIMS rows at most
    rank = F.row_number().over(Window.partitionBy("y").orderBy("o"))
    got = (both.filter("places is not null").select("y", "o", "places").dropDuplicates(["y", "o"])
           .withColumn("rank", rank).filter(F.col("rank") <= rows // 2).collect())  # a bounded sample
    got = sorted((r["o"], r["y"], bytes(r["places"])) for r in got)
    y = np.array([1 if r[1] else -1 for r in got])
    if not len(y) or y.min() == y.max():
        return None
    share = known[1] / (known[0] + known[1])
    n = np.zeros((2, DIMS))
    for r in total:
        n[0, r["place"]], n[1, r["place"]] = r["n0"], r["n1"]
    places = [np.frombuffer(r[2], "<u2").astype(np.int64) for r in got]
    order = np.random.default_rng(5).permutation(len(got))
    return fit([places[i] for i in order], y[order], log_count_ratios(n[1], n[0]), share)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, rest, score`` for each row.

    Defined cases: a null or empty text has no n-grams and gets the model's
    score of that; equal texts get equal scores; without a model (a class that
    was never seen) every score is 0.5; a null id is kept; an empty table
    gives an empty table.
    """
    src = pack(docs, id_col, text_col)
    kinds = dict(src.dtypes)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded: two numbers for each place

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x, _ in _groups(batches):
            s = sent.value.scores(x) if sent.value is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("rest"), pa.array(s)],
                                             names=["id", "rest", "score"])

    return src.mapInArrow(work, f"id {kinds['id']}, rest {kinds['rest']}, score double")


def q_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = train(docs.select("doc_id", "text"), labels, ~held_out)
    out = score(docs.select("doc_id", "text"), model).select(F.col("rest.doc_id").alias("doc_id"), "score")
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
