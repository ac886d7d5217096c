"""Mixing sources to target weights by cube-method balanced sampling.

A source's target is its share of all words by weight, at most ``MOST`` times
its own words. A document is taken ``floor(target / words)`` times for sure
and once more with what is left over as its inclusion probability. Which
documents these are is decided by the cube method: probabilities move along
directions that change neither the expected words nor the expected number of
documents of the source (the null space of these two constraints over three
documents at a time) until one of the three reaches 0 or 1.

The flight runs over blocks of a source's documents. A block ends with two
undecided documents at most; these meet in blocks of the next level, until
each source has one block. What is then left of a source, ``LANDING``
documents at most, is the landing: of all choices the one that comes nearest
to the source's target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.functions.ranking import dense_index
from kinrank.llm import arrays as A
from kinrank.llm.common import pack, table, written

WEIGHTS = (5, 2, 1)        # of the sources in order, repeating
MOST = 3                   # times a source's, or a document's, words
BLOCK = 8192               # documents of a block of the flight, about
BROADCAST_SOURCES = 100_000
SALTS = 64                 # copies of a source's row where its documents are many
SEED = 20
LANDING = 14               # documents of a source whose choices are all looked at
LARGE = 4                  # times the mean size: documents decided first
LARGE_TRIES = 50
NEAR = 1e-9                # a probability this near to 0 or 1 is decided


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``id, source, size, h, rest``: words of each whole text, and a hash of
    id and text that fixes the order of the flight."""
    packed = pack(docs, id_col, text_col).withColumn("h", F.xxhash64("id", "text"))
    packed = packed.withColumn("source", F.col(f"rest.`{source_col}`").cast("string"))
    kinds = dict(packed.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.diff(block.words()[2]) for _, _, block in A.blocks(batch)]
            at = batch.schema.names.index
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at(c)) for c in ("id", "source", "h", "rest")),
                 pa.array(np.concatenate(sizes) if sizes else [], pa.int64())],
                names=["id", "source", "h", "rest", "size"])
    return packed.mapInArrow(run, f"id {kinds['id']}, source string, h bigint, rest {kinds['rest']}, size bigint")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``number, source, n, source_size, target`` from ``source, n,
    source_size`` (one row a source). Sources by code point, null last, weigh
    ``weights`` in turn and share the sum of all sizes; a target stops at
    ``most`` times its source's size and the excess is shared again by weight.

    A source that is above its limit stays above it as others' excess comes
    back, so each round's limits are kept; a round is one aggregate of three
    numbers, and rounds end when no target is above its limit.
    """
    sources = written(sources, "source-sizes")
    index = dense_index(sources.filter(F.col("source").isNotNull()), "source", "number")
    after = sources.agg(F.count("*")).scalar()  # the null source is the last one
    numbered = sources.join(index, "source", "left").withColumn("number", F.coalesce("number", after))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), ((F.col("number") - 1) % len(weights)).cast("int"))
    state = written(numbered.withColumn("weight", weight.cast("bigint")), "sources")
    total = state.agg(F.sum("source_size")).first()[0] or 0
    limit, full, bar = F.col("source_size") * most, F.lit(False), 0.0
    while True:
        row = state.agg(F.sum(F.when(full, limit)).alias("kept"),
                        F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        share = float(total - (row["kept"] or 0)) / float(row["weight"] or 1)
        bar = max(bar, share)
        more = F.col("weight") * F.lit(bar) > limit
        if state.filter(more & ~full).isEmpty():
            break
        full = more
    target = F.when(full, limit.cast("double")).otherwise(F.col("weight") * F.lit(share))
    return state.select("number", "source", "n", "source_size", target.alias("target"))


def moved(p: np.ndarray, way: np.ndarray, draw: float) -> np.ndarray:
    """``p`` moved along ``way``, forwards or backwards as far as one of them
    reaches 0 or 1, at random so that each one's expected value stays."""
    up, down = way > 0, way < 0
    ahead = min(np.min((1 - p[up]) / way[up], initial=np.inf), np.min(p[down] / -way[down], initial=np.inf))
    back = min(np.min(p[up] / way[up], initial=np.inf), np.min((1 - p[down]) / -way[down], initial=np.inf))
    out = p + way * (ahead if draw * (ahead + back) < back else -back)
    return np.where((out > NEAR) & (out < 1 - NEAR), out, np.round(out))


def large_first(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Documents of many times the mean size decided, against all others.

    Among three documents a large one hardly moves, and it would be left for
    the landing. The direction is 1 for the large one and ``x + y * size`` for
    the others, so that again neither sum changes.
    """
    p = p.copy()
    for big in np.argsort(-size, kind="stable"):
        if size[big] <= LARGE * max(1.0, size.mean()):
            break
        for _ in range(LARGE_TRIES):
            rest = np.flatnonzero((p > NEAR) & (p < 1 - NEAR) & (size <= size[big]))
            rest = rest[rest != big]
            s = size[rest].astype(float)
            n, s1, s2 = len(rest), s.sum(), (s * s).sum()
            if not NEAR < p[big] < 1 - NEAR or n * s2 - s1 * s1 <= 0.5:
                break
            y = (s1 - n * size[big]) / (n * s2 - s1 * s1)
            way = np.zeros(len(p))
            way[rest], way[big] = (-1 - y * s1) / n + y * s, 1
            at = np.append(rest, big)
            p[at] = moved(p[at], way[at], rng.random())
    return p


def flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight: all but two at most are 0 or 1, and
    ``sum(p)`` and ``sum(p * size)`` are what they were.

    Of three undecided documents a, b, c the direction (b - c, c - a, a - b)
    in their sizes changes neither sum. It is taken forwards or backwards as
    far as one of them is decided, at random so that each document's expected
    probability stays (``moved``, written out for three).
    """
    out = large_first(size, p, rng).tolist() if len(p) else []
    sizes = size.tolist()
    draw = iter(rng.random(len(out) + 1).tolist())
    hold: list[int] = []
    for new in range(len(out)):
        if not NEAR < out[new] < 1 - NEAR:
            out[new] = float(round(out[new]))
            continue
        hold.append(new)
        if len(hold) < 3:
            continue
        a, b, c = (sizes[i] for i in hold)
        way = (b - c, c - a, a - b)
        if not any(way):
            way = (1, -1, 0)
        ahead = back = float("inf")
        for i, u in zip(hold, way, strict=True):
            if u > 0:
                ahead, back = min(ahead, (1 - out[i]) / u), min(back, out[i] / u)
            elif u < 0:
                ahead, back = min(ahead, out[i] / -u), min(back, (1 - out[i]) / -u)
        step = ahead if next(draw) * (ahead + back) < back else -back
        for i, u in zip(hold, way, strict=True):
            out[i] += step * u
            if not NEAR < out[i] < 1 - NEAR:
                out[i] = float(round(out[i]))
        hold = [i for i in hold if 0 < out[i] < 1]
    return np.array(out)


def landing(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The undecided ones (``LANDING`` at most) decided by looking at every
    choice: words nearest to their expectation, then documents, then the
    larger probabilities."""
    open_ = np.flatnonzero((p > NEAR) & (p < 1 - NEAR))
    choice = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    words = np.abs(choice @ size[open_].astype(float) - float(size[open_] @ p[open_]))
    some = np.abs(choice.sum(axis=1) - p[open_].sum())
    out = np.round(p)
    out[open_] = choice[np.lexsort((-(choice @ p[open_]), some, words))[0]]
    return out


def _level(rows: DataFrame, level: int, last: bool) -> DataFrame:
    """One flight over blocks ``number, block``; with ``last`` landed."""
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)

    def run(key, t):
        t = t.sort_by([("h", "ascending"), ("id", "ascending"), ("size", "ascending")])
        size = t.column("size").to_numpy().astype(np.int64)
        rng = np.random.default_rng([SEED, level, *(k.as_py() for k in key)])
        p = t.column("p").to_numpy()
        aside = LANDING - 2 if last else 0  # flight leaves two
        n = max(0, len(p) - aside)
        p = np.concatenate([flight(size[:n], p[:n], rng), p[n:]])
        if last:
            p = landing(size, p)
        return t.set_column(t.schema.names.index("p"), "p", pa.array(p, pa.float64()))
    return rows.groupBy("number", "block").applyInArrow(run, schema)


def balanced_sample(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows`` (``id, h, size, number, n, p`` and more) with ``p`` decided to
    0 or 1, balanced in words and documents for each ``number``; ``n`` counts
    its rows."""
    undecided = (F.col("p") > NEAR) & (F.col("p") < 1 - NEAR)
    done = rows.filter(~undecided).withColumn("p", F.round("p"))
    now, level = rows.filter(undecided), 0
    most = now.agg(F.max("n")).first()[0]
    parts = [done]
    while most is not None:
        # blocks of the level below leave two rows each
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(block))).cast("bigint")
        last = most <= block
        dealt = now.withColumn("block", F.pmod(F.xxhash64("h", F.lit(level)), blocks))
        flown = written(_level(dealt, level, last).drop("block"), "flight")
        parts.append(flown.filter("p = 0 or p = 1"))
        if last:
            break
        now = flown.filter("p > 0 and p < 1").withColumn("n", 2 * blocks)
        most, level = 2 * -(-most // block), level + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """``id, rest, source, size, source_size, target, copies``: how often the
    mix takes each document, one row per input row.

    Defined cases: a null or empty text has no words and is taken like others
    (for the balance of documents); a source without words has the target 0
    and its documents are not taken; a null source is a source of its own, the
    last one; repeated rows are drawn one by one; a null id is kept; an empty
    table gives an empty table. Texts are read whole; a very long one is one
    document like any other.
    """
    if most < 1:
        raise ValueError("targets must reach the sources' sizes")
    rows = written(measured(docs, id_col, text_col, source_col), "sizes")
    goal = targets(rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")),
                   weights, most)
    goal = written(goal, "targets")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.withColumn("share", F.least(share, F.lit(float(most)))).withColumn(
        "sure", F.floor(F.col("share") + NEAR).cast("bigint"))
    goal = goal.withColumn("p", F.greatest(F.col("share") - F.col("sure"), F.lit(0.0))).drop("share")
    goal = goal.withColumnRenamed("source", "of")
    same = F.col("source").eqNullSafe(F.col("of"))
    if goal.count() <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(goal), same).drop("of")
    else:  # the documents of large sources are dealt over copies of its row
        large = goal.filter(F.col("n") > block).select("of")  # at most 1 / block of all documents
        salt = F.pmod(F.col("h"), F.lit(SALTS)).cast("int")
        side = rows.join(large, same, "left_semi").withColumn("salt", salt).unionByName(
            rows.join(large, same, "left_anti").withColumn("salt", F.lit(0)))
        copies = F.sequence(F.lit(0), F.when(F.col("n") > block, SALTS - 1).otherwise(0))
        salted = goal.withColumn("copy", F.explode(copies))
        joined = side.join(salted, same & (F.col("salt") == F.col("copy"))).drop("of", "salt", "copy")
    drawn = balanced_sample(joined, block)
    return drawn.select("id", "rest", "source", "size", "source_size", "target",
                        (F.col("sure") + F.col("p").cast("bigint")).alias("copies"))


def q_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select(F.col("rest.doc_id").alias("doc_id"), "size", "source_size", "target",
                            (F.col("size") * F.col("copies")).alias("taken"))
