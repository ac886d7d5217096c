"""Counting hashes of all documents in few bytes.

Documents are dealt into slices of bounded size by a hash. Each slice sends
the sorted distinct hashes of its texts, packed, to buckets by ranges of hash;
a bucket meets all slices' hashes in its range and answers each slice with
one small number per hash, in the order in which the hashes came. A hash that
stands in every document is sent once per slice, so no bucket grows with a
popular hash, and neither documents nor hashes travel back.

A slice's function is pure, so a slice that is computed again (to use the
answers, or after a lost executor) builds the same hashes in the same order.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20     # text of a slice, about
BUCKET_HASHES = 1 << 20   # hashes that meet in a bucket, about

_U = np.uint64
# contexts are kept: at many slices and buckets the frames are small, and a new
# context for each would cost more than its bytes
_pack, _unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def sliced(packed: DataFrame, total_bytes: int, slice_bytes: int = SLICE_BYTES,
           by: tuple[str, ...] = ("id", "text")) -> DataFrame:
    """``packed`` with the slice number ``s``; rows with equal ``by`` share a
    slice. With the text among them, null or repeated ids make no large one."""
    n = max(1, -(-total_bytes // slice_bytes))
    return packed.withColumn("s", F.pmod(F.xxhash64(*by), F.lit(n)).cast("int"))


def squeeze(a: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T
    return _pack.compress(np.ascontiguousarray(planes))


def unsqueeze(b: bytes, dtype) -> np.ndarray:
    kind = np.dtype(dtype)
    raw = np.frombuffer(_unpack.decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def squeeze_sorted(a: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as compressed differences."""
    return squeeze(np.concatenate([a[:1], a[1:] - a[:-1]]))


def unsqueeze_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(b, _U), dtype=_U)


def cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range of the sorted keys begins (buckets + 1)."""
    edge = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=_U)
    return np.concatenate([[0], np.searchsorted(keys, edge), [len(keys)]]).astype(np.int64)


def ask(groups, buckets: int, build: Callable, payload: list, answer: Callable,
        pair: bool = False, checked: bool = False) -> DataFrame:
    """Answers for the hashes of every slice: ``s, bucket, answer``.

    ``groups`` is a grouping by ``s``, or with ``pair`` a co-grouping of two
    frames; ``build(*tables)`` gives the sorted
    distinct uint64 hashes and the arrays of ``payload`` types beside them;
    ``answer(keys, payloads)`` gets a bucket's hashes in order (equal ones
    together, by slice) with their payloads and gives a uint32 for each.

    With ``checked`` the first payload is a second hash (uint32), and hashes are
    equal where both are: a slice's pairs are distinct (``distinct``), and
    ``answer`` gets numbers of the equal pairs as keys, without that payload;
    equal ones come together, in no order among them.
    """
    names = [f"p{i}" for i in range(len(payload))]

    def send(key, *tables) -> pa.Table:
        keys, extra = build(*tables)
        cut = cuts(keys, buckets)
        rows = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if hi > lo]
        cols = [pa.array([key[0].as_py()] * len(rows), pa.int32()), pa.array([b for b, _, _ in rows], pa.int32()),
                pa.array([squeeze_sorted(keys[lo:hi]) for _, lo, hi in rows], pa.binary())]
        cols += [pa.array([squeeze(x.astype(t)[lo:hi]) for _, lo, hi in rows], pa.binary())
                 for x, t in zip(extra, payload, strict=True)]
        return pa.Table.from_arrays(cols, names=["s", "bucket", "keys", *names])

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("s")  # the answer must not hang on the order of arrival
        some = [unsqueeze_sorted(b) for b in table.column("keys").to_pylist()]
        sizes = [len(k) for k in some]
        keys = np.concatenate(some)
        del some  # a bucket's hashes are held as few times as can be
        extra = [np.concatenate([unsqueeze(b, t) for b in table.column(n).to_pylist()])
                 for n, t in zip(names, payload, strict=True)]
        if checked:
            order, new = _pairs_in_order(keys, extra[0])
            got = answer(np.cumsum(new), [x[order] for x in extra[1:]])
        else:
            order = np.argsort(keys, kind="stable")
            keys, extra = keys[order], [x[order] for x in extra]
            got = answer(keys, extra)
        out = np.empty(len(keys), dtype=np.uint32)
        out[order] = got
        ends = np.cumsum(sizes)
        return pa.Table.from_arrays(
            [table.column("s"), table.column("bucket"),
             pa.array([squeeze(out[e - n:e]) for e, n in zip(ends, sizes, strict=True)], pa.binary())],
            names=["s", "bucket", "answer"])

    kind = "s int, bucket int, keys binary" + "".join(f", {n} binary" for n in names)
    sent = groups.applyInArrow((lambda key, t, u: send(key, t, u)) if pair else (lambda key, t: send(key, t)), kind)
    return sent.groupBy("bucket").applyInArrow(meet, "s int, bucket int, answer binary")


def _pairs_in_order(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the pairs, equal ones in no order among them, and flags of
    the first of each."""
    order = np.argsort(keys)  # by far faster than a stable one

    def changes(x):
        x = x[order]
        return np.concatenate([np.ones(min(len(x), 1), dtype=bool), x[1:] != x[:-1]])
    other, differ = changes(keys), changes(checks)
    if (differ & ~other).any():  # one hash of several contents: by chance
        order = np.lexsort((checks, keys))
        other, differ = changes(keys), changes(checks)
    return order, other | differ


def distinct(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs in order: keys, checks, the first place of each pair, the
    pair at each place, number of places."""
    order, new = _pairs_in_order(keys, checks)
    at = np.flatnonzero(new)
    of = np.empty(len(keys), dtype=np.int64)
    of[order] = np.cumsum(new) - 1
    first = np.minimum.reduceat(order, at) if len(at) else order
    return keys[first], checks[first], first, of, np.diff(np.append(at, len(keys)))


def ordered(table: pa.Table) -> pa.Table:
    """A slice's documents in an order that does not hang on their arrival."""
    return table.take(pc.sort_indices(table, sort_keys=[("id", "ascending"), ("text", "ascending")]))


def answers(table: pa.Table, n: int) -> np.ndarray:
    """A slice's answers in the order of its hashes."""
    table = table.sort_by("bucket")
    parts = [unsqueeze(b, np.uint32) for b in table.column("answer").to_pylist()]
    out = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    if len(out) != n:
        raise ValueError(f"{len(out)} answers for {n} hashes")
    return out


def run_starts(keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal sorted keys."""
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def total_of_runs(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each run of equal keys, given to every member."""
    at = run_starts(keys)
    sums = np.add.reduceat(values.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    return np.minimum(np.repeat(sums, np.diff(np.append(at, len(keys)))), (1 << 32) - 1).astype(np.uint32)
