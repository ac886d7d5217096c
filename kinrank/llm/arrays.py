"""Texts of an Arrow batch as byte arrays: word and window hashes by NumPy.

Words are maximal runs of bytes other than ASCII white space, which never
occur inside a multi-byte UTF-8 character. All hashes are 64-bit sums of
random byte values times powers of an odd number, then mixed; a window's hash
is a difference of two running sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are handled in blocks of about so many bytes (one text at least).
BLOCK_BYTES = 2 << 20
#: Spans are summed over so many bytes or words at a time (a long span: more),
#: so that a worker's 64-bit numbers beside a block stay small.
PIECE = 1 << 17

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd: every power has an inverse modulo 2**64

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
# A second family of hashes, independent of the first one: where both agree,
# 128 bits agree.
_BASES = [_BASE, 0xC2B2AE3D27D4EB4F]
_BYTES = [_BYTE, np.random.default_rng(19).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)]
_powers = [{"n": 0}, {"n": 0}]


def powers(n: int, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    table = _powers[family]
    if table["n"] < n:
        m = max(n, PIECE + 1 if n <= PIECE + 1 else BLOCK_BYTES + 1)
        odd = _BASES[family]
        base, inv = np.full(m, odd, dtype=np.uint64), np.full(m, pow(odd, -1, 1 << 64), dtype=np.uint64)
        base[0] = inv[0] = 1
        kept = {"p": np.cumprod(base), "i": np.cumprod(inv), "n": m}
        if m > 4 * BLOCK_BYTES:  # a very long text's tables are not kept
            return kept["p"], kept["i"]
        table.update(kept)
    return table["p"], table["i"]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Block:
    """``n`` texts as one byte array: ``data`` and the offsets ``off`` (n + 1)."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off, self.n = data, off, len(off) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.off[i]:self.off[i + 1]].tobytes()

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last byte of each text that is not empty."""
        some = self.off[1:] > self.off[:-1]
        return self.off[:-1][some], self.off[1:][some] - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, offsets into them by text)."""
        ink = ~SPACE[self.data]
        first, last = self.edges()
        head, tail = ink.copy(), ink.copy()
        before, after = np.zeros_like(ink), np.zeros_like(ink)
        before[1:], after[:-1] = ink[:-1], ink[1:]
        before[first], after[last] = False, False
        head &= ~before
        tail &= ~after
        starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
        return starts, ends, np.searchsorted(starts, self.off)


def block_of(texts: pa.Array) -> Block:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if pa.types.is_string(texts.type):
        kind = np.int32
    else:
        kind = np.int64
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return Block(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offs, data = texts.buffers()
    off = np.frombuffer(offs, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return Block(raw, off - off[0])


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    """(first row, row after the last, texts) for slices of the batch."""
    whole = block_of(batch.column(batch.schema.names.index(column)))
    i = 0
    while i < whole.n:
        j = max(i + 1, int(np.searchsorted(whole.off, whole.off[i] + limit, side="right")) - 1)
        lo, hi = whole.off[i], whole.off[j]
        yield i, j, Block(whole.data[lo:hi], whole.off[i:j + 1] - lo)
        i = j


def _span_sums(items: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int,
               values: np.ndarray | None = None) -> np.ndarray:
    """Sum of the items (or of their ``values``) times powers over each span,
    as if it began at power 0. Spans in order of both ends go by pieces that
    a few spans share at least, others at once."""
    out = np.empty(len(starts), dtype=np.uint64)
    in_order = not (starts[1:] < starts[:-1]).any() and not (ends[1:] < ends[:-1]).any()
    limit = max(PIECE, 4 * int((ends - starts).max())) if len(starts) and in_order else len(items)
    i = 0
    while i < len(starts):
        lo = int(starts[i]) if in_order else 0
        j = max(i + 1, int(np.searchsorted(ends, lo + limit, side="right"))) if in_order else len(starts)
        hi = int(ends[j - 1]) if in_order else len(items)
        p, inv = powers(hi - lo + 1, family)
        part = items[lo:hi]
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((part if values is None else values[part]) * p[:hi - lo], out=total[1:])
        first = starts[i:j] - lo
        out[i:j] = (total[ends[i:j] - lo] - total[first]) * inv[first]
        i = j
    return out


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """Hash of each byte span, equal for equal bytes wherever they stand."""
    return mix(_span_sums(data, starts, ends, family, _BYTES[family]))


def windows_hash(items: np.ndarray, starts: np.ndarray, length: int | np.ndarray, family: int = 0) -> np.ndarray:
    """Hash of the ``length`` items from each start."""
    return mix(_span_sums(items, starts, starts + length, family) + _U(0x5851F42D4C957F2D))


def window_starts(word_off: np.ndarray, k: int) -> np.ndarray:
    """Indices of the words at which a window of ``k`` words of one text starts."""
    counts = np.diff(word_off)
    at = np.arange(word_off[-1] if len(word_off) else 0)
    return at[at + k <= np.repeat(word_off[1:], counts)]


def text_of(off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text that holds each index."""
    return np.searchsorted(off, at, side="right") - 1


def text_of_sorted(off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``text_of`` for ascending indices into the texts: a look for each text
    instead of one for each index."""
    return np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(at, off)))


def sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each text."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def string_array(data: np.ndarray, off: np.ndarray) -> pa.Array:
    """Bytes and offsets as an Arrow string array."""
    kind, make = (np.int32, pa.StringArray) if off[-1] < 1 << 31 else (np.int64, pa.LargeStringArray)
    return make.from_buffers(len(off) - 1, pa.py_buffer(off.astype(kind)), pa.py_buffer(np.ascontiguousarray(data)))


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Flags of the places inside any of the ranges."""
    # a running sum is as large as the ranges are many at most
    step = np.zeros(n + 1, dtype=np.int32 if len(starts) < 1 << 31 else np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:n], dtype=step.dtype, out=step[:n]) > 0


def keep_bytes(block: Block, keep: np.ndarray) -> pa.Array:
    """The texts with the flagged bytes alone."""
    total = np.zeros(len(keep) + 1, dtype=np.int32 if len(keep) < 1 << 31 else np.int64)
    np.cumsum(keep, out=total[1:])
    return string_array(block.data[keep], total[block.off])


def join_words(block: Block, starts: np.ndarray, ends: np.ndarray, off: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept words of each text joined by one space."""
    at = np.flatnonzero(keep)
    doc = text_of(off, at)
    later = np.concatenate([[False], doc[1:] == doc[:-1]]) if len(at) else np.zeros(0, bool)
    data = block.data.copy()
    # the byte before a later word of a text is white space
    data[starts[at[later]] - 1] = 32
    return keep_bytes(Block(data, block.off), covered(starts[at] - later, ends[at], len(data)))


def cut_words(block: Block, starts: np.ndarray, ends: np.ndarray, off: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The texts without the words that are not kept and the white space after
    each; all other bytes stay."""
    at = np.flatnonzero(~keep)
    doc = text_of(off, at)
    last = at + 1 == off[doc + 1]
    after = np.where(last, block.off[doc + 1], np.append(starts, 0)[at + 1])
    return keep_bytes(block, ~covered(starts[at], after, len(block.data)))
