"""A slice's hashes take little memory beside its texts, whatever the pieces."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from kinrank.llm import arrays as A
from kinrank.llm import debruijn, exchange


def _texts(n_bytes):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, n_bytes, dtype=np.uint8)
    data[rng.random(n_bytes) < 0.17] = 32
    return pa.chunked_array([A.string_array(data, np.linspace(0, n_bytes, 801).astype(np.int64))])


def test_a_slice_takes_few_times_its_bytes(monkeypatch):
    monkeypatch.setattr(A, "_powers", [{"n": 0}, {"n": 0}])  # a fresh worker's
    texts = _texts(exchange.SLICE_BYTES)
    tracemalloc.start()
    try:
        block, starts, ends, off, words, at, h = debruijn._edges(texts, 35)
        second = A.windows_hash(A.spans_hash(block.data, starts, ends, 1), at, 35, 1)
        A.cut_words(block, starts, ends, off, ~A.covered(at[::50], at[::50] + 35, off[-1]))
        _, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(h) == len(second) > 250_000
    assert most < 24 * exchange.SLICE_BYTES
    tables = sum(t[k].nbytes for t in A._powers for k in "pi")
    assert tables < 4 * exchange.SLICE_BYTES


@pytest.mark.parametrize("family", [0, 1])
def test_hashes_do_not_hang_on_the_pieces(monkeypatch, family):
    block = A.block_of(_texts(20_000))
    starts, ends, off = block.words()
    long = np.flatnonzero(np.diff(off) > 40)
    at = A.window_starts(off, 4)

    def hashes():
        words = A.spans_hash(block.data, starts, ends, family)
        back = np.arange(len(starts))[::-1]
        return [words, A.spans_hash(block.data, starts[back], ends[back], family)[back],
                A.spans_hash(block.data, block.off[:-1], block.off[1:], family),      # empty ones too
                A.spans_hash(block.data, block.off[:-1] * 0, block.off[1:], family),  # one in the other
                A.windows_hash(words, at, 4, family), A.windows_hash(words, off[long], np.diff(off)[long], family),
                A.windows_hash(words, at[:0], 4, family), A.spans_hash(block.data[:0], starts[:0], ends[:0], family)]

    whole = hashes()
    one = [A.spans_hash(block.data[s:e], np.array([0]), np.array([e - s]), family)[0]
           for s, e in zip(starts, ends, strict=True)]
    assert whole[0].tolist() == one
    for piece in (1, 37, 1000):
        monkeypatch.setattr(A, "PIECE", piece)
        monkeypatch.setattr(A, "_powers", [{"n": 0}, {"n": 0}])
        assert [x.tolist() for x in hashes()] == [x.tolist() for x in whole]
