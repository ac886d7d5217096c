"""Harmonic packing of token sequences.

With capacity C, a piece belongs to the reciprocal class j when its length is
C / j; a bin of class j holds exactly j pieces. Documents may be cut, so each
one is cut at the largest reciprocals that are powers of two: whole bins of C
first, then C/2, C/4, ... down to ``floor``; every bin of these classes is
full to the last token. What is left (under ``floor`` tokens) goes into the
last class, whose bins are filled by the next fit, cutting at the bin's end.
Each worker fills its own bins, class by class, so nothing is shuffled.

Where a worker's rows end, an open bin of c pieces of C/j is closed as bins of
a power of two of pieces each, so that its length is a power of two too; the
open bin of the last class is cut in the same way.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.common import pack, table

CAPACITY = 2048
FLOOR = 64
END = 1                  # id that closes each document
SEGMENT = 1 << 20        # characters of a long text that are encoded at a time
GAP = re.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
# The pre-token pattern that byte-level tokenizer files leave implied (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_OUT = ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Ids:
    """Ids of whole texts by a byte-level BPE file of the tokenizers library.

    The file's vocabulary and pattern are handed to tiktoken, which gives the
    same ids about five times faster (the tests hold one against the other).
    Texts with one of the file's special tokens are left to the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        merges = len(spec["model"]["vocab"]) - len(spec["model"]["merges"])
        byte = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        if sorted(ranks.values()) != list(range(len(ranks))) or merges != 256:
            raise ValueError(f"{path}: ids are not in the order of the merges")
        self.library = Tokenizer.from_file(path)
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        """The text's ids; a long text is cut before single spaces between
        letters or digits, where a pre-token always starts."""
        at, parts = 0, []
        while at < len(text) or not parts:
            end = len(text)
            if end - at > SEGMENT and (gap := GAP.search(text, at + SEGMENT)):
                end = gap.start()
            piece = text[at:end]
            if any(s in piece for s in self.special):
                ids = self.library.encode(piece, add_special_tokens=False).ids
            else:
                ids = self.fast.encode_ordinary(piece)
            parts.append(np.array(ids, dtype="<u4"))
            at = end
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def byte_letters() -> str:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return "".join(chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256))


class Packer:
    """One worker's bins. Pieces are (doc row, start, length, crc32, doc_tokens)."""

    def __init__(self, worker: int, capacity: int, floor: int):
        self.capacity, self.floor = capacity, floor
        self.next_id = worker << 40
        sizes, size = [], capacity
        while size >= floor:
            sizes.append(size)
            size //= 2
        self.open: dict[int, list] = {s: [] for s in sizes}
        self.tail: list = []
        self.tail_len = 0

    def sequence(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def close(self, pieces: list) -> Iterator[tuple]:
        seq, at = self.sequence(), 0
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids), zlib.crc32(ids.tobytes()), total, seq, at
            at += len(ids)

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        at, total = 0, len(ids)
        for size, bin_ in self.open.items():
            while total - at >= size:
                bin_.append((doc, at, ids[at:at + size], total))
                at += size
                if len(bin_) * size == self.capacity:
                    yield from self.close(bin_)
                    bin_.clear()
        while at < total:
            n = min(total - at, self.capacity - self.tail_len)
            self.tail.append((doc, at, ids[at:at + n], total))
            self.tail_len += n
            at += n
            if self.tail_len == self.capacity:
                yield from self.close(self.tail)
                self.tail, self.tail_len = [], 0

    def finish(self) -> Iterator[tuple]:
        for bin_ in self.open.values():
            rest = iter(bin_)
            for bit in reversed(range(len(bin_).bit_length())):
                if len(bin_) >> bit & 1:
                    yield from self.close(list(islice(rest, 1 << bit)))
        left, room = self.tail_len, 0
        bin_: list = []
        for doc, at, ids, total in self.tail:
            while len(ids):
                if not room:
                    room = 1 << (left.bit_length() - 1)
                    left -= room
                n = min(room, len(ids))
                bin_.append((doc, at, ids[:n], total))
                at, ids, room = at + n, ids[n:], room - n
                if not room:
                    yield from self.close(bin_)
                    bin_ = []


def _rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(cols[0], kind)] + [pa.array(c, pa.int64()) for c in cols[1:]],
                                      names=_OUT)


def harmonic_pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  capacity: int = CAPACITY, floor: int = FLOOR, end: int = END) -> DataFrame:
    """Cut and pack every text's ids (and ``end``) into sequences.

    Returns per piece: ``doc`` (the document's id), ``start, length,
    ids_crc32, doc_tokens, sequence_id, offset``. ``tokenizer_path`` must be
    readable on the workers. Defined cases: a null or empty text is the single
    id ``end``; a very long text fills whole sequences first; equal rows are
    packed each for itself; a null id is kept as null; an empty table gives
    none. A sequence id is the input partition's number times 2**40 plus a
    count, so a task that runs again gives the same rows.
    """
    if capacity & (capacity - 1) or floor & (floor - 1):
        raise ValueError("capacity and floor are powers of two")
    src = pack(docs, id_col, text_col).select(F.col("id").alias("doc"), "text")
    kind = dict(src.dtypes)["doc"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = None
        for batch in batches:
            if packer is None:
                ids_of, packer = _encoder(tokenizer_path), Packer(TaskContext.get().partitionId(), capacity, floor)
            kind_ = batch.schema.field("doc").type
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                rows = []
                for doc, text in zip(part.column("doc").to_pylist(), part.column("text"), strict=True):
                    rows.extend(packer.add(doc, np.append(ids_of(text.as_py()), np.uint32(end))))
                if rows:
                    yield _rows(rows, kind_)
        if packer is not None and (rows := list(packer.finish())):
            yield _rows(rows, kind_)

    return src.mapInArrow(work, f"doc {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                                "sequence_id bigint, offset bigint")


_loaded: dict[str, Ids] = {}


def _encoder(path: str) -> Ids:
    """One per Python worker: the vocabulary is read once."""
    if path not in _loaded:
        _loaded[path] = Ids(path)
    return _loaded[path]


def q_pack(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return harmonic_pack(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("doc", "doc_id")
