"""Language identification by string kernels.

Blended-spectrum presence kernel: a text is the set of its byte n-grams of
lengths 1 to 4 (A-Z folded, hashed to ``DIMS`` places); the kernel of two
texts is the number of n-grams that both have over the root of the product of
their numbers. The kernel is approximated from Nystroem landmarks and one
kernel ridge regression per language gives its score; texts are scored in
batches by matrix products.

The model is fitted on a bounded sample of labelled rows (``SAMPLE`` rows, the
first by a hash of the id, evenly over languages); every text is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.llm import arrays as A
from kinrank.llm.common import hashed_sample, importable, pack, table

SIZES = (1, 2, 3, 4)
DIMS = 1 << 14
SAMPLE = 3000           # labelled rows that the regression is fitted on, at most
LANDMARKS = 160
RIDGE = 1e-2
LANGUAGES = 1000        # more languages than this are refused
BATCH = 128             # texts scored by one matrix product
UNKNOWN = "und"

_MULT = [np.uint32(m) for m in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)]


def presence(block: A.Block, dims: int = DIMS, sizes: tuple[int, ...] = SIZES) -> np.ndarray:
    """0/1 matrix (texts x dims) of the n-grams that each text has."""
    out = np.zeros((block.n, dims), dtype=np.uint8)
    flat = out.ravel()
    shift = np.uint32(32 - (dims.bit_length() - 1))
    data = A.FOLD[block.data].astype(np.uint32) + np.uint32(1)
    row = np.repeat(np.arange(block.n, dtype=np.int64) * dims, np.diff(block.off))
    left = np.repeat(block.off[1:], np.diff(block.off)) - np.arange(len(data))  # bytes of the text from here on
    h = np.zeros(len(data), dtype=np.uint32)
    for n in range(1, max(sizes) + 1):
        m = len(data) - n + 1
        if m <= 0:
            break
        h = (h[:m] ^ data[n - 1:]) * _MULT[n - 1]
        h ^= h >> np.uint32(15)
        if n in sizes:
            at = row[:m] + ((h * _MULT[0]) >> shift)
            flat[at[left[:m] >= n]] = 1
    return out


def _has_letter(text: bytes) -> bool:
    """Whether any character is a letter (Unicode)."""
    for i in range(0, len(text), 4096):
        part = text[i:i + 4096].decode("utf-8", "ignore")
        if any(c.isalpha() for c in part):
            return True
    return len(text) > 4096 and any(c.isalpha() for c in text.decode("utf-8", "ignore"))


@dataclass
class Model:
    """Landmarks (packed bits), the weights of each language and its name."""

    bits: np.ndarray      # landmarks x dims/8
    weights: np.ndarray   # landmarks x languages
    names: list[str]

    def prepare(self) -> Model:
        self.marks = np.unpackbits(self.bits, axis=1).astype(np.float32)
        self.marks /= np.sqrt(np.maximum(1.0, self.marks.sum(1, keepdims=True)))
        return self

    def scores(self, grams: np.ndarray) -> np.ndarray:
        x = grams.astype(np.float32)
        k = x @ self.marks.T
        k /= np.sqrt(np.maximum(1.0, x.sum(1, keepdims=True)))
        return k @ self.weights


def fit(rows: list[tuple[bytes, str]], dims: int = DIMS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on (packed presence bits, language) rows."""
    names = sorted({lang for _, lang in rows})
    bits = np.frombuffer(b"".join(b for b, _ in rows), np.uint8).reshape(len(rows), dims // 8)
    y = np.array([names.index(lang) for _, lang in rows])
    order = np.concatenate([np.flatnonzero(y == c)[: -(-landmarks // len(names))] for c in range(len(names))])
    model = Model(bits[order], np.eye(len(order), dtype=np.float32), names).prepare()
    k = np.concatenate([model.scores(np.unpackbits(bits[i:i + 256], axis=1)) for i in range(0, len(rows), 256)])
    k = k.astype(np.float64)
    value, vector = np.linalg.eigh((k[order] + k[order].T) / 2)
    some = value > 1e-6 * value.max()
    root = vector[:, some] / np.sqrt(value[some])              # Nystroem: K_mm to the power -1/2
    phi = k @ root
    target = (y[:, None] == np.arange(len(names))).astype(np.float64)
    weight = 1 / np.maximum(1, target.sum(0))[y]               # languages weigh alike
    gram = phi.T @ (phi * weight[:, None]) + ridge * np.eye(phi.shape[1])
    w = np.linalg.solve(gram, phi.T @ (target * weight[:, None]))
    return Model(bits[order], (root @ w).astype(np.float32), names)


def train(docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", rows: int = SAMPLE) -> Model | None:
    """Fit on rows with a language, a letter in their text and ``learn`` true;
    None when there is no such row."""
    importable(docs.sparkSession)
    src = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike("\\p{L}"))
    if learn is not None:
        src = src.filter(learn)
    src = src.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, block in A.blocks(batch, limit=A.BLOCK_BYTES // 2):
                some = [np.packbits(presence(A.Block(block.data[block.off[r]:block.off[r + 1]],
                                                     np.array([0, block.off[r + 1] - block.off[r]])))).tobytes()
                        for r in range(j - i)]
                yield pa.RecordBatch.from_arrays([batch.slice(i, j - i).column("lang"), pa.array(some, pa.binary())],
                                                 names=["lang", "bits"])

    n = max(1, src.select("lang").distinct().limit(LANGUAGES + 1).count())
    some = hashed_sample(src, "lang", ["id", "text"], -(-rows // n), LANGUAGES).select("lang", "text")
    got = some.mapInArrow(bits, "lang string, bits binary").collect()  # bounded: rows x dims / 8
    found = sorted((bytes(r["bits"]), r["lang"]) for r in got)
    found = [found[i] for i in np.random.default_rng(11).permutation(len(found))]
    return fit(found) if found else None


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, rest, lang_pred, score`` for each row.

    Defined cases: a null text, or one without a letter, is ``und`` with score
    0, and so is every text when nothing could be learned; equal texts get
    equal answers; ties go to the first language by name; a null id is kept;
    an empty table gives an empty table.
    """
    src = pack(docs, id_col, text_col)
    kinds = dict(src.dtypes)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded: landmarks x (dims / 8 + languages)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sent.value
        if found is not None:
            found.prepare()
        for batch in batches:
            for i, j, block in A.blocks(batch, limit=A.BLOCK_BYTES // 2):
                names, score = [UNKNOWN] * (j - i), np.zeros(j - i)
                if found is not None:
                    for r in range(0, j - i, BATCH):
                        lo, hi = block.off[r], block.off[min(r + BATCH, j - i)]
                        some = A.Block(block.data[lo:hi], block.off[r:min(r + BATCH, j - i) + 1] - lo)
                        s = found.scores(presence(some))
                        for t, (c, v) in enumerate(zip(s.argmax(1), s.max(1), strict=True)):
                            if _has_letter(some.text(t)):
                                names[r + t], score[r + t] = found.names[c], min(1.0, max(0.0, float(v)))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("rest"), pa.array(names), pa.array(score)],
                    names=["id", "rest", "lang_pred", "score"])

    return src.mapInArrow(work, f"id {kinds['id']}, rest {kinds['rest']}, lang_pred string, score double")


def q_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = train(docs, ~held_out)
    out = identify(docs.select("doc_id", "text"), model)
    return out.select(F.col("rest.doc_id").alias("doc_id"), "lang_pred", "score").withColumn(
        "held_out", F.coalesce(held_out, F.lit(False))).select("doc_id", "held_out", "lang_pred", "score")
