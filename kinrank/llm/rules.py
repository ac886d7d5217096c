"""Quality rules by host: each document is judged by base rules on its own
text; failures are added up by host, a host's failure rate is shrunk towards
all hosts by an empirical beta prior, and the host's verdict is joined back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm import arrays as A
from kinrank.llm.common import pack, table, written

MIN_WORDS = 50          # a document with fewer words fails
MAX_REPEAT_PERCENT = 50  # and one with more of its words in repeated 3-word windows
WINDOW = 3
HOST_MAX_RATE = 0.6     # hosts with a shrunk failure rate above are rejected

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _dup_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    seen, n = set(), 0
    for line in lines:
        if line in seen:
            n += bool(line.strip(b" \t\n\x0b\x0c\r"))
        else:
            seen.add(line)
    return n


def _measure(block: A.Block) -> list[np.ndarray]:
    starts, ends, off = block.words()
    chars = (block.data & 0xC0) != 0x80
    inked = A.sums(chars & ~A.SPACE[block.data], block.off)
    symbols = A.sums(_SYMBOL[block.data], block.off)
    dup = np.array([_dup_lines(block.text(i)) for i in range(block.n)], dtype=np.int64)
    words = A.spans_hash(block.data, starts, ends)
    at = A.window_starts(off, WINDOW)
    h = A.windows_hash(words, at, WINDOW) ^ A.mix(A.text_of(off, at).astype(np.uint64))
    _, inverse, n = np.unique(h, return_inverse=True, return_counts=True)
    again = at[n[inverse] > 1]
    covered = np.zeros(len(words), dtype=bool)
    for j in range(WINDOW):
        covered[again + j] = True
    return [np.diff(off), inked, symbols, dup, A.sums(covered, off)]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, block in A.blocks(batch):
            part = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("rest")]
                                             + [pa.array(c, pa.int64()) for c in _measure(block)],
                                             names=["id", "rest", *_COLUMNS])


def base_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures of each whole text and ``base_failed``; one row per input row."""
    src = pack(docs, id_col, text_col)
    kinds = dict(src.dtypes)
    schema = f"id {kinds['id']}, rest {kinds['rest']}, " + ", ".join(f"{c} bigint" for c in _COLUMNS)
    return (src.mapInArrow(_measured, schema)
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))


def host_verdicts(judged: DataFrame, host, max_rate: float = HOST_MAX_RATE) -> DataFrame:
    """``host, n, failed, rate, rejected`` per host (null is a host of its own).

    The prior is Beta(a, b) by moments over the hosts' own rates: mean m and
    variance v of the rates give s = m(1-m)/v - 1 and a = ms, b = (1-m)s; with
    no spread between hosts (v = 0) or s <= 0 the prior weighs one document. A
    host's rate is (failed + a) / (n + a + b).
    """
    hosts = judged.groupBy(host.alias("host")).agg(F.count("*").alias("n"),
                                                   F.sum(F.col("base_failed").cast("long")).alias("failed"))
    p = F.col("failed") / F.col("n")
    row = hosts.agg(F.avg(p).alias("m"), F.avg(p * p).alias("m2")).first()  # two numbers
    m = row["m"] or 0.0
    v = (row["m2"] or 0.0) - m * m
    s = m * (1 - m) / v - 1 if v > 1e-12 else 1.0
    if s <= 0:
        s = 1.0
    return (hosts.withColumn("rate", (F.col("failed") + F.lit(m * s)) / (F.col("n") + F.lit(s)))
            .withColumn("rejected", F.col("rate") > max_rate))


def host_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
               max_rate: float = HOST_MAX_RATE) -> DataFrame:
    """Base rules, then the verdict of each document's host.

    Returns ``id, rest``, the measures, ``base_failed, host_rate, kept``, one
    row per input row. Defined cases: a null or empty text has no words and
    fails; a null host is a host of its own; equal rows are judged alike, each
    counting for its host; an empty table gives an empty table.
    """
    judged = written(base_rules(docs, id_col, text_col), "rules")  # no texts: a few numbers a row
    host = F.col(f"rest.`{host_col}`")
    verdict = host_verdicts(judged, host, max_rate).select("host", F.col("rate").alias("host_rate"), "rejected")
    return (judged.join(verdict, host.eqNullSafe(F.col("host")), "left")
            .withColumn("kept", ~F.col("base_failed") & ~F.col("rejected"))
            .drop("host", "rejected"))


def q_host_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rate = F.floor(F.col("host_rate") * 1e6 + 0.5) / 1e6  # engines add floats in other orders
    return host_rules(docs).select(F.col("id").alias("doc_id"), *_COLUMNS, "base_failed", rate.alias("host_rate"), "kept")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w3 AS (
  SELECT doc_id, i, ws[i:i + 2] AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w3) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines
        FROM (SELECT doc_id, line, count(*) AS n FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
              GROUP BY doc_id, line) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN dup ON d.doc_id = dup.doc_id),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::BIGINT) AS failed FROM j GROUP BY source),
p AS (SELECT avg(failed / n) AS m, avg((failed / n) * (failed / n)) - avg(failed / n) * avg(failed / n) AS v FROM h),
s AS (SELECT m, CASE WHEN v > 1e-12 AND m * (1 - m) / v - 1 > 0 THEN m * (1 - m) / v - 1 ELSE 1.0 END AS s FROM p),
r AS (SELECT source, ((failed + m * s) / (n + s))::DOUBLE AS host_rate FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       floor(host_rate * 1e6 + 0.5) / 1e6 AS host_rate, NOT base_failed AND host_rate <= 0.6 AS kept
FROM j JOIN r ON j.source IS NOT DISTINCT FROM r.source
"""
