"""Line deduplication [native]: DataFrame functions only.

Lines are exploded with their position, normalised and hashed; hashes found in
many documents are counted; their lines are dropped and the rest of each
document is put together again by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.common import ASCII_SPACE, fold_ascii, pack

SALTS = 16   # copies of a dropped key that its lines are dealt over


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Drop every line whose key is found in at least ``min_docs`` documents.

    A line's key is the line with ASCII white space stripped at both ends and
    A-Z lower-cased; keys shorter than ``min_chars`` code points never count.
    Returns ``id, rest, kept_text, n_lines, n_dropped`` (``rest``: the input's
    other columns as a struct, so names cannot clash), one row per input row.

    Defined cases: a null or empty text is one empty line and stays; rows that
    share an id are one document for the count, of those without an id the rows
    that share a text; equal rows give equal rows; an empty table gives an empty table; a text
    that loses every line becomes the empty text. Keys are compared by a
    96-bit hash. A hot line is counted from partial aggregates, and its lines
    meet the dropped keys in ``SALTS`` parts.
    """
    src = pack(docs, id_col, text_col).withColumn("k", F.xxhash64("id", "text"))
    split = F.split(F.col("text"), "\n", -1)
    lines = (src.select("k", "id", F.posexplode(split).alias("pos", "line"))
             .select("k", "id", "pos", fold_ascii(F.trim("line", F.lit(ASCII_SPACE))).alias("key"))
             .filter(F.length("key") >= min_chars)
             .select("k", "id", "pos", F.xxhash64("key").alias("h"), F.hash("key").alias("g")))
    # without an id a text is a document of its own
    document = F.struct("id", F.when(F.col("id").isNull(), F.col("k")))
    frequent = (lines.groupBy("h", "g").agg(F.count_distinct(document).alias("n"))
                .filter(F.col("n") >= min_docs).select("h", "g"))
    # a hot line's rows are dealt over SALTS copies of its key
    frequent = frequent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dropped = (lines.withColumn("salt", F.pmod("k", F.lit(SALTS)).cast("int"))
               .join(frequent, ["h", "g", "salt"], "left_semi")
               .groupBy("k", "id").agg(F.collect_set("pos").alias("dropped")))
    both = src.alias("s").join(dropped.alias("d"), (F.col("s.k") == F.col("d.k"))
                               & F.col("s.id").eqNullSafe(F.col("d.id")), "left")
    gone = F.coalesce(F.col("d.dropped"), F.array().cast("array<int>"))
    # The split array is bound once as a lambda variable; kept positions come
    # from a hash-based set difference, so the work is linear in the lines.
    kept = F.transform(F.array(split), lambda ls: F.struct(
        F.size(ls).cast("long").alias("n"),
        F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), gone),
                                 lambda i: F.get(ls, i)), "\n").alias("t")))[0]
    return (both.select(F.col("s.id").alias("id"), F.col("s.rest").alias("rest"), F.col("s.text").alias("text"),
                        F.when(F.size(gone) > 0, kept).alias("r"), F.size(gone).cast("long").alias("n_dropped"))
            .select("id", "rest", F.coalesce("r.t", "text").alias("kept_text"),
                    F.coalesce("r.n", (F.length("text") - F.length(F.translate("text", "\n", "")) + 1).cast("long"))
                    .alias("n_lines"), "n_dropped"))


def q_line_dedup(spark, sf_dir: str) -> DataFrame:
    from kinrank.llm.common import table
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, min_docs=10, min_chars=1).select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, t.pos AS pos, t.line AS line,
         translate(trim(t.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(ls) AS line, generate_subscripts(ls, 1) AS pos) t),
hot AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT l.doc_id, l.pos, l.line, h.key IS NOT NULL AS gone FROM lines l LEFT JOIN hot h ON l.key = h.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
