"""SimHash document fingerprints [native]: DataFrame functions only.

Every term (a run of ``WIDTH`` words) is hashed to 128 bits; each occurrence
votes for its bits, so a term weighs what it occurs; a bit of the fingerprint
is set when more than half of the votes are for it. Votes are added by plain
sums: two bits share a 64-bit sum, 32 bits apart.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm.common import pack, table, text_bytes, written

BITS = 128
WIDTH = 5                # words of a term
NEIGHBOUR_BYTES = 4 << 20  # texts of one sorted group when documents meet the next one
MOST_GROUPS = 1 << 14    # of these groups; beyond that they grow, and sort with spilling
GROUP_SAMPLE = 64        # sampled rows for each group's bound
# Near copies are sought at a Jaccard similarity of 0.99 of the terms: 7 bits
# reach 93 % of them (see the README for other similarities).
RADIUS, AGREE = 7, 2
KEY_BITS = 40            # of a table's number and the blocks that agree
SALTS = 16               # copies of a class's count that its documents are dealt over
_LANES = 0x0000000100000001


def terms(text: Column) -> Column:
    """Two 64-bit hashes for each word and the words after it."""
    words = F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+", -1), lambda w: w != "")

    def hashes(ws: Column) -> Column:
        def at(w: Column, i: Column) -> Column:
            run = [w] + [F.get(ws, i + j) for j in range(1, WIDTH)]
            h = F.xxhash64(*run)
            return F.struct(h.alias("a"), F.xxhash64(h, F.length(w)).alias("b"))
        return F.transform(ws, at)
    # the words are bound once as a lambda variable
    return F.flatten(F.transform(F.array(words), hashes))


def votes(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys, fingerprint`` (32 hex digits, zeros without terms), one row per
    distinct key; occurrences of a term are summed before any shuffle."""
    each = docs.select(*keys, F.explode_outer(terms(F.col(text))).alias("t")).select(*keys, "t.a", "t.b")
    lane = F.lit(_LANES)
    sums = [F.sum(F.shiftrightunsigned(c, j).bitwiseAND(lane)).alias(f"{c}{j}")
            for c in ("a", "b") for j in range(32)]
    counted = each.groupBy(*keys).agg(F.count("a").alias("n"), *sums)
    half = F.lit((1 << 32) - 1)

    def word(c: str) -> Column:
        out = None
        for j in range(32):
            both = F.coalesce(F.col(f"{c}{j}"), F.lit(0))
            low = (2 * both.bitwiseAND(half) > F.col("n")).cast("long")
            high = (2 * F.shiftrightunsigned(both, 32) > F.col("n")).cast("long")
            bit = F.shiftleft(low, j).bitwiseOR(F.shiftleft(high, j + 32))
            out = bit if out is None else out.bitwiseOR(bit)
        return F.lpad(F.lower(F.hex(out)), 16, "0")
    return counted.select(*keys, F.concat(word("a"), word("b")).alias("fingerprint"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, k, fingerprint`` for each document (equal rows are one row).

    Defined cases: a null or empty text, or one of white space alone, has no
    terms and the fingerprint of zeros; a text shorter than a term has shorter terms; a null id is kept.
    """
    src = pack(docs, id_col, text_col).withColumn("k", F.xxhash64("id", "text"))
    return votes(src, ["id", "k"], "text")


def _part(fp: str, i: int) -> Column:
    return F.conv(F.substring(fp, 16 * i + 1, 16), 16, -10).cast("long")


def distance(a: str, b: str) -> Column:
    """Hamming distance of two fingerprints."""
    out = None
    for i in range(BITS // 64):
        d = F.bit_count(_part(a, i).bitwiseXOR(_part(b, i)))
        out = d if out is None else out + d
    return out


def likeness(a: str, b: str) -> Column:
    """Cosine that the distance stands for, from 0 to 1."""
    return F.greatest(F.lit(0.0), F.cos(F.lit(3.141592653589793) * distance(a, b) / BITS)).cast("double")


def near_pairs(prints: DataFrame, radius: int = RADIUS, agree: int = AGREE) -> DataFrame:
    """All pairs of different fingerprints within ``radius`` bits: ``a, b,
    distance`` with a < b, between fingerprints (not documents: documents with
    equal fingerprints are one class, to be joined by the fingerprint).

    Permuted block tables: the 32 hex digits are cut into ``radius + agree``
    blocks; two fingerprints that differ in ``radius`` bits agree in ``agree``
    blocks at least, so each choice of ``agree`` blocks is the key of one table
    and every pair meets in one of them. More agreeing blocks make longer keys
    (fewer chance meetings) and more tables. The distance is a condition of
    the join, so only pairs within the radius leave it, and the rows of a hot
    bucket can be dealt over tasks by the skew join.
    """
    n = radius + agree
    if radius < 0 or agree < 1 or n > 32:
        raise ValueError("radius + agree is at most 32")
    cuts = [round(i * 32 / n) for i in range(n + 1)]
    block = [F.substring("fingerprint", cuts[i] + 1, cuts[i + 1] - cuts[i]) for i in range(n)]
    keys = F.array(*[F.shiftrightunsigned(F.xxhash64(F.lit(t), *[block[i] for i in chosen]), 64 - KEY_BITS)
                     for t, chosen in enumerate(combinations(range(n), agree))])
    reps = prints.select("fingerprint").filter(F.col("fingerprint").isNotNull()).distinct()
    keyed = reps.select(_part(F.col("fingerprint"), 0).alias("x"), _part(F.col("fingerprint"), 1).alias("y"),
                        F.explode(keys).alias("key"))
    # a merge join: the size that Spark estimates knows nothing of the explode,
    # and what it would broadcast for small are rows for every table
    a, b = keyed.alias("a"), keyed.hint("merge").alias("b")
    bits = sum(F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}"))) for c in "xy")
    once = (F.col("a.x") < F.col("b.x")) | ((F.col("a.x") == F.col("b.x")) & (F.col("a.y") < F.col("b.y")))
    one, two = (F.concat(*[F.lpad(F.lower(F.hex(f"{side}.{c}")), 16, "0") for c in "xy"]) for side in "ab")
    return (a.join(b, (F.col("a.key") == F.col("b.key")) & once & (bits <= radius))
            .select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b"), bits.alias("distance")).distinct())


def near_counts(prints: DataFrame, radius: int = RADIUS, agree: int = AGREE) -> DataFrame:
    """``fingerprint, n_near``: for ``prints`` of one row per document, how many
    other documents have a fingerprint within ``radius`` bits, equal ones
    included; only fingerprints with any. A fingerprint of zeros is that of
    documents without terms, which are near to none."""
    classes = (prints.filter(F.col("fingerprint") != "0" * (BITS // 4)).groupBy("fingerprint")
               .agg(F.count("*").alias("members")))
    pairs = written(near_pairs(classes, radius, agree), "pairs")
    other = (pairs.select(F.col("a").alias("to"), F.col("b").alias("fingerprint"))
             .unionByName(pairs.select(F.col("b").alias("to"), F.col("a").alias("fingerprint")))
             .join(classes.hint("merge"), "fingerprint")
             .select(F.col("to").alias("fingerprint"), F.col("members").alias("n")))
    return (classes.select("fingerprint", (F.col("members") - 1).alias("n")).filter("n > 0").unionByName(other)
            .groupBy("fingerprint").agg(F.sum("n").alias("n_near")))


def _bounds(src: DataFrame, rows: int, groups: int) -> list[tuple]:
    """At most ``groups - 1`` keys ``(id, k)`` in descending order that part
    the rows evenly: from a hashed sample of ``GROUP_SAMPLE`` rows a group, so
    a bounded number of keys at any size. Null ids are the smallest."""
    if groups < 2 or not rows:
        return []
    part = min(1.0, GROUP_SAMPLE * groups / rows)
    some = src.filter(F.shiftrightunsigned(F.xxhash64("k"), 33) < F.lit(int(part * (1 << 31)))).select("id", "k")
    keys = sorted({(r["id"] is not None, r["id"] or 0, r["k"]) for r in some.collect()}, reverse=True)
    step = max(1, -(-len(keys) // groups))
    return [(i if known else None, k) for known, i, k in keys[step::step]]


def _literal(keys: list[tuple]) -> Column:
    def number(x):
        return "CAST(NULL AS BIGINT)" if x is None else f"{x}L"
    return F.expr("array(" + ",".join(f"named_struct('id', {number(i)}, 'k', {number(k)})" for i, k in keys) + ")")


def next_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   group_bytes: int = NEIGHBOUR_BYTES) -> DataFrame:
    """Each document with the next one in descending id: ``id, k, g, ghost,
    text, next_text``; after the last comes the first.

    Documents are dealt into groups of about ``group_bytes`` by ranges of id
    and text hash (``MOST_GROUPS`` at most); each group gets a copy
    (``ghost``) of the document that follows its last one, so a window inside
    the group sees every successor and a text is shuffled once.

    Defined cases: a null text is empty; equal ids are ordered by the hash of
    id and text, null ids come last in that order, so that neither makes a
    large group; of equal rows each follows the other; a single document
    follows itself; an empty table gives an empty table. A very long text is
    one row of its group.
    """
    src = (pack(docs, id_col, text_col)
           .select("id", "text", F.xxhash64("id", "text").alias("k")))
    total = src.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    groups = min(MOST_GROUPS, max(1, -(-(total["bytes"] or 0) // group_bytes)))
    bounds = _bounds(src, total["rows"], groups)
    where = F.lit(0)
    if bounds:
        # the bounds are looked through in two steps, about the square root of
        # their number each; structs compare field by field, nulls first
        step = max(1, int(len(bounds) ** 0.5))
        coarse, fine = _literal(bounds[::step]), _literal(bounds)
        mine = F.struct(F.col("id").cast("bigint").alias("id"), "k")
        base = F.greatest(F.size(F.filter(coarse, lambda b: b > mine)) - 1, F.lit(0)) * step
        where = base + F.size(F.filter(F.slice(fine, base + 1, F.lit(step)), lambda b: b > mine))
    src = src.withColumn("g", where)
    heads = (src.groupBy("g").agg(F.max(F.struct("id", "k")).alias("head"))
             .select("g", "head.id", "head.k"))  # one row per group
    ring, whole = Window.partitionBy(F.lit(0)).orderBy("g"), Window.partitionBy(F.lit(0))
    goes = heads.select(F.col("id").alias("hid"), F.col("k").alias("hk"),
                        F.coalesce(F.lag("g").over(ring), F.max("g").over(whole)).alias("to"))
    # MOST_GROUPS rows at most, so no text leaves its scan for them
    ghosts = (src.join(F.broadcast(goes), F.col("id").eqNullSafe(F.col("hid")) & (F.col("k") == F.col("hk")))
              .dropDuplicates(["to"]).select("id", "text", "k", F.col("to").alias("g"), F.lit(1).alias("ghost")))
    every = src.select("id", "text", "k", "g", F.lit(0).alias("ghost")).unionByName(ghosts)
    in_group = Window.partitionBy("g").orderBy("ghost", F.col("id").desc_nulls_last(), F.col("k").desc())
    return (every.withColumn("next_text", F.lead("text").over(in_group))
            .withColumn("r", F.row_number().over(in_group)).drop("k"))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    group_bytes: int = NEIGHBOUR_BYTES) -> DataFrame:
    """Fingerprints of each text and of its edited form, whose last
    floor(n/2) characters are the next document's first ones, and their
    likeness; one row per input row. See ``next_documents`` for the order.

    Defined cases: a null text is empty; a text without words has the
    fingerprint of zeros, and two of them are alike (1); a text under two
    characters is not edited; repeated rows, null ids, one document and the
    empty table as in ``next_documents``. A very long text is read whole, its
    votes are added up as it is read."""
    near = next_documents(docs, id_col, text_col, group_bytes)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    keys = ["g", "r", "id", "ghost", "n_chars", "edited_sha256"]
    both = (near.select("g", "r", "id", "ghost", "text", F.length("text").cast("long").alias("n_chars"),
                        F.when(F.col("ghost") == 0, edited).alias("edited"))
            .select(*[k for k in keys if k != "edited_sha256"],
                    F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                    F.posexplode(F.array("text", "edited")).alias("kind", "t")))
    prints = votes(both, [*keys, "kind"], "t")
    wide = prints.groupBy(*keys).agg(F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"),
                                     F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    in_group = Window.partitionBy("g").orderBy("r")
    return (wide.withColumn("next_fingerprint", F.lead("fingerprint").over(in_group)).filter("ghost = 0")
            .select("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                    likeness("fingerprint", "next_fingerprint").alias("near_next")))


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   group_bytes: int = NEIGHBOUR_BYTES, radius: int = RADIUS, agree: int = AGREE) -> DataFrame:
    """``edited_likeness`` with ``n_near``, the number of other rows with a
    fingerprint within ``radius`` bits (see ``near_counts``).

    Within the radius every row is counted. Of documents whose terms have a
    given Jaccard similarity that is 93 % at 0.99, but 75 % at 0.98, 26 % at
    0.95 and nearly none at 0.8: less alike copies are out of its reach.

    Defined cases: as in ``edited_likeness``; documents without terms are near
    to none; repeated rows and null ids count one by one."""
    found = edited_likeness(docs, id_col, text_col, group_bytes)
    hexed = ["edited_sha256", "fingerprint", "edited_fingerprint"]
    kept = written(found.select(*[F.unhex(c).alias(c) if c in hexed else F.col(c) for c in found.columns]), "prints")
    kept = kept.select(*[F.lower(F.hex(c)).alias(c) if c in hexed else F.col(c) for c in found.columns])
    # a hot class's documents are dealt over SALTS copies of its count; joined by
    # merging, as the copies are not in the size by which Spark would broadcast them
    near = (written(near_counts(kept.select("fingerprint"), radius, agree), "near")
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("id", "edited_sha256"), F.lit(SALTS)).cast("int"))
    return (salted.join(near.hint("merge"), ["fingerprint", "salt"], "left")
            .select(*found.columns, F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")))


def q_simhash(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_documents(docs).withColumnRenamed("id", "doc_id")
