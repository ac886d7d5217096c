"""Each stage against brute force on what the stage before it kept."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp

from ..conftest import SF_SMALL
from . import brute
from .conftest import edge_rows, frame

STAGES = dict(cp.STAGES)


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "jaccard_join", "substring_dedup", "packing"]
    assert cp.ORACLE_SQL is None


@pytest.fixture(scope="module", params=["documents", "edges"])
def chain(request, spark):
    """[(stage, rows before, frame after)] with every frame written."""
    from kinrank.llm.common import written
    docs = (spark.read.parquet(f"{SF_SMALL}/documents.parquet") if request.param == "documents" else
            frame(spark, [(*r, None if k % 3 else "fr") for k, r in enumerate(edge_rows())]))
    out = {}
    for name, stage in cp.STAGES:
        after = written(stage(spark, docs, SF_SMALL), name)
        out[name] = (docs, after)
        docs = after
    return request.param, out


def test_columns_stay(chain):
    _, out = chain
    for name, (before, after) in list(out.items())[:-1]:
        assert after.dtypes == before.dtypes, name
        if name != "language_id":
            assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_language_keeps_clean_documents(chain):
    which, out = chain
    before, after = out["language_id"]
    kept, given = rows_of(after), rows_of(before)
    assert set(kept) <= set(given)
    gone = [t for i, t in given if (i, t) not in kept]
    if which == "documents":
        assert all(not any(c.isalpha() for c in t or "") for t in gone)
    else:
        assert {t for t in gone if t and any(c.isalpha() for c in t)} <= {"日本語 テキスト " * 20, "one", "null id", "x " * 200}
        assert not any(t is None or not any(c.isalpha() for c in t) for _, t in kept)


def junk(rng, n):
    """Texts of ``n`` characters in no learned language."""
    finnish = "ja on ei se että hän mutta oli niin kuin joka mitä tämä ovat kun vain myös jos sitä minä sinä kaikki".split()
    yield "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n))
    yield " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randrange(3, 9))) for _ in range(n))[:n]
    yield " ".join(rng.choice(finnish) for _ in range(n))[:n]
    yield "".join(rng.choice("日本語のテキストをここに書く") for _ in range(n))
    yield "".join(rng.choice("ABCDEFabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))


def test_language_rejects_junk_and_keeps_clean_documents(spark):
    """Junk in a learned script and unlearned languages go, labelled clean
    documents stay, in one stage over both."""
    sf, rng = "/root/testdata/sf0.01", random.Random(1)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bad = [(10 ** 9 + i, t) for i, t in enumerate(t for n in (80, 160, 320, 1000, 4000) for _ in range(12) for t in junk(rng, n))]
    more = spark.createDataFrame([(i, t, None, "junk", len(t)) for i, t in bad], docs.schema)
    kept = {r["doc_id"] for r in cp.language_id(spark, docs.unionByName(more), sf).select("doc_id").collect()}
    assert not kept & {i for i, _ in bad}
    clean = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").collect()}
    words = {r["doc_id"] for r in docs.filter("text rlike '[^\\\\s]'").collect()}
    assert len((clean & words) - kept) <= 0.002 * len(clean & words)


def test_lines(chain):
    _, out = chain
    before, after = out["line_dedup"]
    given = rows_of(before)
    want = [(i, kept) for (i, _), (_, _, kept) in zip(given, brute.lines(given, 10), strict=True)]
    assert rows_of(after) == sorted(want, key=repr)


def test_one_document_of_each_group(chain):
    _, out = chain
    before, after = out["jaccard_join"]
    given = rows_of(before)
    groups = brute.jaccard(given, 5, 80)
    want = [r for r, (n, _, c) in zip(given, groups, strict=True) if n == 0 or c is None or r[0] == c]
    # rows with the same id and text are one document
    assert set(rows_of(after)) == set(want)
    assert {c for n, _, c in groups if n and c is not None} <= {i for i, _ in rows_of(after)}


def test_substrings(chain):
    _, out = chain
    before, after = out["substring_dedup"]
    given = rows_of(before)
    want = [(i, kept) for (i, _), (_, _, kept) in zip(given, brute.substrings(given, 35), strict=True)]
    assert sorted(((i, " ".join(brute.words(t))) for i, t in rows_of(after)), key=repr) == sorted(want, key=repr)
    untouched = {t for (_, t), w in zip(given, brute.substrings(given, 35), strict=True) if not w[1]}
    assert untouched <= {t for _, t in rows_of(after)}


def test_pieces(chain):
    _, out = chain
    before, after = out["packing"]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((i, len(tok.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows_of(before)
                  if i is not None)
    got = {}
    for r in after.filter("doc_id is not null").collect():
        got.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    assert sorted(set(want)) == sorted(got)
    for i, t in rows_of(before):
        if i is None or [x for x, _ in want].count(i) > 1:
            continue
        ids, at = np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4"), 0
        for r in sorted(got[(i, len(ids))], key=lambda r: r["start"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_run(spark, chain):
    which, out = chain
    if which == "documents":
        cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        assert sorted(map(tuple, cp.run(spark, SF_SMALL).select(cols).collect())) == sorted(
            map(tuple, out["packing"][1].select(cols).collect()))


def test_empty_table(spark, nothing):
    docs = nothing
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == 0


def test_one_row_of_each_group_whatever_the_ids(spark):
    rng = random.Random(21)

    def prose(tag, n=80):
        return " ".join(f"{tag}{rng.randrange(10 ** 6)}" for _ in range(n))
    a, b, c, d, e, f = (prose(t) for t in "abcdef")
    rows = [(1, a), (1, a), (1, a),                          # repeated rows
            (2, b), (2, b + " more"), (2, c),                # near copies and another text under one id
            (None, d), (None, d), (None, d + " more"),       # a group without ids
            (None, e), (7, e + " more"), (9, e),             # the id wins over none
            (None, f), (30, None), (30, None), (31, " ")]    # alone; texts without words stay
    docs = frame(spark, rows)
    kept = rows_of(cp.jaccard_join(spark, docs, SF_SMALL))
    assert len(kept) == 9
    assert [r for r in kept if r[0] not in (2, None)] == sorted(
        [(1, a), (7, e + " more"), (30, None), (30, None), (31, " ")], key=repr)
    two, none = [t for i, t in kept if i == 2], [t for i, t in kept if i is None]
    assert c in two and len(two) == 2 and f in none and len(none) == 2
    after = rows_of(cp.substring_dedup(spark, cp.jaccard_join(spark, docs, SF_SMALL), SF_SMALL))
    assert after == sorted([(i, t or "") for i, t in kept], key=repr)  # no copy is left to empty the others


def test_rows_are_counted_by_group(chain):
    _, out = chain
    before, after = out["jaccard_join"]
    given = rows_of(before)
    sets = [brute.shingles(t, 5) for _, t in given]
    root = list(range(len(given)))
    for i in range(len(given)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    assert after.count() == len({r for r, s in zip(root, sets, strict=True) if s}) + sum(not s for s in sets)
