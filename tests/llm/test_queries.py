"""Every query with SQL against DuckDB, and the contract of the others."""

import hashlib
import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kinrank.llm import registry
from kinrank.plans.compare import compare

from ..conftest import SF_SMALL
from . import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    return sorted((r["doc_id"], r["text"], r["lang"]) for r in rows)


def result(spark, name, sf=SF_SMALL):
    return {r["doc_id"]: r for r in registry.queries()[name](spark, sf).collect()}


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    r = compare(spark, duck, name, registry.queries()[name], registry.oracle_sql()[name], SF_SMALL)
    assert r["ok"], r


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))


def test_pack(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in registry.queries()["op1_pack"](spark, SF_SMALL).collect():
        pieces[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text, _ in docs:
        ids, at = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for p in sorted(pieces[i], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


def test_bpe(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = result(spark, "op4_bpe")
    for i, text, _ in docs:
        ids = tok.encode(text or "", add_special_tokens=False).ids
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False)))


def test_language(spark):
    got = registry.queries()["op5_language"](spark, SF)
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(lang, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)


def test_quality(spark):
    sf = "/root/testdata/sf0.1"
    got = registry.queries()["op7_quality"](spark, sf)
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"]]
    clean, junk = ([r["predicted"] for r in held if r["quality"] == q] for q in (1, 0))
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) <= 0.15 * len(junk)


def test_simhash(spark, docs):
    got = result(spark, "op8_simhash")
    order = docs[::-1]
    by_text = {}
    for k, (i, text, _) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == sha(text[:len(text) - half] + after[:half])
        assert by_text.setdefault(text, got[i]["fingerprint"]) == got[i]["fingerprint"]
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    n = [r for r in got.values() if r["n_chars"] > 200]
    assert np.mean([r["near_edited"] for r in n]) > 0.35 > 0.15 > np.mean([r["near_next"] for r in n])


def test_suffix(spark, docs):
    got = result(spark, "op9_suffix")
    for (i, _, _), (n, gone, spans, kept) in zip(docs, brute.suffixes([d[:2] for d in docs], 100), strict=True):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, gone, spans, sha(kept)), i


def test_vocabularies_are_not_in_the_repository():
    assert json.load(open(public_tokenizers.path("word_bpe_49k.json")))["model"]["merges"]
