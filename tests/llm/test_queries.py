"""The registered queries over the smallest tables, against SQL or a plain version."""

import array
import hashlib
from collections import defaultdict

import duckdb
import pytest

from compare import check, connection
from scoreloom.llm.queries import ORACLES, QUERIES
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connection(FOLDER)


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, sql, name):
    verdict, _, note = check(spark, sql, FOLDER, name, QUERIES[name], ORACLES[name])
    assert verdict == "exact", note


def test_near_copies(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op3_minhash"](spark, FOLDER).collect()}
    want = brute.near_components(texts.items(), 3, 85)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_personal_data(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op4_pii"](spark, FOLDER).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        spans = brute.personal(text)
        assert got[i].base_sha256 == brute.span_digest(spans)
        for kind in brute.PII:
            assert got[i][f"n_{kind}"] == sum(s[3] == kind for s in spans)


def test_packing(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op7_packing"](spark, FOLDER).collect():
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(docs) == set(texts)
    for i, pieces in docs.items():
        ids, at = [*tokenizer.encode(texts[i], add_special_tokens=False).ids, 0], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == brute.crc(array.array("I", ids[at : at + r.length]).tobytes())
            at += r.length
        assert at == len(ids)
    total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= 1024
        total += 1024
    assert total <= 1.02 * sum(r.length for p in docs.values() for r in p) + 1024


def test_tokens(spark, texts):
    import public_tokenizers
    import tiktoken

    from scoreloom.llm.bpe import read_ranks

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in QUERIES["op2_bpe"](spark, FOLDER).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        ids = known.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(array.array("I", ids).tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_shards(spark, texts):
    rows, shards = QUERIES["op9_virtual_slots"](spark, FOLDER).collect(), defaultdict(list)
    assert len(rows) == len(texts)
    for r in rows:
        body = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 8, brute.crc(body), "bytes", None)
        shards[r.shard].append(r)
    assert set(shards) <= set(range(24))
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    sums = [sum(r.size for r in own) for own in shards.values()]
    assert max(sums) - min(sums) <= max(r.size for r in rows)


def test_digest_of_nothing():
    assert brute.span_digest([]) == hashlib.sha256(b"").hexdigest()
