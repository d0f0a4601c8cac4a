"""The pipeline over the smallest tables against plain versions of its stages."""

import array
from collections import defaultdict

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from scoreloom.llm.queries_quality import SQL as QUALITY
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def masked(text):
    out, at = [], 0
    for start, _, end, kind in brute.personal(text):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
    return "".join(out) + text[at:]


def test_stages(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    texts = dict(con.sql("SELECT doc_id, text FROM documents").fetchall())
    good = {i for (i,) in con.sql(f"SELECT doc_id FROM ({QUALITY}) WHERE kept").fetchall()}
    texts = {i: t for i, t in texts.items() if i in good}
    latest = {}
    for i, t in texts.items():
        key = t.translate(brute.ASCII)
        latest[key] = max(i, latest.get(key, i))
    texts = {i: texts[i] for i in latest.values()}
    component = brute.near_components(texts.items(), 5, 80)
    texts = {i: masked(t) for i, t in texts.items() if component[i][1] == i}
    assert 50 < len(texts) < 200

    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(texts)
    for i, t in texts.items():
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        assert b"".join(r.ids for r in sorted(pieces[i], key=lambda r: r.start)) == array.array("I", ids).tobytes()


def test_every_stage_returns_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
