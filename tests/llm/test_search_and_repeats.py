"""Ranked search, hard negatives and repeated passages: plain versions, many small blocks, and odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloom.llm import exact_dedup, hard_negatives, minhash, ranked_search, repeats

CLASH = ["id", "n", "terms", "times", "query", "item", "rank", "size", "block", "rows", "asks", "h", "d", "at", "sign", "row", "kept"]
EXTRA = ", ".join(f"`{c}` string" for c in CLASH)
LONG = " ".join(f"x{i * i % 9973}" for i in range(150_000))
PASSAGE = " ".join(f"p{i * 7919 % 1009}" for i in range(60))


# --- ranked search --------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ASCII = {c: c + 32 for c in range(65, 91)}


def plain_search(docs, queries, k):
    held = [(i, Counter(TERM.findall((t or "").translate(ASCII)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in queries:
        scores = []
        for i, c in held:
            norm = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * norm))
                for t in set(TERM.findall((text or "").translate(ASCII))) if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("at_once", [7, 10_000])
def test_search_against_all_scores(spark, at_once):
    rng = random.Random(5)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 400}"
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 60)))) for i in range(300)]
    docs += [(1000 + i, docs[i][1].upper()) for i in range(40)]  # ties
    queries = [(q, " ".join(word() for _ in range(rng.randrange(1, 12)))) for q in range(30)]
    how = ranked_search.Search(k=5, queries_at_once=11, documents_at_once=at_once)
    got = ranked_search.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(queries, "item_id long, text string"), how,
    )
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()), key=str) == plain_search(docs, queries, 5)


def test_accumulators_stop():
    """Documents that hold frequent terms only get none once they cannot come in, even by a tie."""
    postings = ranked_search.Postings.__new__(ranked_search.Postings)
    postings.owner = np.array([0, 1, 0, 2, 3], np.int32)
    postings.adds = np.array([100, 90, 5, 5, 5])
    postings.begin, postings.most = np.array([0, 2, 5]), np.array([100, 5])
    postings.total, postings.made = np.zeros(4, np.int64), np.zeros(4, bool)
    at, scores = postings.best([0, 1], 2, 1)
    assert (at.tolist(), scores.tolist(), postings.made.tolist()) == ([0, 1], [105, 90], [True, True, False, False])


def test_search_odd_rows(spark):
    texts = [(1, "Ab ab, é1"), (2, "ab AB; é1"), (3, None), (4, ""), (5, " .,"), (None, "ab"), (2, "ab AB; é1"), (6, LONG), (7, "É1 zz")]
    docs = spark.createDataFrame([(i, t, *CLASH) for i, t in texts], f"doc_id long, text string, {EXTRA}").repartition(3)
    asked = [(1, "AB"), (2, None), (3, "nowhere"), (4, "É1"), (None, "zz"), (5, "x0 x1"), (1, "AB")]
    queries = spark.createDataFrame([(i, t, *CLASH) for i, t in asked], f"item_id long, text string, {EXTRA}")
    got = ranked_search.search(docs, queries).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str) == plain_search(texts, asked[:-1], 50)
    assert ranked_search.search(docs.limit(0), queries).count() == ranked_search.search(docs, queries.limit(0)).count() == 0


# --- hard negatives -------------------------------------------------------------------------------

def plain_negatives(rows, how):
    kept = [
        (i, lab, tuple(math.floor(how.scale * float(x)) for x in v)) for i, v, lab in rows
        if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for a, lab, v in set(x for x in kept if x[0] % 10 == 0):
        met = sorted(
            (-sum(x * y for x, y in zip(v, w)), b, other) for b, other, w in kept if len(w) == len(v)
        )
        positives = [(b, -s) for s, b, other in met if other == lab and b != a][: how.positives]
        for p, score in set(positives):
            hard = [(b, -s) for s, b, other in met if other != lab and how.low * score <= -100 * s <= how.high * score]
            out |= {(a, p, rank, b, score, s) for rank, (b, s) in enumerate(hard[: how.negatives], 1)}
    return out


@pytest.mark.parametrize("rows_at_once, leaf", [(60, 4), (8192, 32)])
def test_negatives_against_all_scores(spark, rows_at_once, leaf):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 6))
    rows = [(i, [float(x) for x in centres[i % 4] + rng.normal(size=6) * 0.4], int(rng.integers(0, 3))) for i in range(400)]
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(90)]  # equal vectors: ties
    how = hard_negatives.Mining(rows_at_once=rows_at_once, anchors_at_once=16, leaf=leaf)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    plain = [(r.vec_id, r.embedding, r.label) for r in df.collect()]  # as floats
    got = hard_negatives.mined(df, F.col("vec_id") % 10 == 0, how).collect()
    found = {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got}
    assert len(found) == len(got) and found == plain_negatives(plain, how)


def test_boxes_hold_what_is_in_them():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-50, 50, (500, 5)).astype(float)
    tree = hard_negatives.Tree(np.arange(500), rng.integers(0, 3, 500), vectors, 8)
    anchor = rng.integers(-50, 50, (1, 5)).astype(float)
    least, most = (x[0] for x in tree.intervals(anchor))
    scores = tree.vectors @ anchor[0]
    seen = []
    for box in range(len(tree.low)):
        begin, end = tree.begin[box], tree.end[box]
        if box >= tree.leaves_from:
            seen += range(begin, end)
            assert len(set(tree.labels[begin:end])) == 1
            assert least[box] <= scores[begin:end].min() and scores[begin:end].max() <= most[box]
        else:
            assert (tree.low[box] == tree.low[begin:end].min(axis=0)).all() and most[box] >= most[begin:end].max()
    assert sorted(seen) == list(range(500)) and sorted(tree.ids) == list(range(500))


def test_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.25], 2), (2, [0.5, 0.25], 2), (3, None, 1), (4, [nan, 1.0], 1),
        (5, [1.0, inf], 1), (6, [1.0, None], 1), (7, [1.0, 1.0], None), (8, [], 1), (10, [1.0], 1), (20, [0.0, 0.0], 1), (None, [1.0, 1.0], 1),
        (30, [-1.0, -1.0], 5), (31, [1.0, 1.0], 5),
    ]
    df = spark.createDataFrame([(*r, *CLASH) for r in rows], f"vec_id long, embedding array<float>, label int, {EXTRA}")
    how = hard_negatives.Mining()
    got = hard_negatives.mined(df, F.col("vec_id") % 10 == 0, how).collect()
    found = {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got}
    assert found == plain_negatives(rows, how) and (0, 1, 2, 2, 81920, 40960) in found
    assert hard_negatives.mined(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(0, [1e9], 1), (1, [1e9], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.mined(df, F.lit(True)).collect()


# --- repeated passages ----------------------------------------------------------------------------

def plain_repeats(docs, least):
    """``{(id, text): spans}``; documents in the order of id, those without one last."""
    seen, out = {}, {}
    for i, text in sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0)):
        data, gone = (text or "").encode(), set()
        for s in range(len(data) - least + 1):
            window = data[s : s + least]
            if window in seen:
                gone.update(range(s, s + least))
            seen[window] = True
        edges = [p for p in sorted(gone) if p - 1 not in gone], [p + 1 for p in sorted(gone) if p + 1 not in gone]
        out[i, text] = list(zip(*edges))
    return out


def check_repeats(got, docs, least):
    want = plain_repeats(docs, least)
    assert len(got) == len(docs)
    for r in got:
        spans, data = want[r.doc_id, r.text], (r.text or "").encode()
        assert [(s.start, s.end) for s in r.repeats.spans] == spans
        kept = bytes(b for p, b in enumerate(data) if not any(s <= p < e for s, e in spans))
        assert bytes(r.repeats.kept) == kept
        assert (r.repeats.n_bytes, r.repeats.n_removed) == (len(data), len(data) - len(kept))


@pytest.mark.parametrize("group, least", [(repeats.GROUP, 100), (3, 100), (5, 77)])
def test_repeats_against_all_windows(spark, group, least):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, docs = [prose(40) for _ in range(3)], []
    for i in range(60):
        pieces = [prose(rng.randrange(1, 40)) for _ in range(3)]
        pieces.insert(rng.randrange(4), rng.choice(shared)[rng.randrange(60) :])
        pieces.insert(rng.randrange(4), shared[0])  # in every document, with other bytes around it
        docs.append((i, " ".join(pieces)))
    docs += [(100 + i, docs[i][1]) for i in range(5)] + [(200, "ab" * 300), (201, "x" * 700 + "ab" * 90 + "x" * 500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    check_repeats(repeats.repeats(df, least, group).collect(), docs, least)


def test_repeats_odd_rows(spark):
    base = "q" + PASSAGE
    docs = [
        (1, base), (2, base[:99]), (3, base[1:101]), (4, None), (5, ""), (6, base + "é" * 120), (6, base + "é" * 120), (None, base), (7, "é" * 49 + base),
        (9, "z" * 100), (8, "z" * 99), (10, "z" * 101),
    ]
    df = spark.createDataFrame([(i, t, *CLASH) for i, t in docs], f"doc_id long, text string, {EXTRA}").repartition(4)
    got = repeats.repeats(df)
    assert set(got.columns) == {*df.columns, "repeats"}
    check_repeats(got.collect(), docs, 100)
    assert repeats.repeats(df.limit(0)).count() == 0
    # rows of one id and different texts are documents of their own, one of them first
    twice = spark.createDataFrame([(1, PASSAGE + " one"), (1, PASSAGE + " two")], "doc_id long, text string")
    assert sorted(r.repeats.n_removed for r in repeats.repeats(twice).collect()) == [0, len(PASSAGE) + 1]


def test_repeats_in_a_long_text(spark):
    """A text of several segments whose end repeats its beginning and whose middle repeats another text."""
    long = " ".join(f"{i * i * 2_654_435_761 % 10**9:09d}" for i in range(140_000))
    docs = spark.createDataFrame([(1, long[500_000:503_000]), (2, long + " " + long[:5000])], "doc_id long, text string")
    r = {r.doc_id: r.repeats for r in repeats.repeats(docs).collect()}
    assert (r[1].n_removed, r[2].n_bytes, r[2].n_removed) == (0, 1_405_000, 8000)
    assert [(s.start, s.end) for s in r[2].spans] == [(500_000, 503_000), (1_400_000, 1_405_000)]


def test_suffix_order():
    rng = np.random.default_rng(2)
    for letters in (1, 2, 4):
        data = rng.integers(97, 97 + letters, 900).astype(np.uint8)
        start = np.arange(len(data) - 99)
        order, run = repeats.suffix_order(data, start, 100)
        keys = [data[s : s + 100].tobytes() for s in start[order]]
        assert keys == sorted(keys)
        assert [a == b for a, b in zip(keys, keys[1:])] == (run[1:] == run[:-1]).tolist()
        seen, want = set(), []
        for s in start:
            want.append(data[s : s + 100].tobytes() in seen)
            seen.add(data[s : s + 100].tobytes())
        assert repeats.repeats_earlier(data, start, 100).tolist() == want


# --- near copies: rows that share an id -------------------------------------------------------------

def test_near_copies_keep_unrelated_texts_of_one_id(spark):
    prose = lambda k: " ".join(f"w{k}x{i * i % 997}" for i in range(120))
    q, r, s = prose("q"), prose("r"), prose("s")
    rows = [(1, s), (2, prose("t")), (3, q), (3, r), (4, r + " tail"), (5, prose("u")), (6, q + " more"), (5, prose("u")), (None, q)]
    extra = ["node", "node_", "id", "sign", "times", "__id", "__n"]
    df = spark.createDataFrame([(i, t, *extra) for i, t in rows], "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in extra))
    left = minhash.near_copies_removed(df)
    assert left.columns == df.columns
    assert sorted((x.doc_id or 0, x.text) for x in left.collect()) == sorted(
        [(1, s), (2, rows[1][1]), (3, q), (3, r), (5, rows[5][1]), (0, q)]
    )


def test_exact_copies_beside_clashing_names(spark):
    names = ["id", "sha", "n", "_id", "_sha", "__id", "__sha", "__n"]
    df = spark.createDataFrame([(i, t, *names) for i, t in [(1, "a"), (2, "A"), (3, "b"), (3, "b")]], "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names))
    left = exact_dedup.copies_removed(df)
    assert left.columns == df.columns and sorted((r.doc_id, r.text) for r in left.collect()) == [(2, "A"), (3, "b")]
