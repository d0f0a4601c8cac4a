"""Nulls, empty and very long texts, ties and repeated rows, empty tables and columns with clashing names."""

import array
import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scoreloom.llm import bpe, exact_dedup, licenses, minhash, packing, pii, quality, sharding, toxicity, url_filter
from tests.llm import brute

CLASH = ["kept", "n_words", "ids", "score", "shard", "pii", "quality", "component_id", "keep_id", "group_size", "id", "hash",
         "norm", "measured", "start", "bucket", "licence", "path", "host", "rule", "class", "band", "block", "n", "word"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
PROSE = " ".join(f"w{i * i % 997}" for i in range(400))
LONG = " ".join(f"x{i * i % 99991}" for i in range(150_000))
TEXTS = [
    (1, PROSE), (2, PROSE.upper()), (3, PROSE + " tail"), (4, None), (5, ""), (6, " \n\t "), (7, LONG), (8, "a" * 30_000),
    (9, "one"), (10, "one two"), (11, "ONE TWO"), (12, "mail a.b@c.de, call +1 (017) 555-7713 or 10.0.0.1"), (13, PROSE), (13, PROSE),
    (None, PROSE + " other"), (14, "1" * 5000 + "@"), (15, "😀 é漢 ½\x85 x  "),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if k % 3 else "src0", 0, *CLASH) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality(docs, none):
    rows = quality.repetition(docs).collect()
    assert len(rows) == len(TEXTS)
    found = {(r.doc_id, r.text): r.quality for r in rows}
    assert found[(4, None)].n_words == found[(5, "")].n_words == found[(6, " \n\t ")].n_words == 0
    assert found[(4, None)].base_failed and not found[(4, None)].kept
    assert found[(7, LONG)].n_words == 150_000 and found[(8, "a" * 30_000)].word_chars == 30_000
    assert found[(1, PROSE)].kept
    assert set(quality.rejected_removed(docs).columns) == set(docs.columns)
    assert quality.repetition(none).count() == quality.rejected_removed(none).count() == 0


def test_repetition_is_exact(spark):
    text = "a b c d e a b c d e x y\n\nrow one\nrow one\n \nrow one"
    r = quality.repetition(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().quality
    assert (r.n_words, r.n_repeat_words, r.n_dup_lines, r.dup_5gram_chars) == (18, 16, 2, 10)


def test_word_over_segments(spark):
    word = "b" * 2_500_000
    text = f"{word} c d {word} c d"
    r = quality.repetition(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().quality
    assert (r.n_words, r.n_repeat_words) == (6, 6)


def test_exact_copies(docs, none):
    rows = exact_dedup.copies(docs).collect()
    assert len(rows) == len(TEXTS)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert {(r.keep_id, r.group_size) for i in (1, 2, 13) for r in by[i]} == {(13, 4)}
    assert (by[4][0].keep_id, by[5][0].keep_id, by[4][0].group_size) == (5, 5, 2)
    assert by[11][0].kept and not by[10][0].kept
    assert by[None][0].kept and by[None][0].keep_id is None
    assert by[5][0].text_sha256 == hashlib.sha256(b"").hexdigest()
    left = exact_dedup.copies_removed(docs)
    assert left.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id) for r in left.collect())
    assert [i for _, i in ids] == [3, 5, 6, 7, 8, 9, 11, 12, 13, 14, 15, None]
    assert exact_dedup.copies(none).count() == exact_dedup.copies_removed(none).count() == 0


def test_colliding_hashes(docs):
    same = exact_dedup.copies(docs)
    short = exact_dedup.copies(docs, digest=lambda text: F.substring(F.md5(text), 1, 1))
    assert sorted(map(str, same.collect())) == sorted(map(str, short.select(same.columns).collect()))


def test_near_copies(docs, none):
    rows = minhash.linked(docs, minhash.Likeness(3, 85)).collect()
    assert len(rows) == len(TEXTS)
    want = brute.near_components([(i, t) for i, t in TEXTS if i is not None], 3, 85)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)
    left = minhash.near_copies_removed(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 4, 5, 6, 7, 8, 9, 10, 12, 14, 15]
    assert minhash.linked(none).count() == minhash.near_copies_removed(none).count() == 0


@pytest.mark.parametrize("like", [minhash.Likeness(3, 85), minhash.Likeness(5, 80)])
def test_large_group_of_near_copies(spark, like):
    """More than a block of texts around the threshold, so that all three rounds have work."""
    import random

    random.seed(5)
    base, texts = [f"w{random.randrange(10**6)}" for _ in range(120)], []
    for i in range(700):
        own = [f"v{random.randrange(10**6)}" if random.random() < (i % 7) / 100 else w for w in base]
        texts.append((i, " ".join(own)))
    rows = minhash.linked(spark.createDataFrame(texts, "doc_id long, text string").repartition(4), like).collect()
    want = brute.near_components(texts, like.words, like.percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want


def test_personal_data(docs, none):
    rows = pii.found(docs).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        base = [(s.start, s.order, s.end, s.kind) for s in r.pii if s.kind in pii.BASE]
        assert base == brute.personal(r.text)
    left = {r.doc_id: r for r in pii.masked(docs).collect()}
    assert left[12].text == "mail [EMAIL], call [PHONE] or [IP]" and left[12].n_chars == len(left[12].text)
    assert left[4].text is None and left[7].text == LONG
    assert pii.masked(docs).columns == docs.columns and pii.masked(none).count() == 0


HARD = [
    "a@b.c_x@d.e f@g.h.i@j.k", "x@y@z.com", "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.0255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112",
    "+1+2 +12 345 678 90- (+49 (30) 1234.5678 )", "5  4111111111111111 7", "+1234567890123456", "é+1 555 555 5555é a@é.b.c %@-.-",
    "4" * 40, "1-" * 30 + "1", "a." * 2000 + "@b.c", "12 " * 400,
]


def test_spans_like_plain_patterns(spark):
    rows = pii.found(spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")).collect()
    for r in rows:
        assert [(s.start, s.order, s.end, s.kind) for s in r.pii if s.kind in pii.BASE] == brute.personal(r.text)


def test_further_kinds(spark):
    text = "IBAN GB82 WEST 1234 5698 7654 32 and GB83 WEST 1234 5698 7654 32, 078-05-1120, your ssn 078-05-1120"
    spans = pii.found(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().pii
    extra = [(s.kind, text[s.start : s.end]) for s in spans if s.kind not in pii.BASE]
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in extra and sum(k == "iban" for k, _ in extra) == 1
    assert all(k != "ssn" or "078-05-1120" == t for k, t in extra) and any(k == "ssn" for k, _ in extra)


VOCABULARY = packing.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_packing(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(VOCABULARY)
    pieces = packing.packed(docs, VOCABULARY).collect()
    want = {}
    for i, t in TEXTS:
        want.setdefault(i, []).append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
    total = sum(len(x) for xs in want.values() for x in xs)
    assert sum(p.length for p in pieces) == total and all(len(p.ids) == 4 * p.length for p in pieces)
    for i, (ids, *more) in want.items():
        if not more:
            own = b"".join(p.ids for p in sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start))
            assert own == array.array("I", ids).tobytes()
    assert sum(p.doc_id == 13 and p.start == 0 for p in pieces) == 2
    assert packing.packed(none, VOCABULARY).count() == 0


def test_first_fit_decreasing():
    sizes = [700, 300, 600, 400, 512, 512, 1, 1023, 100]
    bins = packing.first_fit_decreasing(sizes, 1024)
    free, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = next((b for b, f in enumerate(free) if f >= sizes[i]), len(free))
        if at == len(free):
            free.append(1024)
        free[at] -= sizes[i]
        want[i] = at
    assert dict(enumerate(bins)) == want
    for least in (1, 8, 2000):
        content = packing.filled(sizes, bins, 1024, least)
        parts = sorted((i, first, n) for b in content for i, first, n in b)
        assert all(sum(n for _, _, n in b) <= 1024 for b in content)
        for i, size in enumerate(sizes):
            at = 0
            for _, first, n in (p for p in parts if p[0] == i):
                assert first == at and n > 0
                at += n
            assert at == size


def test_many_rests_leave_little_padding():
    import random

    random.seed(3)
    sizes = [random.randrange(1, 1024) for _ in range(1500)]
    content = packing.filled(sizes, packing.first_fit_decreasing(sizes, 1024), 1024, 8)
    assert len(content) * 1024 <= sum(sizes) * 1.004 + 1024


@pytest.fixture(scope="module")
def codec(spark):
    return bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def test_bpe(docs, none, codec):
    import tiktoken

    known = tiktoken.Encoding("own", pat_str=codec.pattern, mergeable_ranks=codec.ranks, special_tokens={})
    coded = codec.encode(docs).select("doc_id", "ids", codec.decode(F.col("ids")).alias("bytes"), codec.packed(F.col("ids")).alias("packed"))
    rows = coded.collect()
    assert len(rows) == len(TEXTS)
    texts = {i: t or "" for i, t in TEXTS}
    for r in rows:
        assert bytes(r.bytes) == texts[r.doc_id].encode()
        assert r.ids == known.encode_ordinary(texts[r.doc_id])
        assert bytes(r.packed) == array.array("I", r.ids).tobytes()
    assert codec.encode(none).count() == 0


def test_bpe_without_kept_words(spark, codec):
    import tiktoken

    known = tiktoken.Encoding("own", pat_str=codec.pattern, mergeable_ranks=codec.ranks, special_tokens={})
    texts = ["The unbelievable antidisestablishmentarianism's 12345 !!! ", "naïve Zürich 漢字 😀😀", "zzzzzzzzqqqq" * 5, " a  b\n\n c\t"]
    rows = codec.encode(spark.createDataFrame([(t,) for t in texts], "text string").withColumn("t", F.col("text")), limits=bpe.Limits(kept_words=0)).collect()
    assert all(r.ids == known.encode_ordinary(r.t) for r in rows)
    for word in ("aaaaaaaaaaab", "antidisestablishmentarianism", "ab" * 300, "hello"):
        assert bpe.merge_by_heap(word.encode(), codec.ranks) == known.encode_ordinary(word)


def test_bpe_tokens_that_no_merge_leads_to(spark):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abcd": 257, b"aba": 258, b"ba": 60_000}
    codec = bpe.Codec(ranks, r"[a-z]+|[^a-z]")
    words = ["abcd", "abcde", "abab", "ababa", "baba", "a", "é", "\U0010fffd\U0010fffe\U0010ffff"]
    want = [[257], [256, 99, 100, 101], [256, 256], [256, 258], [98, 258], [97], [195, 169]]
    for kept in (0, 100):
        df = spark.createDataFrame([(w,) for w in words * 2 + ["ba"]], "text string").withColumn("t", F.col("text"))
        rows = codec.encode(df, limits=bpe.Limits(kept_words=kept))
        got = {r.t: r.ids for r in rows.collect()}
        assert [got[w] for w in words[:-1]] == want
        assert got["ba"] == [60_000] and got[words[-1]] == list(words[-1].encode())


def test_kept_words_go_to_no_row(spark, codec):
    """Pairs and kept words are a subquery's value where they are looked up; literals would be in every logged plan."""
    df = spark.createDataFrame([("some words, some words",)] * 3, "text string")
    plan = codec.encode(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery") == 2 and " AS kept" not in plan and " AS pairs" not in plan
    assert len(plan) < 20_000


def test_bpe_of_long_words(spark, codec):
    import tiktoken

    known = tiktoken.Encoding("own", pat_str=codec.pattern, mergeable_ranks=codec.ranks, special_tokens={})
    texts = ["漢字仮名" * 300, "plain words, then " + "ab" * 50_000 + " and 12", "x" * 399 + " " + "y" * 401, " " * 900 + "z"]
    df = spark.createDataFrame([(t, 1, 2) for t in texts], "text string, words int, coded int").withColumn("t", F.col("text"))
    coded = codec.encode(df, limits=bpe.Limits(kept_words=0))
    assert coded.columns == ["words", "coded", "t", "ids"]
    rows = coded.withColumn("back", codec.decode(F.col("ids"))).collect()
    assert len(rows) == len(texts) and {r.words for r in rows} == {1} and {r.coded for r in rows} == {2}
    for r in rows:
        assert r.ids == known.encode_ordinary(r.t)
        assert bytes(r.back) == r.t.encode()


def test_shards(docs, none):
    rows = sharding.records(docs)
    sizes = sharding.slot_sizes(rows)
    first = sharding.balanced(sizes, 3)
    placed = sharding.placed(rows, first, sizes).collect()
    assert len(placed) == len(TEXTS) and {r.size for r in placed if r.doc_id in (4, 5)} == {8}
    for shard in range(3):
        own = [r.slot for r in placed if r.shard == shard]
        assert sorted(own) == list(range(len(own)))
    empty = sharding.records(none)
    assert sharding.placed(empty, sharding.balanced({}, 3), {}).count() == 0


def test_slot_maps(spark, tmp_path):
    import random

    random.seed(1)
    sizes = {s: (random.randrange(1, 1000), 1) for s in range(sharding.SLOTS)}
    first = sharding.balanced(sizes, 24)
    loads = first.loads(sizes)
    assert max(loads) - min(loads) <= 1000
    more = sharding.grown(first, sizes, 25)
    moved = [s for s in range(sharding.SLOTS) if first.shard_of[s] != more.shard_of[s]]
    assert moved and all(more.shard_of[s] == 24 for s in moved)
    assert max(more.loads(sizes)) - min(more.loads(sizes)) <= 2500
    sizes = {s: (b * (3 if first.shard_of[s] == 0 else 1), n) for s, (b, n) in sizes.items()}
    after = sharding.edited(first, sizes)
    loads = after.loads(sizes)
    assert max(loads) <= 1.01 * sum(loads) / 24 and after.version == 1
    first.save(spark, str(tmp_path / "maps"))
    after.save(spark, str(tmp_path / "maps"))
    assert sharding.SlotMap.load(spark, str(tmp_path / "maps")) == after
    assert sharding.SlotMap.load(spark, str(tmp_path / "maps"), 0) == first


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (7, None), (12, 1)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    rows = toxicity.scored(docs, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5, 6)}) == 1
    assert toxicity.scored(none, model).count() == 0
    one = toxicity.fit(toxicity.training_rows(docs, labels.where("doc_id = 1")))
    assert {round(r.score, 6) for r in toxicity.scored(docs, one).collect()} == {round(1 / 3, 6)}


def test_toxicity_learns(spark):
    import random

    random.seed(2)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeio" for c in ("lm", "rt", "st", "nd")]
    rows = []
    for i in range(600):
        text = [random.choice(words) for _ in range(random.randrange(20, 200))]
        if i % 5 == 0:
            text = [random.choice(("vileness", "scumbag")) if random.random() < 0.04 else w for w in text] + ["scumbag"]
        rows.append((i, " ".join(text), int(i % 5 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(toxicity.training_rows(frame, frame))
    held = toxicity.scored(frame, model).join(frame, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    assert len(held) > 100
    assert sum((r.score >= 0.7) == (r.toxic == 1) for r in held) >= 0.95 * len(held)


def test_licences(spark, docs, none):
    path = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    assert licenses.scan(docs, path).count() == len(TEXTS) and licenses.scan(none, path).count() == 0
    rows = [
        (1, "repo/LICENSE", "Released under the MIT License"), (2, "repo/src/a.py", "nothing here"),
        (3, "repo/sub/COPYING", PROSE + " Licensed under the Apache License, Version 2.0. " + PROSE), (4, "repo/sub/deep/b.py", None),
        (5, "repo/sub/c.py", "licensed UNDER cc by nc 4.0\n" + PROSE), (6, "other/d.py", PROSE), (7, None, ""), (8, "e.py", ""),
        (9, "repo/sub/NOTICE.md", "Licensed under the Apache License, Version 2.0 maybe"), (9, "repo/sub/NOTICE.md", "x"),
    ]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string"), F.col("path")).collect()
    found = {(r.doc_id, r.own_licence): (r.licence, r.inherited_from) for r in got}
    assert len(got) == len(rows)
    assert found[(2, None)] == ("MIT", "repo") and found[(4, None)] == ("Apache-2.0", "repo/sub")
    assert found[(5, "CC-BY-NC-4.0")] == ("CC-BY-NC-4.0", None) and found[(6, None)] == found[(7, None)] == found[(8, None)] == (None, None)
    assert found[(9, None)] == ("Apache-2.0", "repo/sub")


def test_cosines_against_all_windows(spark):
    import random
    from collections import Counter
    from math import log, sqrt

    random.seed(4)
    templates = {"A": ["free to use under the A licence"], "B": ["all rights reserved by the B company the end"]}
    pool = "free to use under the a b licence all rights reserved by company end x y z".split()
    texts = [(i, " ".join(random.choice(pool) for _ in range(random.randrange(0, 40)))) for i in range(80)]
    texts.append((80, "now free to use under the a licence"))
    df = {w: sum(w in t.split() for _, t in texts) for t in templates.values() for w in t[0].lower().split()}
    weigh = lambda n: log((1 + len(texts)) / (1 + n)) + 1
    vector = lambda ws: {w: n * weigh(df.get(w, 1)) for w, n in Counter(ws).items()}
    got = licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), F.lit("d/x"), templates=templates).collect()
    for r in got:
        words, best = dict(texts)[r.doc_id].split(), 0.0
        for t in templates.values():
            v = vector(t[0].lower().split())
            size = len(t[0].split())
            for i in range(len(words) - size + 1):
                u = vector(words[i : i + size])
                dot = sum(u[w] * v.get(w, 0) for w in u)
                best = max(best, dot / sqrt(sum(x * x for x in u.values())) / sqrt(sum(x * x for x in v.values())))
        assert (r.cosine or 0) == pytest.approx(best if best >= 0.8 else 0)


RULES = [("org", "/", "allow"), ("bad.net", "/", "block"), ("com", "/de/", "block"), ("ok.com", "/de/", "allow"), ("net", "/x", "block")]
PAGES = [
    (1, "https://WWW.bad.net/a?utm_source=q#f", "<p>"),
    (2, "http://mirror.io/a", '<LINK href="https://bad.net/a" rel="canonical">'),
    (3, "http://third.io/", "<meta http-equiv='refresh' content='0; url=//mirror.io/a'>"),
    (4, "http://a.org/x", '<link rel=canonical href="http://bad.net/a">'),
    (5, "http://x.com/de/1", None), (6, "https://www.ok.com/de/1", ""), (7, None, "x"), (8, "nonsense", "x"), (9, "://", None),
    (10, "http://y.com", "<p>"), (10, "http://y.com", "<p>"), (11, "http://z.io/p?page=2&ref=x", ""), (12, "http://notbad.net/xy", ""),
    (13, "http://fifth.io/b", '<link rel="canonical" href="/c.html">'), (14, "https://fifth.io/c", ""), (15, "http://" + "a." * 3000 + "com/de/", "x"),
]


def test_urls(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("verdict", F.lit("?")).withColumn("a", F.lit("?"))
    got = {r.page_id: r for r in url_filter.judge(pages, rules).collect()}
    # 4 is allowed by rule and an alias of 1 to 3, so 2 and 3 are not blocked with 1
    assert [got[i].verdict for i in (1, 2, 3, 4, 5, 6)] == ["block", "allow", "allow", "allow", "block", "allow"]
    assert len({got[i].alias_of for i in (1, 2, 3, 4)}) == 1 and got[13].alias_of == got[14].alias_of
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in (7, 8, 9)] == [("", "", None, "allow")] * 3
    assert (got[12].rule, got[12].verdict, got[15].rule) == ("net/x", "block", "com/de/")
    fewer = {r.page_id: r.verdict for r in url_filter.judge(pages.where("page_id != 4"), rules).collect()}
    assert fewer[2] == fewer[3] == "block" and fewer[11] == "allow"
    moved = spark.createDataFrame([("http://z.io/p?page=2", "http://bad.net/q")], "a string, b string")
    assert {r.page_id: r.verdict for r in url_filter.judge(pages, rules, redirects=moved).collect()}[11] == "block"
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert url_filter.judge(pages, rules.limit(0)).where("verdict != 'allow'").count() == 0


def test_components(spark):
    from scoreloom.llm.components import components

    chain = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 600)] + [(7, 7), (None, 3), (600, 599)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 201)} | {i: 500 for i in range(501, 601)}


def test_pipeline_on_odd_rows(spark, docs, none):
    for start in (docs, none):
        at = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, "")
            assert at.columns == start.columns, name
            at = at.cache()
            at.count()
        assert corpus_pipeline.STAGES[-1][1](spark, at, "").count() >= 0


def test_common_words_weigh_little_in_windows(spark):
    """A notice with one ordinary extra word keeps the real weight of that word, whether the tasks know it or not."""
    from collections import Counter
    from math import log, sqrt

    texts = [(i, f"doc{i} und der und w{i % 7} " + "en " * (i % 5 > 1)) for i in range(3000)]
    texts += [(3000, "Licensed under en the Apache License, Version 2.0"), (3001, "x Released under en MIT License y"),
              (3002, "Released doc5 doc6 MIT License"), (3003, "Released under the MIT License")]
    templates = {"Apache-2.0": ["Licensed under the Apache License, Version 2.0"], "MIT": ["Released under the MIT License"]}
    words = lambda t: t.lower().replace(",", "").replace(".", " ").split()
    df = Counter(w for _, t in texts for w in set(words(t)))
    vector = lambda ws: {w: n * (log((1 + len(texts)) / (1 + df[w])) + 1) for w, n in Counter(ws).items()}
    size = lambda v: sqrt(sum(x * x for x in v.values()))

    def best(text):
        found = [(0.8, None)]
        for name, (template,) in templates.items():
            v, n = vector(words(template)), len(words(template))
            for i in range(len(words(text)) - n + 1):
                u = vector(words(text)[i : i + n])
                found.append((sum(u[w] * v.get(w, 0) for w in u) / size(u) / size(v), name))
        return max(found, key=lambda f: f[0])

    want = {i: best(t) for i, t in texts[3000:]}
    assert [want[i][1] for i in range(3000, 3004)] == ["Apache-2.0", "MIT", None, "MIT"]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    for known in (65_536, 3, 0):
        got = {r.doc_id: r for r in licenses.scan(frame, F.lit("d/x"), templates=templates, all_terms=True, known_terms=known).where("doc_id >= 3000").collect()}
        for i, (value, name) in want.items():
            assert got[i].own_licence == name and got[i].cosine == (pytest.approx(value) if name else None)


def test_headers_and_licence_files(spark):
    """Standard headers, in comments too, and the files as they are published; versions and clauses told apart."""
    import pathlib

    header = "\n# ".join(["", "This {} is free software: you can redistribute it and/or modify", "it under the terms of the GNU {}General Public License as published by",
                          "the Free Software Foundation, either version {} of the License, or", "(at your option) any later version.", ""])
    clauses = ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
               "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer"
               " in the documentation and/or other materials provided with the distribution."]
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
    third = " Neither the name of the holder nor the names of its contributors may be used to endorse or promote products derived from this software."
    cases = [
        ("GPL-3.0", header.format("program", "", "3")), ("GPL-2.0", header.format("program", "", "2")), ("LGPL-2.1", header.format("library", "Lesser ", "2.1")),
        ("LGPL-3.0", header.format("library", "Lesser ", "3")), ("AGPL-3.0", header.format("program", "Affero ", "3")),
        ("GPL-2.0", "licensed under the GNU General Public License, version 2"), ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
        ("BSD-2-Clause", bsd + " ".join(clauses)), ("BSD-3-Clause", bsd + " ".join(clauses) + third),
        ("BSD-3-Clause", bsd + "1. " + clauses[0] + " 2. " + clauses[1] + " 3." + third),
        ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
        ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
        ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"
                    " https://www.eclipse.org/legal/epl-2.0/"),
        (None, "licensed under the GNU General Public License, version"),
    ]
    folder = pathlib.Path("/usr/share/common-licenses")
    for name, file in [("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-2.0", "LGPL-2"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3.0", "LGPL-3"), ("Apache-2.0", "Apache-2.0"),
                       ("MPL-2.0", "MPL-2.0"), ("MPL-1.1", "MPL-1.1"), ("CC0-1.0", "CC0-1.0"), ("BSD-3-Clause", "BSD"), ("GFDL-1.3", "GFDL-1.3")]:
        if (folder / file).exists():
            cases.append((name, (folder / file).read_text()[:6000]))
    rows = [(i, f"r{i}/LICENSE", f"{PROSE}\n{t}\n{PROSE}") for i, (_, t) in enumerate(cases)] + [(1000 + i, f"r{i}/a/b.py", PROSE) for i in range(len(cases))]
    frame = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: r for r in licenses.scan(frame, F.col("path"), all_terms=True).collect()}
    assert [got[i].own_licence for i in range(len(cases))] == [name for name, _ in cases]
    assert all(got[1000 + i].licence == name for i, (name, _) in enumerate(cases))


def test_account_numbers_before_short_words(spark):
    texts = [("IBAN BE68 5390 0754 7034", " BIC GKCCBEBB"), ("account ES9121000418450200051332", " EUR 100"), ("bank AT611904300234573201", " BIC X"),
             ("IBAN PL61 1090 1014 0000 0712 1981 2874", " I"), ("IBAN SE45 5000 0000 0583 9825 7466", " 2024"), ("IBAN NO93 8601 1117 947", " AB1"),
             ("IBAN GB82WEST12345698765432", "")]
    frame = spark.createDataFrame([(i, a + b) for i, (a, b) in enumerate(texts)], "doc_id long, text string")
    left = {r.doc_id: r.text for r in pii.masked(frame).collect()}
    assert left == {i: a.split(" ")[0] + " [IBAN]" + b for i, (a, b) in enumerate(texts)}
    wrong = spark.createDataFrame([(1, "IBAN BE69 5390 0754 7034 BIC, IBAN ZZ68 5390 0754 7034")], "doc_id long, text string")
    assert all(s.kind != "iban" for s in pii.found(wrong).first().pii)


def test_added_tokens_of_the_vocabulary(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(VOCABULARY)
    assert tokenizer.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]
    texts = ["a<|endoftext|>b", "<|endoftext|>", "one <|endoftext|>  two <|endoftext|>", "<|endoftext| >", PROSE + " <|endoftext|>" + PROSE]
    pieces = packing.packed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), VOCABULARY).collect()
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert b"".join(p.ids for p in own) == array.array("I", ids).tobytes() and all(p.doc_tokens == len(ids) for p in own)
