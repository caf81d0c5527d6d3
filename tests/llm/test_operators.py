"""Operators against their plain versions, on documents that hold every odd case at once."""

import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keymend.llm import brown_lm, common, exact_dedup, minhash_forest, pack, pii, quality_classifier, quality_rules, source_mix, substring_dedup, suffix_dedup, suffix_sort, tokens
from keymend.llm.components import components
from tests.llm import brute


def corpus():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage = text(200), text(90)
    rows = [None, "", " \t\n ", "x", "one two three", "ONE two\tthree", "a " * 3000, "z" * 5000, base, base, base.upper(), base.replace(" ", "  ")]
    for _ in range(25):
        w = base.split()
        w[r.randrange(200)] = "changed"
        rows.append(" ".join(w))
    rows += [f"{text(60)} {passage}\n{text(50)}" for _ in range(12)]
    rows += [text(r.randint(1, 300)) for _ in range(30)] + [text(6000), "line one\nline one\nline two " + text(80)]
    rows += ["mail a.b@c.de or +49 (30) 1234-5678, 4111 1111 1111 1111 1.2.3.4 999.1.1.1 é😀x@y.zz", "a@b.c_d@e.fg token = \"" + "0a" * 20 + "\"", "1" * 3000, "it's John's 'start !'s あ <|endoftext|> 12 x  y  z\x1c"]
    return [(i + 1, t, ("src%d" % (i % 5)) if i % 11 else None, "en" if i % 3 else None) for i, t in enumerate(rows)]


ROWS = corpus()
TEXTS = [(d, t) for d, t, _, _ in ROWS]
SCHEMA = "doc_id long, text string, source string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    extra = {c: F.lit("x") for c in ("cnt", "n", "size", "target", "rep", "class", "kept", "low", "tree", "component", "hits", "score", "block", "n_chars")}
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).withColumns(extra).cache()


def table(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_exact(docs):
    want = brute.exact(TEXTS)
    assert table(exact_dedup.exact_dedup(docs), "keep_id", "group_size", "kept", "text_sha256") == want
    assert table(exact_dedup.exact_dedup(docs, counters=1), "keep_id", "group_size", "kept", "text_sha256") == want


def test_near(docs):
    assert table(minhash_forest.minhash_dedup(docs), "n_shingles", "component_id", "kept") == brute.near(TEXTS)


def crowd(n=600):
    """Documents that share most of their words, so that regions are crowded; each is just similar enough to one
    other, whose id is far away."""
    r = random.Random(11)
    words = lambda n: ["".join(r.choice("abcdefghij") for _ in range(7)) for _ in range(n)]
    common, ids, out = words(140), r.sample(range(10**6), n), []
    for i in range(0, n, 2):
        own = words(12)
        out += [(ids[i + j], " ".join(common + own + words(24))) for j in range(2)]
    return out


@pytest.mark.parametrize("whole", [1, 128])
def test_near_at_each_depth(docs, whole, monkeypatch):
    monkeypatch.setattr(minhash_forest, "WHOLE", whole)
    monkeypatch.setattr(minhash_forest, "CELL", 5)
    assert table(minhash_forest.minhash_dedup(docs), "n_shingles", "component_id", "kept") == brute.near(TEXTS)


def test_near_in_crowded_regions(spark):
    texts = crowd()
    got = table(minhash_forest.minhash_dedup(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)), "n_shingles", "component_id", "kept")
    want = brute.near(texts)
    assert len({c for _, c, _ in want.values()}) == len(texts) // 2
    assert got == want


def test_links_in_cells_by_pairs_and_by_products(monkeypatch):
    """A cell's links join the same components either way."""
    r = np.random.default_rng(4)
    sets = []
    for _ in range(12):
        base = r.choice(2**50, 60, replace=False)
        sets += [np.unique(np.concatenate([base[: r.integers(40, 60)], r.choice(2**50, r.integers(0, 12))])) for _ in range(8)]
    sets.append(np.unique(r.choice(2**50, 5000)))
    raw = [x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes() for x in sets]
    n = len(sets)
    ids, size = r.permutation(n) + 7, np.array([len(x) for x in sets])
    comp = np.where(np.arange(n) % 8 < 2, ids[np.arange(n) // 8 * 8], ids)
    whole = np.ones(n, bool)

    def groups(links):
        up = {c: c for c in comp.tolist()}
        for a, b in links:
            old, new = up[a], up[b]
            up = {k: new if v == old else v for k, v in up.items()}
        return {frozenset(k for k in up if up[k] == v) for v in up.values()}

    found = []
    for few in (10**9, 0):
        monkeypatch.setattr(minhash_forest, "FEW", few)
        monkeypatch.setattr(minhash_forest, "SLAB", 100)
        found.append(groups(minhash_forest.cell_links(ids, size, comp, np.full(n, comp[0]), whole, comp != comp[0], raw)))
    plain = [(int(comp[i]), int(comp[j])) for i in range(n) for j in range(i) if minhash_forest.similar(raw[i], raw[j])]
    assert found[0] == found[1] == groups(plain) and len(found[0]) < len(set(comp.tolist()))


def test_substring(docs):
    assert table(substring_dedup.substring_dedup(docs), "n_words", "n_removed", "kept_sha256") == brute.substring(TEXTS)


@pytest.mark.parametrize("hot", [4000, 1])
def test_suffix(docs, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_REGIONS", hot)
    assert table(suffix_dedup.suffix_dedup(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffix(TEXTS)


def test_quality_rules(docs):
    got = table(quality_rules.quality_rules(docs), *quality_rules._COUNTS, "base_failed", "kept")
    for d, t in TEXTS:
        c = brute.counts(t)
        assert got[d][:5] == c
        assert got[d][5] == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        assert not (got[d][5] and got[d][6])


def test_pii(docs):
    out = pii.find_pii(docs)
    assert table(out, "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == {d: brute.pii(t) for d, t in TEXTS}
    cells = {("email", "11111"): 50, ("ssn", "11111"): 5, ("ssn", "-0-00"): 20}
    p = pii.classifier(cells, pii.reliabilities(cells))
    assert p["ssn", "11111"] > 0.9 > 0.5 > p["ssn", "-0-00"]


def test_pii_added_spans(spark):
    """Recall and precision of the wider kinds on planted spans, half of them after words that speak against them or malformed."""
    r = random.Random(9)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    good = {
        "email_spelled": lambda: f"write to mail: {r.choice('abc')}{digits(2)} [at] site{digits(1)} [dot] com now",
        "phone_local": lambda: f"call ({r.randint(201, 699)}) {r.randint(201, 699)}-{digits(4)}.",
        "ssn": lambda: f"his ssn {r.randint(100, 600)}-{r.randint(10, 99)}-{digits(4)} is",
        "secret": lambda: 'the token = "' + "".join(r.choice("0123456789abcdef") for _ in range(40)) + '" here',
    }
    bad = {
        "phone_local": lambda: f"part no 555.555.{digits(4)}x", "ssn": lambda: f"order 000-{r.randint(10, 99)}-{digits(4)}_",
        "secret": lambda: "version " + "0" * 36,
    }
    rows = [(kind, True, make()) for kind, make in good.items() for _ in range(40)] + [(kind, False, make()) for kind, make in bad.items() for _ in range(20)]
    got = {x["doc_id"]: x for x in pii.find_pii(spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(rows)], "doc_id long, text string")).collect()}
    for kind in good:
        hit = [kind in got[i]["spans"] for i, (k, ok, _) in enumerate(rows) if k == kind and ok]
        miss = [kind in got[i]["spans"] for i, (k, ok, _) in enumerate(rows) if k == kind and not ok]
        assert sum(hit) >= 0.9 * len(hit) and not any(miss), (kind, sum(hit), sum(miss))
    assert all(x["n_spans"] == x["n_email"] + x["n_ip"] + x["n_card"] + x["n_phone"] + x["n_added"] for x in got.values())


def test_pii_with_many_spans(spark):
    texts = {1: "a@b.c ssn 123-45-6789, 123-45-6789@q.r " * 300, 2: "+1 212 555 1212 4111 1111 1111 1111 1.2.3.4 " * 200, 3: "ssn 123-45-6789\n" * 129, 4: "x" * pii.BLOCK}
    got = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for d, t in texts.items():
        assert tuple(got[d][c] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256")) == brute.pii(t)
        spans = [(int(a), int(b), k) for k, a, b in (s.split(":") for s in got[d]["spans"].split(",") if s)]
        base, wide = ([s for s in spans if (s[2] in pii.KINDS) == own] for own in (True, False))
        assert got[d]["n_added"] == len(wide) and spans == sorted(spans)
        assert not any(a < q and p < b for a, b, _ in wide for p, q, _ in base)
        free = [m.start() for m in re.finditer(r"ssn (?=[0-9])", t)]
        assert [a - 4 for a, _, k in wide if k == "ssn"] == free


def test_lm(docs):
    got = table(brown_lm.lm_scores(docs), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    for d, want in brute.unigrams(TEXTS).items():
        assert got[d][:4] == want[:4] and got[d][4] == pytest.approx(want[4]) and got[d][5] < 0


def test_words_outside_the_exchange_are_clustered_by_context(spark):
    """Two kinds of words alternate, far more of them than the exchange takes."""
    r = random.Random(3)
    often = [[f"{k}{i}" for i in range(500)] for k in "ab"]
    seldom = [[f"{k}{i}" for i in range(500, 900)] for k in "ab"]
    pick = lambda k: r.choice(often[k] if r.random() < 0.85 else seldom[k])
    rows = [(d, " ".join(pick(i % 2) for i in range(200))) for d in range(400)]
    a, b = ([w for w in r.sample(x, 200)] for x in seldom)
    turns = " ".join(w for pair in zip(a, b, strict=True) for w in pair)
    runs = " ".join(w for i in range(0, 200, 2) for w in (a[i], a[i + 1], b[i], b[i + 1]))
    held = [d for d in range(1000, 1100) if zlib.crc32(str(d).encode()) % 7 == 2][:2]
    rows += list(zip(held, (turns, runs), strict=True))
    got = table(brown_lm.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)), "score")
    assert got[held[0]][0] > got[held[1]][0] + 20


def test_frequent_words_are_counted_exactly():
    """20,000 words stand three times each; one more is seen four times, once in every run of the others."""
    words = [f"w{i}" for i in range(20000)]
    texts = [" ".join([*words, "x"])] * 3 + ["x"]
    batch = pa.RecordBatch.from_pydict({"text": texts, "held_out": [False] * 4})
    got = Counter()
    for b in brown_lm._frequent([batch]):
        for word, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True):
            got[word] += n
    assert sorted(got.values()) == [3] * 20000 + [4]


def test_exchange_ends_where_no_word_moves():
    r = np.random.default_rng(4)
    pairs = r.poisson(r.gamma(0.3, 2, (201, 201))).astype(float)

    def likelihood(of):
        hot = np.eye(13)[np.append(of, 12)]
        t = hot.T @ pairs @ hot
        e = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return e(t) - e(t.sum(0)) - e(t.sum(1))

    of = brown_lm.exchange(pairs, 12)
    best = likelihood(of)
    for w in range(0, 200, 5):
        for c in range(12):
            assert likelihood(np.where(np.arange(200) == w, c, of)) <= best + 1e-6


def test_exchange_finds_alternation():
    seq = [random.Random(1).choice([0, 1, 2]) if i % 2 else random.Random(i).choice([3, 4, 5]) for i in range(4000)]
    pairs = np.zeros((7, 7))
    np.add.at(pairs, (seq[:-1], seq[1:]), 1)
    of = brown_lm.exchange(pairs, 2)
    used = [of[w] for w in sorted(set(seq)) if w < 3]
    assert len(set(used)) == 1 and all(of[w] != used[0] for w in set(seq) if w >= 3)


def test_mix(docs):
    rows, mix = source_mix.mix_sources(docs)
    taken = {r["doc_id"]: r["t"] for r in mix.groupBy("doc_id").agg(F.sum(F.col("high") - F.col("low")).alias("t")).collect()}
    per, goal, size = {}, {}, {}
    for r in rows.collect():
        t = taken.get(r["doc_id"], 0)
        assert r["size"] == len(brute.WORD.findall(dict(TEXTS)[r["doc_id"]] or "")) and t <= 3 * r["size"]
        per[r["src"]] = per.get(r["src"], 0) + t
        goal[r["src"]], size[r["src"]] = r["target"], r["source_size"]
    assert sum(goal.values()) == pytest.approx(sum(size.values()))
    assert all(abs(per[s] - goal[s]) <= 4 and goal[s] <= 3 * size[s] for s in goal)
    again = {(r["slot"], r["doc_id"], r["low"], r["high"]) for r in source_mix.mix_sources(docs)[1].collect()}
    assert again == {(r["slot"], r["doc_id"], r["low"], r["high"]) for r in mix.collect()}


def _mixed_as_in_sql(spark, rows):
    """The operator's frame over `rows`, after a comparison with its SQL."""
    import duckdb

    from tests.conftest import rows_of

    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar, lang varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", rows)
    cur = con.execute(source_mix.OP5_SQL)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    got = source_mix.source_mix(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert rows_of(got.columns, [tuple(x) for x in got.collect()]) == want
    return got


def test_mix_gives_null_ids_their_place(spark):
    r = random.Random(8)
    rows = [(i if i % 25 else None, "w " * r.randint(1, 80), f"src{i // 25}", "en") for i in range(125)]
    assert any(x["doc_id"] is None and x["taken"] for x in _mixed_as_in_sql(spark, rows).collect())


def test_mix_of_more_sources_than_cells(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "GRID", 4)
    r = random.Random(9)
    rows = [(i, "w " * r.randint(1, 40), f"src{min(i, 90):03d}", "en") for i in range(150)]  # 90 sources of a row, one of sixty
    _mixed_as_in_sql(spark, rows)


def test_suffix_without_ids(spark):
    r = random.Random(6)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage = text(700)
    rows = [(None, text(300) + passage + text(200)), (5, text(100) + passage), (None, text(900)), (None, passage[:500] + text(50)), (6, text(800))]
    want = brute.suffix([(i if d is None else d * 100, t) for i, (d, t) in enumerate(rows)])
    want = Counter((None if d < 100 else d // 100, *v) for d, v in want.items())
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter(tuple(x[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for x in got) == want


def test_pack(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(pack.tokenizer_path())
    got, room = {}, {}
    for r in pack.pack(docs).collect():
        got[r["doc_id"], r["piece"]] = (r["start"], r["length"], r["ids_crc32"])
        room.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = {}
    for d, t in TEXTS:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        at, k, end = 0, 0, len(ids) % 2048 or 2048
        while at < len(ids):
            want[d, k] = (at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes()))
            at, end, k = end, end + 2048, k + 1
    assert got == want
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(room) <= -(-sum(v[1] for v in want.values()) // 2048) + 2


def test_classifier(docs, spark):
    labels = spark.createDataFrame([(d, int((t or "").count(" ") > 100), None) for d, t in TEXTS] + [(10**9, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = table(quality_classifier.quality_scores(docs, labels), "held_out", "score", "predicted")
    for d, _ in TEXTS:
        held, score, predicted = got[d]
        assert held == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= score <= 1 and predicted == int(score >= 0.5)
    assert np.mean([got[d][2] == int((t or "").count(" ") > 100) for d, t in TEXTS]) > 0.8


def test_every_word_has_its_own_vector(spark):
    """20,000 words, each between the same two: the sum of its random vectors is the context vector of just that pair."""
    texts = [(i, f"left{i % 50} w{i} right{i % 50}") for i in range(20000)]
    got = table(quality_classifier.pooled(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)), "features")
    v = {}
    for _, text in texts[:50]:
        data = np.frombuffer(text.encode(), np.uint8)
        _, word, _ = quality_classifier._tokens(data, np.array([0, len(data)]))
        for w, key in zip(text.split(), word, strict=True):
            v[w] = np.zeros(quality_classifier.DIM)
            for nonzero in range(2):
                h = int(quality_classifier.mix(np.array([key]) + np.uint64(nonzero + 1))[0])
                v[w][h % quality_classifier.DIM] += 1 if h >> 63 else -1
    for i in range(50):
        between = v[f"left{i}"] + v[f"right{i}"]
        want = between / max(np.linalg.norm(between), 1e-9)
        same = [np.frombuffer(got[j][0], "<f4")[: quality_classifier.DIM] * 3 for j in range(i, 20000, 50)]
        sides = [x - want for x in same]  # what the two frequent words give, alike in all these texts
        assert np.abs(np.array(sides) - sides[0]).max() < 1e-4


ALL = [
    exact_dedup.exact_dedup, minhash_forest.minhash_dedup, substring_dedup.substring_dedup, suffix_dedup.suffix_dedup, quality_rules.quality_rules,
    pii.find_pii, brown_lm.lm_scores, pack.pack, lambda d: source_mix.mix_sources(d)[0],
    lambda d: quality_classifier.quality_scores(d, d.sparkSession.createDataFrame([], "doc_id long, quality int, toxic int")),
]


@pytest.mark.parametrize("op", ALL)
def test_empty_table_and_null_ids(op, spark):
    assert op(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = [(None, "a b c d e f " * 100, None, None), (None, None, "s", "en"), (7, "a b c d e f " * 100, "s", "en"), (7, "a b c d e f " * 100, "s", "en"), (8, "", None, None)]
    assert op(spark.createDataFrame(odd, SCHEMA)).count() == len(odd)


def test_pipeline(docs, spark):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
    assert corpus_pipeline.packing(spark, docs, "").count() >= len(TEXTS)


def test_pipeline_rows(docs, spark):
    """run() on documents of which some repeat, against the plain versions of the stages one after another. The verdicts of
    the quality rules come from the operator, which has no plain version of its distance."""
    import duckdb
    from tokenizers import Tokenizer

    import corpus_pipeline

    rows = [(d, t, s, lang) for d, t, s, lang in ROWS] + [ROWS[60], ROWS[60], (None, "no id " * 60, "src1", "en")]
    table_dir = spark.conf.get("spark.checkpoint.dir") + "/pipeline-rows"
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{table_dir}/documents.parquet")
    good = {r["doc_id"] for r in quality_rules.quality_rules(spark.createDataFrame(rows, SCHEMA)).filter("kept").collect()} - {None}
    left = [r for r in rows if r[0] in good]
    for plain in (brute.exact, brute.near):
        verdict = plain(sorted({(d, t) for d, t, _, _ in left}))
        left = [r for r in left if verdict[r[0]][2]]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar, lang varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", left)
    taken, size = Counter(), Counter()
    for d, n, t in con.execute(f"select doc_id, size, taken from ({source_mix.OP5_SQL})").fetchall():
        taken[d] += t
        size[d] += n
    left = [r for r in left for _ in range(int(taken[r[0]] / size[r[0]] + 0.5))]
    assert any(n == 3 for n in Counter(left).values()) or len(set(left)) > 20
    tok = Tokenizer.from_file(pack.tokenizer_path())
    want = Counter()
    for d, t, _, _ in left:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        at, k, end = 0, 0, len(ids) % 2048 or 2048
        while at < len(ids):
            want[d, k, at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes())] += 1
            at, end, k = end, end + 2048, k + 1
    got = corpus_pipeline.run(spark, table_dir).collect()
    assert Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got) == want


def test_pipeline_stages_on_empty_tables(spark):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], SCHEMA), "").count() == 0, name


def test_mixing_of_repeated_rows(spark):
    import corpus_pipeline

    rows = [(i, f"{i} " * 40, "s", "en") for i in range(30)]
    rows += [(7, rows[7][1], "s", "en")] * 3 + [(8, "other text " * 30, "s", "en")]
    got = Counter(tuple(r) for r in corpus_pipeline.mixing(spark, spark.createDataFrame(rows, SCHEMA), "").collect())
    assert got == Counter(rows)  # one source, which is taken once


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 150), (5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 61)) and got[150] == got[200] == 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=50))
def test_suffix_order(x):
    text = np.array([*x, 0], np.uint8)
    order = suffix_sort.suffix_array(text, 64)
    raw = text.tobytes() + b"\0" * 80
    keys = [raw[i : i + 64] for i in order]
    assert sorted(order) == list(range(len(text))) and keys == sorted(keys)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab Z9'é\n\t,!stremvld ", max_size=30), min_size=1, max_size=4))
def test_tokens(texts):
    enc = tokens.encoder(pack.tokenizer_path())
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    got = enc.encode(np.frombuffer(b"".join(raw), np.uint8), off)
    assert [g.tolist() for g in got] == [enc.whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_buckets_grow_with_the_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, f"text {i} " * 9) for i in range(2000)], "doc_id long, text string").repartition(3).write.parquet(path)
    table, least = spark.read.parquet(path), common.n_parts(spark)
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.startswith("part"))
    assert common.n_buckets(table) == common.n_buckets(spark.createDataFrame([], SCHEMA)) == least
    monkeypatch.setattr(common, "BUCKET_BYTES", size // 50)
    assert 50 <= common.n_buckets(table.select("text")) <= 51
    assert common.n_buckets(spark.createDataFrame([(1, "a")], "doc_id long, text string").select("text")) == least


def test_classifier_stops_where_blocks_differ():
    """Answers that meet no texts, or texts that meet no answers, are an error and not a wrong score."""
    data = np.frombuffer(b"a b c", np.uint8)
    rows, off = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64())}), np.array([0, 5])
    out = []
    for texts in (True, False):
        block = quality_classifier._Block()
        block.add(rows, *quality_classifier._tokens(data, off))
        out.append(pa.Table.from_batches([block.rows(0, 0, 1, texts)]))
    head, mail = out
    answer = quality_classifier._add_up(mail)
    both = pa.concat_tables([head, answer], promote_options="default")
    assert quality_classifier._pool(both).column("doc_id").to_pylist() == [1]
    with pytest.raises(IndexError):
        quality_classifier._pool(both.slice(0, 1))
    with pytest.raises(RuntimeError):
        quality_classifier._pool(both.slice(1))
