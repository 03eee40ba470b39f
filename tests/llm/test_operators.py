"""Operators against brute force on small fixtures, and their edge cases."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablekit.llm import base, langid, lm_score, ngram_jaccard, queries, toxicity
from tablekit.llm.decontaminate import contaminated, lcs_cover
from tablekit.llm.embedding_dedup import embedding_links
from tablekit.llm.ngram_jaccard import jaccard_components
from tablekit.llm.pack import pack
from tablekit.llm.token_file import read_tokens, write_tokens
from tablekit.llm.url_filter import filter_urls
from tablekit.llm.warc import parse, read_archive, read_records, write_archive
from tablekit.session import scratch_path

from test_near_copies import brute as near_copies_brute

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * 7919 % 5000}" for i in range(30_000))


def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    same = " ".join(f"common{i}" for i in range(60))
    rows = [(1, same, "en", "a", 1), (2, same, "en", "a", 1), (2, same, "en", "a", 1), (3, None, None, None, None),
            (4, "", "en", None, 0), (5, " \n\t", "en", "a", 3), (6, LONG, "en", "a", 9), (7, LONG + " end", None, "b", 9),
            (8, "one", "de", "b", 3), (9, "one", "de", "b", 3), (10, "!!! ???", "de", "b", 7),
            (11, same.replace("common5 ", "other "), "en", "a", 1), (None, "text without an id", "en", "a", 1)]
    return spark.createDataFrame(rows, DOC).selectExpr(
        "*", "doc_id AS id", "'x' AS score", "1.5 AS rep", "'y' AS component_id", "'z' AS `key`", "true AS rejected",
        "7 AS predicted", "'q' AS held_out", "0 AS n")


def components(links, ids):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingle_set(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def jaccard_brute(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    comp = components(links, sets)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def test_connected_components(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + \
            [tuple(map(int, e)) for e in rng.integers(200, 300, (60, 2))]
    got = {r[0]: r[1] for r in base.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {x for a, b in edges if a != b for x in (a, b)}
    assert got == components(edges, ids)
    assert base.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_edges(spark):
    docs = edge_docs(spark)
    got = jaccard_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    rows = [tuple(r) for r in got.collect()]
    want = jaccard_brute([(r[0], r[1]) for r in docs.where("doc_id is not null").collect()])
    assert len(rows) == 12 and {r[0]: r[1:] for r in rows} == want
    assert jaccard_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [1024, 5])
def test_jaccard_near_copies(spark, monkeypatch, tile):
    """Families with chains of links around the threshold, sizes from 1 word to 400."""
    monkeypatch.setattr(ngram_jaccard, "TILE", tile)
    rng = np.random.default_rng(8)
    rows, ident = [], 0
    for size in (1, 2, 3, 4, 11, 12, 21, 40, 90, 400):
        words = [f"w{rng.integers(0, 10**6)}" for _ in range(size)]
        for _ in range(14):
            rows.append((ident, " ".join(words)))
            ident += 1
            words = list(words)
            for _ in range(int(rng.integers(0, 1 + max(1, size // 60)))):
                words[rng.integers(0, len(words))] = f"v{rng.integers(0, 10**6)}"
            if rng.random() < 0.3:
                words.append(f"u{rng.integers(0, 10**6)}")
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == jaccard_brute(rows)


def test_embeddings(spark):
    rng = np.random.default_rng(4)
    base_v = rng.normal(size=(12, 8))
    rows = [(i, [float(x) for x in base_v[i % 12] + rng.normal(size=8) * (0.02 if i % 5 else 0.35)], 1) for i in range(150)]
    rows += [(200, None, 1), (201, [], 1), (202, [0.0] * 8, 1), (203, [float("nan")] * 8, 1),
             (204, [float("inf")] + [1.0] * 7, 1), (205, [None] + [1.0] * 7, 1), (206, [1.0, 2.0], 1), (207, [2.0, 4.0], 1),
             (208, rows[0][1], 1), (209, rows[0][1], 2), (209, rows[0][1], 2), (None, rows[0][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit("x"))
    got = {r[0]: tuple(r[1:]) for r in embedding_links(df).collect()}
    v = {i: np.array(e, float) for i, e, _ in rows if i is not None}
    good = [i for i in v if v[i].size and np.isfinite(v[i]).all() and v[i].any()]
    links = [(a, b) for a, b in itertools.combinations(sorted(good), 2) if len(v[a]) == len(v[b])
             and v[a] @ v[b] / (np.sqrt(v[a] @ v[a]) * np.sqrt(v[b] @ v[b])) >= 0.9]
    comp = components(links, v)
    n = {i: sum(i in x for x in links) for i in v}
    assert got == {i: (n[i], comp[i], comp[i] == i) for i in v}
    assert embedding_links(df.limit(0)).count() == 0


def test_warc(spark):
    html = "<p>é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n</p>"
    rows = [(1, "http://a.org/", html), (2, "http://b.org/", html), (3, None, None), (4, "http://c\n.org/ x", ""),
            (5, "http://d.org/", "x" * 300_000), (6, "http://e.org/", "unique"), (6, "http://e.org/", "unique"),
            (None, "http://f.org/", "no id")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    path = scratch_path(spark, "warc-test")
    write_archive(pages, path)
    got = {r[0]: tuple(r[1:]) for r in read_archive(spark, path).collect()}
    texts, want = {i: t or "" for i, _, t in rows if i is not None}, {}
    for i, t in texts.items():
        raw = t.encode()
        first = min(j for j, u in texts.items() if u == t)
        want[i] = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                   "response" if first == i else "revisit", None if first == i else first)
    assert got == want
    bodies = {r["id"]: bytes(r["payload"]).decode() for r in read_records(spark, path).collect()}
    assert bodies == {i: (t if want[i][2] == "response" else "") for i, t in texts.items()}
    short = scratch_path(spark, "warc-test")
    write_archive(pages, short, min_bytes=1000)
    assert {r["record_type"] for r in read_archive(spark, short).collect()} == {"response"}
    empty = scratch_path(spark, "warc-test")
    write_archive(pages.limit(0), empty)
    assert read_archive(spark, empty).count() == 0
    with pytest.raises(ValueError):
        list(parse(b"HTTP/1.1 200\r\n\r\n"))


def test_decontamination(spark):
    rng = np.random.default_rng(6)
    def text(n):
        return [f"t{rng.integers(0, 4000)}" for _ in range(n)]
    items = {i: text(int(rng.integers(16, 60))) for i in range(8)}
    docs, want = [], set()
    for k in range(60):
        words = text(int(rng.integers(5, 300)))
        if k % 4 == 0:  # a whole item, every second one with some words replaced
            item = list(items[k // 4 % 8])
            if k % 8 == 0:
                for at in range(2, len(item) - 8, 6):
                    item[at] = "changed"
            cut = int(rng.integers(0, len(words)))
            words = words[:cut] + [w.upper() for w in item] + words[cut:]
            want.add((k, k // 4 % 8))
        docs.append((k, " ".join(words)))
    docs.append((60, " ".join(items[3][:6])))  # too little of an item
    df = spark.createDataFrame(docs + [(70, None), (71, ""), (None, " ".join(items[1]))], "doc_id long, text string")
    bench = spark.createDataFrame([(i, ", ".join(w)) for i, w in items.items()] + [(90, None), (91, ""), (None, "x")],
                                  "item_id long, text string")
    got = contaminated(df.withColumn("item", F.lit(1)), bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    assert contaminated(df.limit(0), bench).count() == 0 and contaminated(df, bench.limit(0)).count() == 0
    doubled = contaminated(df.unionByName(df), bench)
    assert doubled.count() == len(want)


def test_lcs():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 5, rng.integers(1, 9)), rng.integers(0, 5, rng.integers(1, 12))
        best = max(k for k in range(len(a) + 1) for c in itertools.combinations(a, k)
                   if (it := iter(b.tolist())) is not None and all(x in it for x in c))
        assert lcs_cover(a, b)[0] == pytest.approx(best / len(a))


def brute_ids(texts, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [end], "<u4") for x in texts]


def test_token_file(spark):
    docs = edge_docs(spark)
    path = scratch_path(spark, "tokens-test")
    write_tokens(docs.where("doc_id is not null"), path, queries.tokenizer_path())
    got = [tuple(r) for r in read_tokens(spark, path).orderBy("start").collect()]
    rows = sorted((r[0], r[1]) for r in docs.collect() if r[0] is not None and r[1] is not None)
    rows = sorted([*rows, (3, None)], key=lambda r: r[0])
    ids = brute_ids([t for _, t in rows], 0)
    start = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).tolist()
    assert [(i, s, n, bytes(b)) for i, s, n, b in got] == \
        [(r[0], s, len(x), x.tobytes()) for r, s, x in zip(rows, start, ids)]
    empty = scratch_path(spark, "tokens-test")
    write_tokens(docs.limit(0), empty, queries.tokenizer_path())
    assert read_tokens(spark, empty).count() == 0


def check_pack(pieces, rows):
    want = dict(zip([i for i, _ in rows], brute_ids([t for _, t in rows], 1)))
    at, sequences = {}, {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        x = want[p["doc_id"]]
        assert p["start"] == at.get(p["doc_id"], 0) and p["doc_tokens"] == len(x) and 0 < p["length"] <= 2048
        assert bytes(p["ids"]) == x[p["start"]:p["start"] + p["length"]].tobytes()
        at[p["doc_id"]] = p["start"] + p["length"]
    assert at == {i: len(x) for i, x in want.items()}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == sequences.get(p["sequence_id"], 0)
        sequences[p["sequence_id"]] = p["offset"] + p["length"]
    assert max(sequences.values()) <= 2048
    return sum(0 if n & (n - 1) == 0 else 2048 - n for n in sequences.values()) / sum(map(len, want.values()))


def test_pack(spark, monkeypatch):
    docs = edge_docs(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = [(r[0], r[1]) for r in docs.collect()]
    check_pack([r.asDict() for r in pack(docs, queries.tokenizer_path()).collect()], rows)
    assert pack(docs.limit(0), queries.tokenizer_path()).count() == 0
    real = queries.table(spark, SF, "documents").select("doc_id", "text")
    share = check_pack([r.asDict() for r in pack(real.coalesce(1), queries.tokenizer_path()).collect()],
                       [(r[0], r[1]) for r in real.collect()])
    assert share < 0.05


def test_language(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    held = base.fold("doc_id", 4) == 2
    model = langid.fit(docs.where(~held), "text", "lang", "doc_id")
    got = langid.predict(model, docs.where(held), "doc_id", "text", [F.col("lang")]).toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.98 and got["score"].between(0, 1).all()
    de, en = (docs.where(f"lang = '{x}'").first()["text"][:3000] for x in ("de", "en"))
    mixed = spark.createDataFrame([(1, de + " " + en), (2, en)], "doc_id long, text string")
    sets = {r["doc_id"]: r["n_langs"] for r in langid.predict(model, mixed, "doc_id", "text").collect()}
    assert sets[1] >= 2 and sets[2] == 1
    edge = {r["doc_id"]: r for r in langid.predict(model, edge_docs(spark), "doc_id", "text").collect()}
    assert [edge[i]["lang_pred"] for i in (3, 4, 5, 10)] == ["und"] * 4 and edge[3]["score"] == 0.0
    assert edge[1]["lang_pred"] in model.langs and len(edge) == 12
    none = langid.fit(docs.limit(0), "text", "lang", "doc_id")
    assert {r["lang_pred"] for r in langid.predict(none, edge_docs(spark), "doc_id", "text").collect()} == {"und"}
    assert langid.predict(model, docs.limit(0), "doc_id", "text").count() == 0


def test_toxicity(spark):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    model = toxicity.fit(queries.labelled(docs, labels), "text", "toxic", "lang", "doc_id")
    got = toxicity.predict(model, docs, "doc_id", "text").join(labels, "doc_id").where(base.fold("doc_id", 5) == 0).toPandas()
    rank, y = got["score"].rank(), got["toxic"] == 1
    auc = (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    assert auc > 0.8 and (got["predicted"] == (got["score"] >= 0.5)).all() and (got["predicted"][~y] == 0).mean() > 0.95
    edge = toxicity.predict(model, edge_docs(spark), "doc_id", "text").toPandas()
    assert len(edge) == 13 and edge["score"].between(0, 1).all()
    assert toxicity.fit(queries.labelled(docs, labels.where("toxic = 0")), "text", "toxic", "lang", "doc_id") is None
    assert toxicity.predict(None, docs, "doc_id", "text").where("score <> 0 or predicted <> 0").count() == 0


def test_language_model_scores(spark):
    """Losses against a direct computation of the same class bigram model."""
    background = ["a b a c", "a b", "d", "", None, "a a b c c", "zz a b"]
    target = ["a b a b", "b a b"]
    frame = lambda t: spark.createDataFrame([(x,) for x in t], "text string")
    docs = spark.createDataFrame([(1, "a b q"), (2, None), (3, ""), (4, "c c c"), (4, "c c c"), (None, "a")],
                                 "doc_id long, text string").withColumn("score", F.lit(9))
    models = lm_score.fit(frame(background), frame(target))
    got = [tuple(r) for r in lm_score.score(models, docs, "doc_id", "text").collect()]
    words = [(x or "").split() for x in background]
    vocab = sorted({w for t in words for w in t})

    def loss(corpus, text):
        counts = {w: sum(t.count(w) for t in corpus) for w in vocab}
        unknown = sum(map(len, corpus)) - sum(counts.values())
        single = {**counts, None: unknown}
        pairs = {}
        for t in corpus:
            for v, w in zip([None, *t], t):
                key = (v if v in counts else None, w if w in counts else None)
                pairs[key] = pairs.get(key, 0) + 1
        one = {w: sum(n for (_, b), n in pairs.items() if b == w) + lm_score.ALPHA for w in single}
        total = sum(one.values())
        out = 0.0
        for v, w in zip([None, *text], text):
            v, w = (x if x in counts else None for x in (v, w))
            seen = sum(n for (a, _), n in pairs.items() if a == v)
            kinds = sum(a == v for a, _ in pairs)
            p = (pairs.get((v, w), 0) + kinds * one[w] / total) / (seen + kinds) if seen else one[w] / total
            out -= np.log(p)
        return out / len(text)
    for ident, n, t, b, s in got:
        text = {1: "a b q", 4: "c c c", None: "a"}.get(ident, "").split()
        assert n == len(text)
        want = (loss([x.split() for x in target], text), loss(words, text)) if text else (0, 0)
        assert (t, b) == pytest.approx(want, rel=1e-4) and s == pytest.approx(t - b)
    assert len(got) == 6
    assert lm_score.score(lm_score.fit(frame([]), frame([])), docs, "doc_id", "text").count() == 6


def test_url_filter(spark):
    good = [f"https://news.site{i}.org/story/{i}" for i in range(200)]
    bad = [f"http://casino.win{i}.com/de/bet?x={i}" for i in range(200)]
    rows = [(i, u) for i, u in enumerate(good + bad)]
    odd = [(900, None), (901, ""), (902, "no scheme"), (903, "HTTP://Sub.ORG"), (904, "x://ORG/a?b#c"), (905, "a://b.com/de/#/fr/"),
           (906, "a://example.org/en/17"), (907, "a://example.org/en/2"), (908, "a://xorg/"), (None, "a://b.org/"),
           (909, "https://news.place.net/story/9"), (910, "http://casino.win.net/de/bet?x=1"), (911, "://org/es/://")]
    pages = spark.createDataFrame(rows + odd, "page_id long, url string").withColumn("host", F.lit("x"))
    got = {r["page_id"]: r for r in filter_urls(pages, queries.URL_RULES).collect()}
    assert len(got) == len(rows) + len(odd)
    facts = {i: (got[i]["host"], got[i]["path"], got[i]["rule"]) for i in got if i is None or i >= 900}
    assert facts[900] == facts[901] == facts[902] == ("", "", None)
    assert facts[903] == ("sub.org", "", None) and facts[904] == ("org", "/a", "org/")
    assert facts[905] == ("b.com", "/de/", "com/de/") and facts[906] == ("example.org", "/en/17", "example.org/en/1")
    assert facts[907] == ("example.org", "/en/2", "org/") and facts[908] == ("xorg", "/", None)
    assert got[906]["verdict"] == "block" and got[907]["verdict"] == "allow" and facts[911] == ("org", "/es/://", "org/")
    assert got[909]["verdict"] == "allow" and got[910]["verdict"] == "block"
    assert {r["verdict"] for r in filter_urls(pages, []).collect()} == {"allow"}
    assert filter_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_every_stage_takes_edge_rows(spark):
    docs = edge_docs(spark).selectExpr("*", "1 AS `a.b`", "'u' AS `c``d`", "2 AS __text", "3 AS __in_0", "4 AS __key")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for case in (docs, docs.limit(0)):
            out = stage(spark, case, SF)
            assert out.columns == docs.columns, name
            assert out.dtypes == docs.dtypes, name
            out.collect()
    kept = {r["doc_id"] for r in corpus_pipeline.dedup(spark, docs, SF).collect()}
    assert {1, 3, 4, 5, 6, 8, 10} <= kept and not {2, 7, 9} & kept


def test_pipeline_stages_decide(spark):
    """Stage by stage against plain Python on the rows each one was given."""
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    junk = spark.createDataFrame([(5000, "123 456 !!!", None, None, None), (5001, None, "en", None, None)], DOC)
    given = docs.unionByName(junk)
    rows = {r["doc_id"]: r["text"] for r in given.collect()}
    kept = {r[0] for r in corpus_pipeline.language(spark, given, SF).select("doc_id").collect()}
    assert kept == set(rows) - {5000, 5001}
    kept = {r[0] for r in corpus_pipeline.dedup(spark, docs, SF).select("doc_id").collect()}
    # The stage's own width and threshold, not those of the op7 query.
    want = near_copies_brute([(i, t) for i, t in rows.items() if i < 400], corpus_pipeline.DEDUP_WORDS,
                             corpus_pipeline.DEDUP_NUM, corpus_pipeline.DEDUP_DEN)
    small = docs.where("doc_id < 400")
    assert {r[0] for r in corpus_pipeline.dedup(spark, small, SF).select("doc_id").collect()} == \
        {i for i, (_, c) in want.items() if i == c}
    items = [r["text"] for r in queries.table(spark, "/root/testdata/sf0.01", "benchmark").collect()]
    leaks = {i for i, t in rows.items() if t and any(x in t for x in items)}
    clean = {r[0] for r in corpus_pipeline.decontaminate(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    assert leaks and clean == {i for i in rows if i < 5000} - leaks


def test_vectors_of_any_magnitude(spark):
    """Scaling a vector changes no cosine, whatever the size of its squares."""
    base = [[1.0, 1.0, 0.0], [2.0, 2.0, 0.1], [0.0, 1.0, -1.0]]
    rows = [(10 * k + i, [x * f for x in v]) for k, f in enumerate((1.0, 1e200, 1e-200, 1e307, 1e-310)) for i, v in enumerate(base)]
    got = {r["vec_id"]: r for r in embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    for i, r in got.items():
        assert (r["n_links"], r["component_id"]) == ((4, 2) if i % 10 == 2 else (9, 0)), i


def test_embedding_query_matches_brute_force(spark):
    e = pq.read_table(f"{SF}/embeddings.parquet").to_pandas()
    v = np.stack(e["embedding"]).astype(float)
    cos = v @ v.T / np.sqrt(np.outer((v * v).sum(1), (v * v).sum(1)))
    np.fill_diagonal(cos, 0)
    n = dict(zip(e["vec_id"], (cos >= 0.9).sum(1)))
    got = queries.REGISTRY["op1_embedding_dedup"](spark, SF).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == n


CONTRACT = {
    "op1_embedding_dedup": {"vec_id", "n_links", "component_id", "kept"}, "op2_decontaminate": {"doc_id", "item_id"},
    "op3_token_file": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op4_pack": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op5_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op6_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op7_ngram_jaccard": {"doc_id", "n_shingles", "component_id"},
    "op8_warc_revisit": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op9_lm_score": {"doc_id", "score"}, "op10_langid": {"doc_id", "held_out", "lang_pred", "score"},
    "op11_token_align": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
    "op12_chat_format": {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
    "op13_merkle_manifest": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"}}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_query_runs_over_the_whole_table(spark, name):
    out = queries.REGISTRY[name](spark, SF)
    assert CONTRACT[name] <= set(out.columns)
    rows = out.toPandas()
    key = rows.columns[0]
    if name not in ("op2_decontaminate", "op4_pack", "op12_chat_format"):
        source = {"vec_id": "embeddings", "page_id": "pages"}.get(key, "documents")
        assert sorted(rows[key]) == sorted(r[0] for r in queries.table(spark, SF, source).select(key).collect())
    if "held_out" in rows:
        fold = {"op5_toxicity": (5, 0), "op10_langid": (4, 2)}[name]
        assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % fold[0] == fold[1] for i in rows["doc_id"]]).all()
