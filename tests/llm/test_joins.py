"""Similarity joins (1, 10), components, archives (7), classifier (3) and the pipeline against plain Python."""

import gzip
import hashlib
import math
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from lapmart.llm import common, ego, quality, setjoin, warc
from pyspark.sql import functions as F


def roots(nodes, links):
    at = {n: n for n in nodes}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["random", "chain", "star"])
def test_components(spark, kind):
    rng = random.Random(1)
    links = {"random": [(rng.randrange(200), rng.randrange(200)) for _ in range(130)],
             "chain": [(i, i + 1) for i in range(60)], "star": [(500, i) for i in range(100)] + [(100, 600), (700, 701)]}[kind]
    df = spark.createDataFrame([*links, (3, 3), (None, 4)], "a long, b long")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in common.components(df).collect()} == roots(nodes, links)


def test_components_of_nothing(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_vectors(rows, t):
    ok = [i for i, (v, e, label) in enumerate(rows)
          if v is not None and label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in ok}
    pairs = [(i, j) for n, i in enumerate(ok) for j in ok[n + 1:]
             if rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and unit[i] @ unit[j] >= t]
    degree = [sum(k in p for p in pairs) for k in range(len(rows))]
    root = roots({r[0] for r in rows if r[0] is not None}, [(rows[i][0], rows[j][0]) for i, j in pairs])
    return sorted(str((v, degree[i], root.get(v), v is not None and v == root[v])) for i, (v, _, _) in enumerate(rows))


@pytest.mark.parametrize("kind,block", [("float", 256), ("double", 4)])
def test_embedding_near_duplicates(spark, monkeypatch, kind, block):
    monkeypatch.setattr(ego, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):  # groups around the threshold, and copies of one vector
        centre = rng.normal(size=10)
        for _ in range(9):
            rows.append((len(rows), (centre + rng.normal(size=10) * 0.12).tolist(), int(c % 3)))
    hot = rng.normal(size=10).tolist()
    rows += [(len(rows) + i, hot, 1) for i in range(40)]
    rows += [(1000, rows[0][1], 2), (1001, None, 0), (1002, [0.0] * 10, 0), (1003, [math.nan] * 10, 0), (1006, [], 0),
             (1004, [None] + [1.0] * 9, 0), (1005, rows[0][1], None), (None, rows[0][1], 0), (1007, [1.0, 0.0], 0),
             (1008, [2.0, 0.0], 0), (1009, [1e-30, 0.0], 0), (1010, [math.inf] + [1.0] * 9, 0), (0, rows[0][1], 0)]
    if kind == "float":
        rows = [(v, e and [None if x is None else float(np.float32(x)) for x in e], label) for v, e, label in rows]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(4)
    df = df.selectExpr("*", "1 AS links", "2 AS vec", "3 AS dim")
    got = ego.near_duplicates(df, 0.98).collect()
    assert sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in got) == brute_vectors(rows, 0.98)
    assert ego.near_duplicates(df.where("false")).count() == 0
    assert ego.near_duplicates(df.where("vec_id = 1001")).first() == (1001, 0, 1001, True)


def shingles(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_jaccard(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and None not in (rows[i][0], rows[j][0]) and len(sets[i] & sets[j]) * den >= len(sets[i] | sets[j]) * num]
    root = roots({d for d, _ in rows if d is not None}, links)
    return sorted(str((d, len(s), root.get(d))) for (d, _), s in zip(rows, sets))


def family(rng, n, size, changes):
    """Near copies of one text, some of which link only through others."""
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(size)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(changes + 1)):
            t[rng.randrange(len(t))] = rng.choice(words)
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("k,num,den,block", [(3, 90, 100, 128), (3, 90, 100, 3), (5, 80, 100, 128), (1, 50, 100, 4)])
def test_jaccard_join(spark, documents, monkeypatch, k, num, den, block):
    monkeypatch.setattr(setjoin, "BLOCK", block)
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(40))  # that many different texts share
    rows = [(d, t) for d, t in documents if len(t or "") < 10_000]
    for n, size, changes in ((30, 120, 6), (12, 60, 4), (8, 12, 1), (25, 300, 14), (6, 4, 1)):
        rows += [(100 + len(rows), t) for t in family(rng, n, size, changes)]
    rows += [(1000 + i, passage + " " + " ".join(f"q{rng.randrange(900)}" for _ in range(rng.randrange(2, 60))))
             for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    df = df.selectExpr("*", "1 AS n", "2 AS token", "3 AS component", "4 AS doc", "5 AS _s")
    got = sorted(str(tuple(r)) for r in setjoin.jaccard_components(df, k, num, den).collect())
    assert got == brute_jaccard(rows, k, num, den)


@pytest.mark.parametrize("best", [True, False])
def test_blocks_are_dealt_without_copies_of_lists(spark, monkeypatch, best):
    for module in (common, setjoin):
        monkeypatch.setattr(module, "FEW_BYTES", -1)
    monkeypatch.setattr(setjoin, "LONG_LISTS", 5)
    monkeypatch.setattr(setjoin, "BLOCK", 3)
    rows = [(a, t) for a, t in enumerate(family(random.Random(3), 40, 60, 30))]
    sets = setjoin.whole_sets(spark.createDataFrame(rows, "doc_id long, text string"), 3, False)
    # token 0 in all documents, and each other one in two
    index = common.written(spark.range(40).selectExpr(
        "id AS doc", "58L AS n", "explode(array(0L, 1 + id div 2)) AS token", "1L AS pos"), "index")
    pairs = setjoin.cross_pairs(index, sets, None, 1, 100, best)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1  # the rows' places: no list stands there once a salt or a branch
    got = {tuple(r) for r in pairs.collect()}
    assert all(a < b for a, b in got) and (best or got == {(a, b) for b in range(40) for a in range(b)})
    lists = common.written(spark.range(21).selectExpr("id AS token", "if(id = 0, 40L, 2L) AS all"), "lists")
    joined = setjoin.list_join(index, lists)
    assert sorted(map(tuple, joined.select("doc", "token", "all").collect())) == sorted(
        (d, t, n) for d in range(40) for t, n in ((0, 40), (1 + d // 2, 2)) if t < 21)


def test_jaccard_join_of_long_texts_and_nothing(docs, no_docs):
    got = setjoin.jaccard_components(docs.where("doc_id IN (0, 10)"), 3, 90, 100).collect()
    assert sorted(map(tuple, got)) == [(0, 0, 0), (10, 1, 10), (10, 1, 10)]
    assert setjoin.jaccard_components(no_docs, 3, 90, 100).count() == 0


PAGES = [(0, "http://a/", "x" * 1000), (1, "http://b/ é\r\nX: y", "x" * 1000), (5, None, "x" * 1000), (2, "c", "short"),
         (3, "d", "short"), (4, "e", None), (6, "f", ""), (None, "g", "x" * 1000), (7, "h", "é" * 500), (8, "i", "é" * 500),
         (7, "h", "é" * 500), (9, "j", "a\r\n\r\nWARC/1.1\r\n" * 300_000), (10, "k", "y" * 999), (11, "l", "y" * 999)]


def brute_pages():
    data = [(p, (h or "").encode()) for p, _, h in PAGES]
    out = []
    for p, b in data:
        same = [q for q, x in data if x == b and q is not None] if len(b) >= 1000 else []
        top = max(same) if len([1 for _, x in data if x == b]) > 1 and same else None
        revisit = top is not None and p != top
        out.append(str((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", top if revisit else None)))
    return sorted(out)


@pytest.mark.parametrize("roll", [1 << 30, 1000])
def test_archives(spark, tmp_path, monkeypatch, roll):
    monkeypatch.setattr(warc, "ROLL_BYTES", roll)
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    df = df.selectExpr("*", "1 AS file", "2 AS offset", "3 AS response", "4 AS record_type")
    index = warc.write_archives(df, str(tmp_path / "warc"))
    got = warc.read_records(index).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == brute_pages()
    texts = {(p, h or "") for p, _, h in PAGES}
    assert all((r.page_id, r.html) in texts for r in got if r.record_type == "response")
    # any gzip reader finds whole records
    for f in tmp_path.glob("warc/*.gz"):
        assert gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n")
    # a selection reads its own records alone
    some = warc.read_records(index.where("page_id IN (2, 9)")).collect()
    assert sorted(r.page_id for r in some) == [2, 9]
    assert warc.archive(df.where("false")).count() == 0


def test_ranges_are_joined_over_small_gaps(spark):
    rows = [("f", 0, 10), ("f", 10, 5), ("f", 100, 5), ("f", 5000, 7), ("g", 3, 4)]
    got = warc.coalesce_ranges(spark.createDataFrame(rows, "file string, offset long, length long"), gap=90, most=4000)
    assert sorted((r.file, r.lo, r.hi, len(r.records)) for r in got.collect()) == [
        ("f", 0, 105, 3), ("f", 5000, 5007, 1), ("g", 3, 7, 1)]


def corpus(rng, n):
    rows, labels = [], []
    words = [a + b for a in "bcdfgl" for b in ("an", "er", "ing", "ot", "ul", "em")]
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(30, 200))]
        kind = rng.choice(["good"] * 6 + ["toxic", "shout", "repeat"])
        if kind == "toxic":
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["nasty", "awful", "vilest"])
        if kind == "shout":
            w = [x.upper() + "!!" for x in w]
        if kind == "repeat":
            w = [x for x in w[:8] for _ in range(12)]
        rows.append((i, " ".join(w), rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None]), len(" ".join(w))))
        labels.append((i, int(kind in ("good", "toxic")), int(kind == "toxic")))
    return rows, labels


def test_classifier(spark):
    rows, labels = corpus(random.Random(8), 900)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 AS low", "2 AS host", "3 AS path", "4 AS _key").repartition(4)
    some = spark.createDataFrame([x for x in labels if x[0] % 3] + [(None, 0, 1), (0, None, None), (4, 0, 1), (4, 0, 1)],
                                 "doc_id long, quality int, toxic int")
    sites = F.col("source"), F.col("lang")
    got = {r.doc_id: r for r in quality.classify(docs, some, *sites).collect()}
    held = [x for x in labels if x[0] % 3 == 0]
    right = sum(got[i].keep == (q == 1 and t == 0) for i, q, t in held)
    assert len(got) == 900 and right >= 0.97 * len(held)
    # posteriors of sites lie between their own rates and the global one
    assert all(0 < r.path_low < 1 and 0 < r.host_toxic < 1 for r in got.values())
    kept = quality.keep_good(docs, some, *sites)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.keep)


def test_sparse_sites_are_shrunk(spark):
    rng = random.Random(3)
    rows = [("big", "p", float(rng.random() < 0.5)) for _ in range(400)] + [("small", "p", 1.0)]
    rows += [(f"h{i % 20}", "p", float(rng.random() < 0.1 + 0.02 * (i % 20))) for i in range(2000)]
    df = spark.createDataFrame(rows, "host string, path string, y_low double")
    got = {r.host: r for r in quality.site_posteriors(df, "low")[0].collect()}
    overall = sum(r[2] for r in rows) / len(rows)
    assert abs(got["small"].host_low - overall) < 0.5 * (1 - overall)
    rate = sum(y for h, _, y in rows if h == "big") / 400
    assert abs(got["big"].host_low - rate) < 0.05


@pytest.mark.parametrize("none", ["documents", "labels", "texts"])
def test_classifier_of_little(spark, none):
    docs = spark.createDataFrame([(0, None), (1, ""), (None, "x"), (2, "y " * 900_000), (2, "z"), (2, "z")],
                                 "doc_id long, text string").selectExpr("*", "'s' AS source", "string(null) AS lang")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    docs = docs.where("false") if none == "documents" else docs.where("text IS NULL") if none == "texts" else docs
    labels = labels.where("false") if none == "labels" else labels
    assert quality.classify(docs, labels, F.col("source"), F.col("lang")).count() == docs.count()


def test_pipeline(spark, tmp_path):
    rng = random.Random(21)
    rows, labels = corpus(rng, 400)
    good = [i for i, q, t in labels if q and not t]
    extra = [(1000, rows[good[0]][1]), (1001, rows[good[0]][1] + " tail"), (1002, "bench " + " ".join(f"b{i}" for i in range(15))),
             (1003, rows[good[1]][1] + " password=abcdef123456")]
    rows += [(i, t, "en", "a", len(t)) for i, t in extra]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, " ".join(f"b{i}" for i in range(15)))], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet")
    docs = common.table(spark, path, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, path), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    first = seen["quality_classifier"]
    assert len(set(good) - first.keys()) <= 2 and {1000, 1001, 1002, 1003} <= first.keys()
    assert first.keys() - seen["near_duplicates"].keys() >= {1000, 1001}
    assert seen["near_duplicates"].keys() - seen["decontamination"].keys() == {1002}
    assert all("abcdef123456" not in t for t in seen["secret_scan"].values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    assert {r.doc_id for r in pieces.collect()} == seen["secret_scan"].keys()
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, path).count() == 0


A, B, C = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")


def test_documents_of_several_texts_link_by_all_of_them(spark):
    rows = [(1, A), (2, A), (2, B), (3, B), (4, C), (4, C), (5, None), (5, C), (None, A), (6, "solo words stand alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 AS unit", "2 AS c")
    got = sorted(map(tuple, setjoin.jaccard_components(df, 3, 90, 100).collect()), key=str)
    want = [(1, 28, 1), (2, 28, 1), (2, 28, 1), (3, 28, 1), (4, 28, 4), (4, 28, 4), (5, 0, 4), (5, 28, 4), (None, 28, None),
            (6, 2, 6)]
    assert got == sorted(want, key=str)


def test_near_duplicates_loses_no_text(spark):
    rows = [(1, A, "x"), (2, A, "x"), (2, B, "y"), (3, B, "y"), (None, A, "z"), (None, A, "z"), (7, None, "n"), (7, None, "n"),
            (8, "", "e"), (9, C, "r"), (9, C, "r"), (None, "only here", "o"), (10, "only here and there", "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").selectExpr("*", "1 AS _key", "2 AS c")
    got = sorted(map(tuple, corpus_pipeline.near_duplicates(spark, df, "").select("doc_id", "text").collect()), key=str)
    want = [(1, A), (2, B), (7, None), (7, None), (8, ""), (9, C), (None, "only here"), (10, "only here and there")]
    assert got == sorted(want, key=str)
    assert corpus_pipeline.near_duplicates(spark, df.where("false"), "").count() == 0


@pytest.mark.parametrize("few", [1 << 20, -1])
def test_spread_join(spark, few, monkeypatch):
    from lapmart.llm import common

    monkeypatch.setattr(common, "FEW_BYTES", few)
    large = spark.range(400).selectExpr("id", "if(id % 2 = 0, 7, id) AS k")
    small = spark.range(100).selectExpr("id AS k", "id * 2 AS v")
    for how in ("inner", "left"):
        got = common.spread_join(large, small, ["k"], "id", 8, how)
        assert sorted(map(tuple, got.select("id", "v").collect()), key=str) == sorted(
            map(tuple, large.join(small, "k", how).select("id", "v").collect()), key=str)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (few > 0)
