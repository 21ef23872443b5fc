"""Periodic runs (11) against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapmart.llm import periodic


def brute_runs(x):
    n, out = len(x), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, q, length) for (s, length), q in out.items())


def found_runs(texts):
    sizes = np.array([len(t) for t in texts], np.int64)
    x = np.array([v for j, t in enumerate(texts) for v in [*t, 10**6 + j]], np.int64)
    start, length, period = periodic.find_runs(x, sizes)
    return list(zip(start.tolist(), period.tolist(), length.tolist()))


def wanted_runs(texts):
    out, at = [], 0
    for t in texts:
        out += [(s + at, q, length) for s, q, length in brute_runs(t)]
        at += len(t) + 1
    return sorted(out)


def sequences(rng):
    n, a = rng.randrange(1, 450), rng.choice([2, 3, 10, 1000])
    noise = [rng.randrange(a) for _ in range(n)]
    block = [rng.randrange(a) for _ in range(rng.randrange(1, 130))]
    fibonacci, morse, before = [0, 1], [0], [0]
    while len(fibonacci) < n:
        before, fibonacci = fibonacci, fibonacci + before
    while len(morse) < n:
        morse = morse + [1 - v for v in morse]
    b = [0, 1] * rng.randrange(5, 40) + [0]
    c = [0, 1, 1] * rng.randrange(5, 40) + [0, 1][:rng.randrange(3)]
    touching = [v for _ in range(rng.randrange(1, 7)) for v in rng.choice([b, b, c])]
    spaced = [v for _ in range(9) for v in [0] * rng.choice([30, 40, 41]) + [1]]
    return [noise, noise[:20] + block * rng.randrange(1, 6) + block[:3], fibonacci[:n], morse[:n], touching, spaced, []]


@pytest.mark.parametrize("seed", range(12))
def test_runs_are_those_of_brute_force(seed):
    rng = random.Random(seed)
    texts = sequences(rng)
    rng.shuffle(texts)
    assert found_runs(texts) == wanted_runs(texts)


def test_failed_hashes_are_noticed(monkeypatch):
    monkeypatch.setattr(periodic, "mix64", lambda x: np.ones(len(x), np.uint64))
    rng = random.Random(5)
    block = [rng.randrange(50) for _ in range(40)]
    texts = [block * 3, [rng.randrange(50) for _ in range(90)]]
    assert set(wanted_runs(texts)) >= set(found_runs(texts))


def test_a_long_text_of_one_word_or_block():
    assert found_runs([[7] * 400_000]) == [(0, 1, 400_000)]
    runs = found_runs([([0] * 999 + [1]) * 300])
    assert (0, 1000, 300_000) in runs and len(runs) == 301


SPACE = re.compile("[^\x20\x09-\x0d]+")


def brute_row(doc_id, text):
    words = SPACE.findall(text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words) if len(words) < 5000 else [(0, 1, len(words))]  # the fixture's long texts are one word
    top = max(runs, key=lambda r: (r[2], -r[0], -r[1]), default=None)
    drop = {i for s, q, length in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
    return doc_id, len(runs), *best, sha(lines), sha(kept)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_rows(spark, docs, documents):
    rng = random.Random(3)
    more = [(i, " ".join(rng.choice("ab cd e f".split()) for _ in range(rng.randrange(90)))) for i in range(100, 160)]
    more += [(200, "x y z\n" * 9), (201, " \t\x0b\x0c\r "), (202, "a " * 11), (203, "a " * 12)]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    both = docs.unionByName(extra, allowMissingColumns=True)
    changed = both.withColumn("text", periodic.planted(F.col("doc_id"), F.col("text")))
    got = periodic.digest(periodic.collapse(changed))
    assert rows(got) == sorted((brute_row(*r) for r in [*documents, *more]), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in more)


def test_collapse(spark, docs, no_docs):
    df = spark.createDataFrame([(1, "s " + "a b c " * 5 + "t"), (2, None)], "doc_id int, text string")
    got = {r["doc_id"]: r for r in periodic.collapse(df).collect()}
    assert got[1]["collapsed"] == "s a b c t" and [tuple(r) for r in got[1]["runs"]] == [(1, 15, 3)]
    assert got[2]["collapsed"] == "" and got[2]["n_words"] == 0 and got[2]["runs"] == []
    assert periodic.digest(periodic.collapse(no_docs)).count() == 0
