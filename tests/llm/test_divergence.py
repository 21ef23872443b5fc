"""Source divergence audit (13) against plain Python."""

import collections
import random
import re

import pyarrow as pa
import pytest

from lapmart.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ONE = 10**9


def brute(rows, least_docs=3, top=200):
    by_lang = collections.defaultdict(list)
    for lang, source, text in rows:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]
        by_lang[lang or ""].append((source or "", collections.Counter(words)))
    out = []
    for lang, docs in by_lang.items():
        seen = collections.Counter(w for _, c in docs for w in c)
        kept = sorted(w for w, n in seen.items() if n >= least_docs)
        count = collections.defaultdict(collections.Counter)
        for s, c in docs:
            count[s].update({w: c[w] for w in kept if c[w]})
        count = {s: count[s] for s, _ in docs}
        everything = sum(count.values(), collections.Counter())

        def shares(c, kept=kept):
            n = sum(c.values()) + len(kept)
            return {w: 1 + ONE * (c[w] + 1) // n for w in kept}
        p, q = {s: shares(c) for s, c in count.items()}, shares(everything)
        for s in count:
            pairs = [(-sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o.encode(), o) for o in count if o != s]
            terms = [(-((p[s][w] - q[w]) ** 2 // q[w]), w.encode(), w) for w in kept if count[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gam", "ñandú", "Épée", "\U00010400x", "ﬁ", "the", *(f"w{chr(97 + i)}{chr(97 + j)}"
             for i in range(12) for j in range(12))]
    rows = []
    for _ in range(160):
        lang, source = rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["a", "a", "b", "ß", None, "c"])
        k = rng.randrange(60)
        rows.append((lang, source, " ".join(rng.choice(words) + rng.choice(["", ", ", "9", "\n"]) for _ in range(k))))
    return rows + [("en", "silent", None), ("en", "a", ""), ("one", "x", "t t t"), ("none", "x", "rare"),
                   ("none", "y", None), rows[0], rows[0]]


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    df = df.selectExpr("*", "'clash' AS digest", "1 AS n", "2 AS p", "3 AS v", "4 AS term", "5 AS total", "6 AS first")
    return sorted(map(tuple, divergence.audit(df, **options).collect()))


@pytest.mark.parametrize("bits", [63, 4])
def test_audit_is_that_of_plain_python(spark, bits, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 64)
    rows = corpus(bits)
    assert got(spark, rows, bits=bits) == brute(rows)


def test_ties_at_the_last_rank_go_by_bytes(spark):
    words = " ".join(["zeta", "eta", "été", "ÿ", "￮", "\U00010400", "beta"])
    rows = [("en", "a", words)] * 3 + [("en", "b", "other words here")] * 3
    assert got(spark, rows, top=4) == brute(rows, top=4)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_a_long_text_counts_as_one_document():
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(700_000))
    held = divergence._Counts(63, False)
    held.add(["en", "en"], ["a", "a"], pa.array(["x", text]))
    out = held.batch().to_pydict()
    assert sum(out["n"]) == 700_001 and set(out["docs"]) == {1} and len(out["n"]) == 677


def test_shares_are_exact(spark):
    cases = [(1, 1), (1, 3), (2**52, 2**53 - 1), (8_999_999_999_999_998, 8_999_999_999_999_999), (7, 10**15)]
    df = spark.createDataFrame(cases, "c long, of long")
    from pyspark.sql import functions as F
    for c, of, p in df.select("c", "of", divergence._share(F.col("c"), F.col("of"))).collect():
        assert p == 1 + ONE * c // of
