"""Personal data (12): base spans against plain patterns, the field against brute force and held-out texts."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lapmart.llm import personal

# the contract's patterns
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
PASSAGES = ("the house of thor and the onion, reads well; nothing else is here", "der Bericht von gestern war lang",
            "une phrase de plus, et puis voilà", "la casa de los libros. y otra cosa")


def plain_base(text):
    out = [("email", m) for m in EMAIL.finditer(text)]
    out += [("ip", m) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted((k, m.start(), m.end()) for k, m in out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(4)
    for _ in range(3000):
        n = rng.randrange(60)
        text = "".join(rng.choice(rng.choice(["0123456789", "+() .-", "a@.b-%", "é☎ \n１"])) for _ in range(n))
        if rng.random() < 0.5:
            text += personal.example(rng, PASSAGES)[0]
        if rng.random() < 0.3:
            text += "".join(rng.choice(["1.2", ".", "255", "256.", "0001", "a@b", ".c", "@", "+1 ", "()"]) for _ in range(12))
        assert sorted(personal.base_spans(text)) == plain_base(text), text


def test_base_spans_take_linear_time():
    for text in ("9" * 400_000, "9." * 200_000, "a" * 400_000 + "@", "a@" * 200_000, "+1" + "(" * 400_000, "1 " * 200_000):
        personal.search(text, {})


def paths(group):
    """All sets of candidates that don't overlap, in order."""
    for r in range(len(group) + 1):
        for chosen in itertools.combinations(range(len(group)), r):
            spans = [group[i] for i in chosen]
            if all(x[1] <= y[0] for x, y in zip(spans, spans[1:])):
                yield chosen


def path_weight(group, chosen, weights, margin):
    total = 0.0
    for i in chosen:
        total += sum(weights.get(f, 0.0) for f in group[i][3]) - margin
    for i, j in zip(chosen, chosen[1:]):
        if group[j][0] - group[i][1] <= personal.NEAR:
            total += weights.get(personal._pair(group[i][2], group[j][2]), 0.0)
    return total


def random_group(rng):
    group = set()
    while len(group) < 7:
        a = rng.randrange(20)
        group.add((a, a + rng.randrange(1, 8), rng.choice(["card", "phone"])))
    return [(a, b, k, (f"{k}|{a}", f"{k}|s{b - a}")) for a, b, k in sorted(group, key=lambda c: (c[1], c[0], c[2]))]


@pytest.mark.parametrize("seed", range(6))
def test_decoding_and_gradient_are_those_of_all_segmentations(seed):
    rng = random.Random(seed)
    group = random_group(rng)
    names = sorted({f for c in group for f in c[3]}
                   | {personal._pair(a, b) for a in ("card", "phone") for b in ("card", "phone")})
    weights = {f: rng.gauss(0, 1.5) for f in names}
    all_paths = list(paths(group))
    best = max(path_weight(group, p, weights, personal.MARGIN) for p in all_paths)
    got = personal.decode(group, weights)
    chosen = tuple(next(i for i, c in enumerate(group) if (c[2], c[0], c[1]) == s) for s in got)
    assert path_weight(group, chosen, weights, personal.MARGIN) == pytest.approx(best)

    truth = rng.choice([p for p in all_paths if p])
    number = {}
    example = personal._Example(group, {(group[i][2], group[i][0], group[i][1]) for i in truth}, number)
    w = np.array([weights[f] for f in number])
    index, value = example.gradient(w)
    grad = np.bincount(index, value, len(number))

    def likelihood(v):
        at = {f: v[i] for f, i in number.items()}
        scores = [path_weight(group, p, at, 0.0) for p in all_paths]
        return path_weight(group, truth, at, 0.0) - math.log(sum(map(math.exp, scores)))
    for i in range(len(number)):
        step = np.zeros(len(number))
        step[i] = 1e-5
        assert grad[i] == pytest.approx((likelihood(w + step) - likelihood(w - step)) / 2e-5, abs=1e-5)


@pytest.fixture(scope="module")
def weights():
    return personal.train(PASSAGES)


def test_held_out_texts(weights):
    rng, right, wrong, missed = random.Random(1234), 0, 0, 0
    for _ in range(1500):
        text, truth = personal.example(rng, ("andere Worte, die im Training nicht stehen", "some words never seen"))
        got = {s for g in personal.islands(personal.candidates(text, [])) for s in personal.decode(g, weights)}
        right, wrong, missed = right + len(got & truth), wrong + len(got - truth), missed + len(truth - got)
    assert right / (right + wrong) > 0.96 and right / (right + missed) > 0.93


def added(text, weights):
    return [(k, text[a:b]) for k, a, b in personal.search(text, weights)[1]]


def test_other_notations(weights):
    assert added("you may call (743) 555-3824 today", weights) == [("phone", "(743) 555-3824")]
    assert added("mail me: anna.lee [at] mail5 [dot] com, thanks", weights) == [("email", "anna.lee [at] mail5 [dot] com")]
    two = "4465758382889437 4111111111111111"
    assert added(f"cards {two} here", weights) == [("card", c) for c in two.split() if personal.luhn(c)]
    assert added("host 192[.]168[.]1[.]10 is down", weights) == [("ip", "192[.]168[.]1[.]10")]
    both = "la. +1 (843) 555-7672 170.106.47.218 y"
    assert personal.search(both, weights)[0] == [("ip", 22, 36)]
    assert added(both, weights) == [("phone", "+1 (843) 555-7672")]


def test_clean_texts_stay_clean(weights):
    for text in ("", "on 2021-03-04 at 12:34:56 the total was 1,234,567.89 dollars", "chapter 3.2.1, pages 123-145",
                 "the dot at the end", "ISBN 978-3-16-148410-0", "1990-2000 and 2001/02", "a b c d"):
        assert added(text, weights) == [], text


def test_added_spans_are_clear_of_base_spans_and_each_other(weights):
    rng = random.Random(8)
    for _ in range(400):
        text, _ = personal.example(rng, PASSAGES)
        base, more = personal.search(text, weights)
        spans = sorted((a, b) for _, a, b in more)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        assert not any(a < d and c < b for a, b in spans for _, c, d in base)


def test_rows(spark, docs, documents, no_docs):
    rng = random.Random(2)
    more = [(i, personal.example(rng, PASSAGES)[0]) for i in range(100, 130)]
    more += [(131, "x y " * 300_000 + " 4111111111111111 " + "dot " * 100), (132, "tel ☎ +1 (743) 555-3824\U00010400 a@b.c")]
    both = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    found = personal.personal_data(both)
    order = {k: i for i, k in enumerate(personal.KINDS)}
    want = []
    weights = personal.fit(both.select("doc_id", "text"))
    for doc_id, text in [*documents, *more]:
        base = sorted(plain_base(text or ""), key=lambda s: (order[s[0]], s[1]))
        every = sorted([*base, *personal.search(text or "", weights)[1]], key=lambda s: (order[s[0]], s[1]))
        join = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((doc_id, *(sum(s[0] == k for s in base) for k in personal.BASE_KINDS),
                     hashlib.sha256(join(base).encode()).hexdigest(), join(every)))
    assert sorted(map(tuple, personal.digest(found).collect()), key=str) == sorted(want, key=str)
    assert personal.digest(personal.personal_data(no_docs)).count() == 0


def test_rows_without_triggers_have_no_candidates():
    rng = random.Random(6)
    texts = [re.sub("[0-9@]", "", personal.example(rng, PASSAGES)[0]) for _ in range(600)] + [
        "", "d", "at", "(at", "a (at) b.c", "x ( at ) y.z", "[ at] q", "dot", "a＠b.c"]
    with_triggers = set(personal._rows_with_triggers(pa.array(texts)))
    for i, text in enumerate(texts):
        assert i in with_triggers or not personal.candidates(text, [])
    assert len(with_triggers) < len(texts)
