"""Periodic run detection (11): multi-scale minimizers, pairs of equal minima as seeds, direct scans of short periods.

A run is a stretch of consecutive words with smallest period ``q`` and at
least ``max(12, 2 q)`` words that neither neighbour extends.  All texts of a
batch are one sequence of word numbers, with a separator of its own after
each text, so runs never leave a text and numpy works on long arrays.

* Periods under ``DIRECT``: for each lag the places where a word equals the one a lag further on; a stretch of
  them is a run.
* Periods in [Q, 2Q), for Q = ``DIRECT``, twice that, and so on: the least hash of each Q/2 consecutive (Q/2)-word
  grams.  Inside a run of period q the windows at i and i + q are alike, so their minima stand q apart: equal
  minima at a distance in [Q, 2Q) are seeds.  Grams without a period of Q/4 or less stand Q/4 apart at least, so a
  minimum has a bounded number of partners.
* Grams with such a short period lie in runs that smaller scales have found.  Two copies of one belong to two of
  these runs, of equal period, and the lag between the copies is the distance of the runs' ends, or of their
  starts, or the runs touch and every lag that keeps their phase gives a run: these are the seeds there.
* A seed (place, lag) is extended to both sides by binary search over prefix hashes, and what is found is
  compared word by word.  A stretch that a smaller period has too is that period's run.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapmart.llm.common import byte_groups, mix64, powers, prepare

# Least number of words of a run.
LEAST = 12
# Periods below are scanned directly; a power of two, 32 or more, so that grams of the first scale have
# 16 words or more and runs that hold one are never under LEAST.
DIRECT = 32

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _stretches(hits: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, number) of each row of at least ``least`` consecutive numbers in ascending ``hits``."""
    if not len(hits):
        return hits, hits
    cut = np.flatnonzero(np.diff(hits) != 1)
    first, last = np.r_[0, cut + 1], np.r_[cut, len(hits) - 1]
    size = last - first + 1
    keep = size >= least
    return hits[first[keep]], size[keep]


class _Runs:
    """Runs found so far, as parallel arrays; each stretch under its smallest period."""

    def __init__(self, n: int):
        self.n, self.known = n, np.empty(0, np.int64)
        self.start = self.length = self.period = np.empty(0, np.int64)

    def add(self, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> None:
        """Stretches of one scale, periods ascending; those that a smaller period has are left out."""
        if not len(start):
            return
        key = start * (self.n + 1) + length
        _, first = np.unique(key, return_index=True)
        first = first[~np.isin(key[first], self.known)]
        self.known = np.concatenate([self.known, key[first]])
        self.start, self.length, self.period = (
            np.concatenate([a, b[first]]) for a, b in
            ((self.start, start), (self.length, length), (self.period, period)))


class _Lags:
    """Extends seeds of a sequence by its prefix hashes."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.power, self.inverse = powers(len(x) + 1)
        with np.errstate(over="ignore"):
            self.total = np.empty(len(x) + 1, np.uint64)
            self.total[0] = 0
            np.cumsum(mix64(x.view(np.uint64)) * self.power[:len(x)], out=self.total[1:])

    def grams(self, k: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            m = len(self.x) - k + 1
            return mix64((self.total[k:] - self.total[:m]) * self.inverse[:m])

    def _alike(self, a: np.ndarray, b: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """Whether words [a, b) equal those a lag further on, by hash."""
        with np.errstate(over="ignore"):
            return (self.total[b] - self.total[a]) * self.power[lag] == self.total[b + lag] - self.total[a + lag]

    def _reach(self, place: np.ndarray, lag: np.ndarray, most: np.ndarray, sign: int) -> np.ndarray:
        low, high = np.zeros(len(place), np.int64), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self._alike(place, place + mid, lag) if sign > 0 else self._alike(place - mid, place, lag)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    def extend(self, place: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, period) of the maximal stretches through the seeds, by period; exact but for word numbers."""
        n = len(self.x)
        ok = (place >= 0) & (place + lag < n)
        pairs = np.unique(np.stack([lag[ok], place[ok]]), axis=1)
        lag, place = pairs[0], pairs[1]
        right = self._reach(place, lag, n - lag - place, 1)
        left = self._reach(place, lag, place.copy(), -1)
        long = left + right >= np.maximum(LEAST - lag, lag)
        found = np.unique(np.stack([lag[long], (place - left)[long], (left + right + lag)[long]]), axis=1)
        period, start, length = found
        same = (np.array_equal(self.x[a:b - q], self.x[a + q:b])
                for q, a, b in zip(period.tolist(), start.tolist(), (start + length).tolist()))
        if all(same):
            return start, length, period
        parts = []  # a hash has failed: the lags are scanned directly
        for q in np.unique(lag).tolist():
            first, size = _stretches(np.flatnonzero(self.x[q:] == self.x[:-q]), max(LEAST - q, q))
            parts.append((first, size + q, np.full(len(first), q)))
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _minima(grams: np.ndarray, w: int) -> np.ndarray:
    """Places of the least gram (leftmost of equal ones) of each ``w``, a power of two, consecutive grams."""
    bits = np.uint64(max(1, len(grams).bit_length()))
    v = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step < w:
        v = np.minimum(v[:-step], v[step:])
        step *= 2
    v &= (np.uint64(1) << bits) - np.uint64(1)
    return v[np.r_[True, v[1:] != v[:-1]]].view(np.int64)


def _short(runs: _Runs, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs that hold a ``k``-word gram and have a period of half of it or less, by period and start."""
    keep = np.flatnonzero((2 * runs.period <= k) & (runs.length >= k))
    keep = keep[np.lexsort((runs.start[keep], runs.period[keep]))]
    return runs.start[keep], runs.start[keep] + runs.length[keep], runs.period[keep]


def _run_seeds(lags: _Lags, start: np.ndarray, end: np.ndarray, period: np.ndarray, scale: int):
    """Seeds from pairs of runs of equal short period: distances of ends and of starts, phases of touching ones."""
    place, lag = [], []
    r = 1
    while r < len(start):
        near = np.flatnonzero((period[r:] == period[:-r]) & (start[r:] - end[:-r] < 2 * scale))
        if not len(near):
            break
        for edge in (end, start):
            d = edge[near + r] - edge[near]
            ok = (d >= scale) & (d < 2 * scale)
            place.append(edge[near][ok])
            lag.append(d[ok])
        if r == 1:
            for i in near[start[near + 1] <= end[near]].tolist():
                p, at = int(period[i]), int(end[i])
                most = min(at - int(start[i]), int(end[i + 1]) - at, 2 * scale - 1)
                if most < scale:
                    continue
                word = lags.x[at:at + p]
                phase = next((j for j in range(p) if np.array_equal(lags.x[at - p - j:at - j], word)), None)
                if phase is not None:
                    q = np.arange(p + phase, most + 1, p)
                    q = q[q >= scale]
                    place.append(at - q)
                    lag.append(q)
        r += 1
    none = np.empty(0, np.int64)
    return np.concatenate([none, *place]), np.concatenate([none, *lag])


def _scale(x: np.ndarray, runs: _Runs, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches with a period in [scale, 2 scale)."""
    k = w = scale // 2
    lags = _Lags(x)
    grams = lags.grams(k)
    at = _minima(grams, w)
    start, end, period = _short(runs, k)
    covered = np.zeros(len(x) + 1, np.int32)
    np.add.at(covered, start, 1)
    np.add.at(covered, end - k + 1, -1)
    at = at[np.cumsum(covered)[at] == 0]
    h = grams[at]
    order = np.lexsort((at, h))
    at, h = at[order], h[order]
    place, lag = _run_seeds(lags, start, end, period, scale)
    place, lag = [place], [lag]
    r = 1
    while r < len(at):
        d = at[r:] - at[:-r]
        near = (h[r:] == h[:-r]) & (d < 2 * scale)
        if not near.any():
            break
        near &= d >= scale
        place.append(at[:-r][near])
        lag.append(d[near])
        r += 1
    return lags.extend(np.concatenate(place), np.concatenate(lag))


def find_runs(x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period.

    ``x``: word numbers (int64) of texts, each text followed by a number that
    occurs once; ``sizes``: the texts' numbers of words.
    """
    runs = _Runs(len(x))
    longest = int(sizes.max(initial=0))
    for q in range(1, min(DIRECT, longest // 2 + 1)):
        first, size = _stretches(np.flatnonzero(x[q:] == x[:-q]), max(LEAST - q, q))
        runs.add(first, size + q, np.full(len(first), q))
    begin = np.cumsum(sizes + 1) - sizes - 1
    scale = DIRECT
    while 2 * scale <= longest:
        # only texts that have room for the scale's periods
        long = sizes >= 2 * scale
        inside = np.repeat(long, sizes + 1)
        if inside.all():
            runs.add(*_scale(x, runs, scale))
        else:
            shift = begin[long] - (np.cumsum(sizes[long] + 1) - sizes[long] - 1)
            own = np.repeat(long, sizes + 1)[runs.start]
            part = _Runs(len(x))
            place = np.cumsum(inside) - 1
            part.start, part.length, part.period = place[runs.start[own]], runs.length[own], runs.period[own]
            start, length, period = _scale(x[inside], part, scale)
            text = np.searchsorted(np.cumsum(sizes[long] + 1), start, "right")
            runs.add(start + shift[text], length, period)
        scale *= 2
    order = np.lexsort((runs.period, runs.start))
    return runs.start[order], runs.length[order], runs.period[order]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(w) for w in texts], np.int64)
    number: dict[bytes, int] = {}
    for words in texts:
        number.update(dict.fromkeys(words))
    for i, w in enumerate(number):
        number[w] = i
    x = np.empty(int(sizes.sum()) + len(texts), np.int64)
    to = 0
    for j, words in enumerate(texts):
        x[to:to + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        to += len(words) + 1
        x[to - 1] = len(number) + j
    return x, sizes


def _batch(texts: pa.Array) -> Iterator[tuple[int, int, pa.Array, pa.Array, pa.Array]]:
    """(first row, last row + 1, numbers of words, runs, collapsed texts) over a string array."""
    for lo, hi, data, offsets in byte_groups(texts):
        words = [data[a:b].tobytes().split() for a, b in zip(offsets[:-1], offsets[1:])]
        x, sizes = _numbered(words)
        start, length, period = find_runs(x, sizes)
        # words that a run covers after its first period
        drop = np.zeros(len(x) + 1, np.int64)
        np.add.at(drop, start + period, 1)
        np.add.at(drop, start + length, -1)
        keep = np.cumsum(drop)[:-1] == 0
        begin = np.cumsum(sizes + 1) - sizes - 1
        text = np.searchsorted(begin, start, "right") - 1
        collapsed = [b" ".join(w if keep[a:a + n].all() else compress(w, keep[a:a + n].tolist()))
                     for w, a, n in zip(words, begin.tolist(), sizes.tolist(), strict=True)]
        each = pa.StructArray.from_arrays([pa.array(v) for v in (start - begin[text], length, period)],
                                          fields=list(_RUN))
        bounds = np.r_[0, np.cumsum(np.bincount(text, minlength=hi - lo))].astype(np.int32)
        yield (lo, hi, pa.array(sizes), pa.ListArray.from_arrays(pa.array(bounds), each),
               pa.array(collapsed, pa.binary()).cast(pa.string()))


def collapse(docs: DataFrame) -> DataFrame:
    """Runs of the words ``[^\\x20\\x09-\\x0D]+`` of ``docs(doc_id, text)``, one row per row.

    Returns doc_id, n_words, runs (array of start, length, period by start
    and period) and collapsed: the words that no run covers after its first
    period, joined by one space.  A null or empty text has no words and
    collapses to the empty text; null doc_ids and repeated rows are worked off
    like any other; other columns are ignored; an empty table gives no rows.
    Texts are worked off whole, in batches bounded by bytes; a longer one comes alone.
    """
    prepare(docs.sparkSession)

    def search(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for lo, hi, sizes, runs, collapsed in _batch(texts):
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), sizes, runs, collapsed],
                                                 ["doc_id", "n_words", "runs", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        search, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, "
                "collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The contract's periodic texts: with h = crc32(decimal doc_id), where h % 10 = 0 and the text has n > 0
    words, the words from a = floor(h / 10) % n on repeat the first p = 1 + floor((n - a) / (3 + floor(h / 10) % 8))
    of them.  Other texts, and those without doc_id, stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def periodic(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(
            F.get(w, (a + (i - a) % p).cast("int")))), " ")

    bound = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, periodic(w)))
    return F.when(h % 10 == 0, F.get(bound, F.lit(0))).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``collapse``: the longest run (ties: smallest start, then period) and digests."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return (found.withColumn("_top", longest)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_top.start")).alias("start"),
                    F.col("_top.length").alias("length"), (-F.col("_top.period")).alias("period"),
                    F.expr("1000 * _top.length div (-_top.period)").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
