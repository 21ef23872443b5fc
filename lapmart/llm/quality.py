"""Quality classifier: document evidence combined with host and path posteriors by empirical Bayes.

Evidence: a logistic regression per target (low quality, toxic) on features of
the whole text: words, their first bytes, and how much of the text has which
word shape or repeats the word before it.  It is fitted on at most
``TRAIN_ROWS`` labelled rows; every document is scored.

Sites: a document's path lies in a host (here source and language within the
source).  A site's rate of bad documents, labelled ones by label and others by
evidence, is shrunk: a host's towards the rate of all documents, a path's
towards its host's, each with the strength that the spread of the rates
implies (beta-binomial moments).  A document's posterior odds are its evidence
odds with the training prior replaced by its path's posterior, so the prior of
a sparse path is its host's, and that of a sparse host the global one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapmart.llm.common import (WordHasher, ascii_space_words, byte_groups, dropped, free_name, letter_digit_words,
                                mix64, prepare, reads, row_of_word, salted_join, small_enough, written)

# Labelled rows that the classifier is fitted on at most (those with the smallest hashes of doc_id).
TRAIN_ROWS = 12_000
# Features per target, and rows that a feature needs.
FEATURES = 1_000
LEAST_ROWS = 10
RIDGE = 1e-4
STEPS = 400
TARGETS = ("low", "toxic")
PREFIXES = (4, 5)
# Shares of a text's words from which a shape or repetition counts as a feature of its own.
SHARES = (0.0, 0.02, 0.1, 0.3, 0.6)
# Keys of rows to drop that are broadcast at most (16 MB); beyond that the join is shuffled.
BROADCAST_KEYS = 2_000_000
_HOT_SALT = 32


def _shape_bytes() -> np.ndarray:
    """Upper case 1, other letters 2, digits 3; signs and white space as they are."""
    shape = np.arange(256, dtype=np.uint8)
    shape[0x41:0x5B], shape[0x61:0x7B], shape[0x80:], shape[0x30:0x3A] = 1, 2, 2, 3
    return shape


class Featuriser:
    def __init__(self):
        self.words = WordHasher(letter_digit_words())
        self.shapes = WordHasher(ascii_space_words())
        self.shape = _shape_bytes()

    @staticmethod
    def _tag(h: np.ndarray, tag: int) -> np.ndarray:
        return mix64(h ^ np.uint64(0x51ED270B1F3A9C55 + tag)).view(np.int64)

    def batch(self, texts: pa.Array):
        """Yields (first row, last row + 1, rows, features), with repetitions."""
        for lo, hi, h, counts, firsts in self.words.batch(texts, PREFIXES):
            rows = row_of_word(counts)
            parts = [(rows, self._tag(h, 0))]
            parts += [(rows, self._tag(f, 1 + j)) for j, f in enumerate(firsts)]
            same = np.flatnonzero((h[1:] == h[:-1]) & (rows[1:] == rows[:-1])) if len(h) > 1 else rows[:0]
            r, at = self._levels(rows[same], np.zeros(len(same), np.uint64), counts)
            parts.append((r, self._tag(at, 8)))
            n = sum(len(r) for r, _ in parts)
            if n:
                yield lo, hi, np.concatenate([r for r, _ in parts]), np.concatenate([f for _, f in parts])
        for lo, hi, data, offsets in byte_groups(texts):
            kind = self.shape[data]
            # runs of one class count once
            keep = np.ones(len(kind), bool)
            keep[1:] = kind[1:] != kind[:-1]
            keep[offsets[:-1][offsets[:-1] < len(kind)]] = True
            length = np.r_[0, np.cumsum(keep)][offsets]
            short = pa.StringArray.from_buffers(
                hi - lo, pa.py_buffer(length.astype(np.int32).tobytes()), pa.py_buffer(kind[keep].tobytes()))
            for a, b, h, counts in self.shapes.batch(short):
                r, f = self._levels(row_of_word(counts), h, counts)
                if len(r):
                    yield lo + a, lo + b, r, self._tag(f, 9)

    @staticmethod
    def _levels(rows: np.ndarray, h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash with level) for each share of the row's words that a hash reaches."""
        if not len(rows):
            return rows, h
        order = np.lexsort((h, rows))
        rows, h = rows[order], h[order]
        first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])])
        n = np.diff(np.r_[first, len(rows)])
        rows, h = rows[first], h[first]
        share = n / counts[rows]
        out = [(rows[share > s], mix64(h[share > s] + np.uint64(i + 1))) for i, s in enumerate(SHARES)]
        return np.concatenate([r for r, _ in out]), np.concatenate([x for _, x in out])


def _row_features(batch) -> list[np.ndarray]:
    """Distinct features of each row's text."""
    found: dict[int, list] = {}
    for lo, _, rows, f in Featuriser().batch(batch.column("text")):
        order = np.argsort(rows, kind="stable")
        at = np.searchsorted(rows[order], np.arange(rows.max() + 2))
        for r in np.unique(rows):
            found.setdefault(lo + int(r), []).append(np.unique(f[order[at[r]:at[r + 1]]]))
    return [np.unique(np.concatenate(found[r])) if r in found else np.empty(0, np.int64)
            for r in range(batch.num_rows)]


def _training_rows(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, DataFrame]:
    """(names, rows): the features to look at, and (low, toxic, features) of at most ``TRAIN_ROWS`` labelled documents.

    Features are counted by Spark; of those at most ``FEATURES`` per target,
    the ones most associated with it, are kept in the rows, as their places
    in names.
    """
    sample = written(labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS), "quality-sample")
    rows = written(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # TRAIN_ROWS rows
                   .dropDuplicates(["doc_id"]).select("text", "low", "toxic"), "quality-training")

    def count(batches):
        for batch in batches:
            sets = _row_features(batch)
            names, at = np.unique(np.concatenate([np.empty(0, np.int64), *sets]), return_inverse=True)
            row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            yield pa.RecordBatch.from_pydict({"f": names, "n": np.bincount(at, minlength=len(names))} | {
                t: np.bincount(at, batch.column(t).to_numpy()[row], len(names)) for t in TARGETS})

    counts = written(rows.mapInArrow(count, "f long, n long, low double, toxic double")
                     .groupBy("f").agg(F.sum("n").alias("n"), *(F.sum(t).alias(t) for t in TARGETS))
                     .where(F.col("n") >= LEAST_ROWS), "quality-counts")
    total = rows.agg(F.count("*").alias("n"), *(F.coalesce(F.sum(t), F.lit(0.0)).alias(t) for t in TARGETS)).first()
    names = np.empty(0, np.int64)
    for t in TARGETS:
        rate = total[t] / total["n"] if total["n"] else 0.0
        df = F.col("n")
        z = F.abs(F.col(t) - df * rate) / F.sqrt(df * rate * (1 - rate) * (1 - df / max(total["n"], 1)) + 1e-9)
        best = counts.withColumn("z", z).where((F.col("z") > 3) & (df < total["n"]))
        names = np.union1d(names, best.orderBy(F.desc("z"), "f").limit(FEATURES).select("f").toPandas()["f"].to_numpy(np.int64))

    def keep(batches):
        for batch in batches:
            sets = [np.searchsorted(names, x[np.isin(x, names, assume_unique=True)]) for x in _row_features(batch)]
            offsets = np.r_[0, np.cumsum([len(x) for x in sets])].astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int64), *sets]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(t) for t in TARGETS), pa.ListArray.from_arrays(offsets, pa.array(flat))],
                [*TARGETS, "features"])

    features = written(rows.mapInArrow(keep, "low double, toxic double, features array<int>"), "quality-features")
    dropped(sample, rows, counts)
    return names, features


def fit(col: np.ndarray, length: np.ndarray, y: np.ndarray, n_names: int) -> tuple[np.ndarray, np.ndarray, float, float]:
    """(places, weights, bias, share of ones): ridge logistic regression on the features most associated with y.

    col: the features' places of all rows one after another; length: of each row.
    """
    n = len(y)
    rate = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if n else 0.5
    none = np.empty(0, np.int64), np.empty(0), float(np.log(rate / (1 - rate))), rate
    if not n or y.min() == y.max() or not n_names:
        return none
    rows = np.repeat(np.arange(n, dtype=np.int32), length)
    df = np.bincount(col, minlength=n_names)
    ones = np.bincount(col, y[rows], n_names)
    z = np.abs(ones - df * rate) / np.sqrt(df * rate * (1 - rate) * np.maximum(1 - df / n, 1e-9) + 1e-9)
    z[(df < LEAST_ROWS) | (df == n)] = 0
    best = np.argsort(-z, kind="stable")[:FEATURES]
    best = np.sort(best[z[best] > 3])
    if not len(best):
        return none
    place = np.full(n_names, -1, np.int32)
    place[best] = np.arange(len(best))
    held = place[col] >= 0
    rows, col = rows[held], place[col][held]
    w, b = np.zeros(len(best) + 1), none[2]
    w[-1] = b
    m = v = np.zeros(len(w))
    for step in range(1, STEPS + 1):  # Adam on the full sample
        p = 1 / (1 + np.exp(-(np.bincount(rows, w[col], n) + w[-1])))
        g = np.append(np.bincount(col, (p - y)[rows], len(best)), (p - y).sum()) / n
        g[:-1] += RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return best, w[:-1], float(w[-1]), rate


def _fitted(names: np.ndarray, rows: DataFrame) -> dict[str, tuple]:
    """``fit`` for each target, in one task: its input is at most ``TRAIN_ROWS`` rows of chosen features."""

    def run(batches):
        cols, lengths, ys = [np.empty(0, np.int32)], [np.empty(0, np.int64)], [np.empty((0, len(TARGETS)))]
        for b in batches:
            f = b.column("features")
            cols.append(f.flatten().to_numpy())
            lengths.append(np.diff(f.offsets.to_numpy()))
            ys.append(np.stack([b.column(t).to_numpy() for t in TARGETS], axis=1))
        col, length, y = np.concatenate(cols), np.concatenate(lengths), np.concatenate(ys)
        out = [(t, *fit(col, length, y[:, j], len(names))) for j, t in enumerate(TARGETS)]
        t, at, w, bias, rate = zip(*out)
        yield pa.RecordBatch.from_arrays(
            [pa.array(t), pa.array([x.tolist() for x in at], pa.list_(pa.int64())),
             pa.array([x.tolist() for x in w], pa.list_(pa.float64())), pa.array(bias, pa.float64()),
             pa.array(rate, pa.float64())], ["target", "places", "weights", "bias", "rate"])

    fields = "target string, places array<long>, weights array<double>, bias double, rate double"
    got = rows.coalesce(1).mapInArrow(run, fields).collect()
    dropped(rows)
    got = got or [{"target": t, "places": [], "weights": [], "bias": 0.0, "rate": 0.5} for t in TARGETS]
    return {r["target"]: (names[np.array(r["places"], np.int64)], np.array(r["weights"], float), r["bias"], r["rate"])
            for r in got}


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def evidence(docs: DataFrame, models: dict[str, tuple]) -> DataFrame:
    """The other columns of ``docs`` and, for each target, the classifier's log odds."""
    keep = [c for c in docs.columns if c != "text"]
    tables = {}
    for t, (names, w, bias, _) in models.items():
        order = np.argsort(names)
        tables[t] = names[order], w[order], bias
    held = docs.sparkSession.sparkContext.broadcast(tables)  # at most FEATURES entries per target

    def score(batches):
        make = Featuriser()
        for batch in batches:
            out = {t: np.full(batch.num_rows, bias) for t, (_, _, bias) in held.value.items()}
            hits: dict[str, list] = {t: [] for t in out}
            for lo, _, rows, f in make.batch(batch.column("text")):
                for t, (names, w, _) in held.value.items():
                    if len(names):
                        at = np.minimum(np.searchsorted(names, f), len(names) - 1)
                        ok = names[at] == f
                        hits[t].append(np.unique((lo + rows[ok]).astype(np.int64) * len(names) + at[ok]))
            for t, (names, w, _) in held.value.items():
                if hits[t]:
                    key = np.unique(np.concatenate(hits[t]))
                    out[t] += np.bincount(key // len(names), w[key % len(names)], batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(out[t]) for t in out)],
                                             [*keep, *out])

    kinds = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(
        score, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"{t} double" for t in models)]))


def _strength(rates: DataFrame, n: str, s: str, mean: Column) -> float:
    """Beta prior strength from rates s / n around ``mean``: between-site variance beyond the binomial one."""
    e = (F.col(s) / F.col(n) - mean)
    row = rates.where(F.col(n) > 0).agg(
        F.sum(F.col(n) * e * e).alias("ss"), F.sum(mean * (1 - mean)).alias("within"), F.sum(n).alias("n"),
        F.sum(F.col(n) * mean * (1 - mean)).alias("var"), F.count("*").alias("k")).first()
    if not row["n"]:
        return 1.0
    between = max((row["ss"] - row["within"]) / row["n"], 1e-9)
    return float(min(max(row["var"] / row["n"] / between - 1, 1.0), 1e6))


# A site's rows and ones, of its path and its host.
SUMS = ("_path_n", "_path_s", "_host_n", "_host_s")


def _shrunk(ones: Column, n: Column, strength: float, toward: Column) -> Column:
    return (ones + F.lit(strength) * toward) / (n + F.lit(strength))


def site_posteriors(scored: DataFrame, target: str) -> tuple[DataFrame, Callable[[Column], Column]]:
    """(sites, others): the posterior rates host_* and path_* of each host and path, path shrunk to host, host to all
    documents; and for a document with value y the rate of its path from all documents but itself."""
    paths = written(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(f"y_{target}").alias("s")),
                    f"quality-{target}")
    all_ = paths.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    mean = float(all_["s"] / all_["n"]) if all_["n"] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    m = _strength(hosts, "hn", "hs", F.lit(mean))
    host, path = f"host_{target}", f"path_{target}"
    hosts = hosts.withColumn(host, _shrunk(F.col("hs"), F.col("hn"), m, F.lit(mean)))
    both = paths.join(hosts, "host")
    k = _strength(both, "n", "s", F.col(host))
    sums = [F.col(c).alias(name) for c, name in zip(("n", "s", "hn", "hs"), SUMS)]
    sites = both.select("host", "path", host, _shrunk(F.col("s"), F.col("n"), k, F.col(host)).alias(path), *sums)

    def others(y: Column) -> Column:
        # rounding may leave a sum a little below 0
        rest = lambda s: F.greatest(F.col(s) - y, F.lit(0.0))
        near = _shrunk(rest("_host_s"), F.col("_host_n") - 1, m, F.lit(mean))
        return _shrunk(rest("_path_s"), F.col("_path_n") - 1, k, near)

    return reads(sites, paths), others


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """Judges each row of ``docs(doc_id, text, ...)`` with ``labels(doc_id, quality, toxic)``.

    Returns doc_id, row_key (hash of doc_id and text), host, path, the
    evidence's probability (ev_*), the site posteriors (host_*, path_*), the
    document's posterior (post_*) for low quality and toxicity, and keep
    (both posteriors below one half).  A document's posterior joins its
    evidence with the rate of its path's other documents, so that no document
    confirms itself.  A null or empty text has no features
    and is judged by its site; null hosts and paths are sites of their own; a
    null label leaves that target out; of several labels of a document the
    worst counts; without labels, or with labels of one kind only, the evidence
    is the labels' rate, or a half; other columns are ignored.
    """
    prepare(docs.sparkSession)
    known = (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.max(F.when(F.col("quality") == 0, 1.0).when(F.col("quality").isNotNull(), 0.0)).alias("l_low"),
                  F.max(F.when(F.col("toxic") == 1, 1.0).when(F.col("toxic").isNotNull(), 0.0)).alias("l_toxic")))
    both = known.where("l_low IS NOT NULL AND l_toxic IS NOT NULL").select(
        "doc_id", F.col("l_low").alias("low"), F.col("l_toxic").alias("toxic"))
    models = _fitted(*_training_rows(docs, both))
    site = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    rows = docs.select("doc_id", row_key().alias("row_key"), site(host).alias("host"), site(path).alias("path"), "text")
    # null ids have no label: they are dealt out, not sent to one task
    key = F.when(F.col("doc_id").isNull(), F.pmod("row_key", F.lit(_HOT_SALT))).otherwise(F.lit(0))
    scored = evidence(rows, models).withColumn("_s", key.cast("int")).join(
        known.withColumn("_s", F.lit(0)), ["doc_id", "_s"], "left").drop("_s")
    for t in TARGETS:
        scored = scored.withColumn(f"ev_{t}", 1 / (1 + F.exp(-F.col(t))))
        scored = scored.withColumn(f"y_{t}", F.coalesce(f"l_{t}", f"ev_{t}"))
    scored = written(scored.drop("l_low", "l_toxic"), "quality-scored")
    out, used = scored, [scored]
    for t in TARGETS:
        sites, others = site_posteriors(scored, t)
        used.append(sites)
        out = salted_join(out, sites, ["host", "path"], "row_key", _HOT_SALT)
        odds = F.col(t) - _logit(F.lit(models[t][3])) + _logit(others(F.col(f"y_{t}")))
        out = out.withColumn(f"post_{t}", 1 / (1 + F.exp(-odds))).drop(*SUMS)
    keep = (F.col("post_low") < 0.5) & (F.col("post_toxic") < 0.5)
    out = out.select("doc_id", "row_key", "host", "path", *(f"{a}_{t}" for t in TARGETS
                                                            for a in ("ev", "host", "path", "post")), keep.alias("keep"))
    return reads(out, *used)


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def keep_good(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    judged = classify(docs, labels, host, path)
    bad = written(judged.where(~F.col("keep")).select("row_key").distinct(), "quality-bad")
    dropped(judged)
    return drop_rows(docs, reads(bad.withColumnRenamed("row_key", "key"), bad))


def drop_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``row_key`` is in keys(key)."""
    name = free_name(docs, "_key")
    return reads(docs.withColumn(name, row_key())
                 .join(small_enough(keys.withColumnRenamed("key", name), BROADCAST_KEYS), name, "left_anti")
                 .select(*docs.columns), keys)
