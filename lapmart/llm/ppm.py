"""Language-model scores by prediction by partial matching over bytes, and a word unigram baseline.

The model is a trie of byte contexts up to ``ORDER`` bytes with symbol counts
of the training texts (A-Z lower-cased).  A symbol is coded in the longest
known context; where that context has not seen it, an escape (method C:
distinct symbols over count plus distinct symbols) leads to the next shorter
one, from whose counts the symbols already ruled out are excluded; last comes
a uniform choice among the byte values that no context has seen.  Since a
context's symbols are among its suffix's, the excluded count of a step
depends on the two contexts alone; the trie holds it per context, and a
text's code length is a sum of table look-ups.

The trie's counts are summed by Spark.  Its part for a group of two-byte
contexts is complete by itself, so a large trie is used in passes over groups
of at most ``PASS_GRAMS`` entries: what a task and the driver hold is bounded
however much the trie grows.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapmart.llm.common import WordHasher, ascii_space_words, byte_groups, mix64, prepare, row_of_word, written
from lapmart.llm.files import new_name, open_fs
from lapmart.sources.rawfiles import scratch_dir

ORDER = 5
# Symbols that UTF-8 never has: before the start, and after the end of a text.
START, END = 0xFE, 0xFF
SYMBOLS = 256
# Highest-order entries that are held at a time (about 60 MB of tables).
PASS_GRAMS = 800_000
# Most frequent words whose counts are broadcast (8 MB); other words' counts are joined.
WORD_TABLE = 1 << 19
# Distinct entries that a learning task holds before it hands them to Spark.
FLUSH = 1_500_000
GRAM, WORD = 0, 1
END_WORD = int(mix64(np.array([0xE0D], np.uint64)).view(np.int64)[0])
_SLICE = 1 << 19


def _symbols(texts: pa.Array, hasher: WordHasher, order: int):
    """Yields (rows, grams): for each symbol of the texts its row, and it with its context as one integer.

    Long texts come in several slices.
    """
    for lo, hi, data, offsets in byte_groups(texts):
        n = hi - lo
        length = np.diff(offsets)
        # each text gets ``order`` starts before and an end behind it
        line = np.full(len(data) + n * (order + 1), START, np.uint8)
        rows = np.repeat(np.arange(n), length)
        line[np.arange(len(data)) + (rows + 1) * order + rows] = hasher.lower[data]
        ends = offsets[1:] + (np.arange(n) + 1) * order + np.arange(n)
        line[ends] = END
        for a in range(order, len(line), _SLICE):
            part = line[a - order:a + _SLICE].astype(np.int64)
            at = len(part) - order
            gram = part[:at].copy()
            for j in range(1, order + 1):
                gram <<= 8
                gram |= part[j:j + at]
            symbol = (gram & 0xFF) != START
            yield lo + np.searchsorted(ends, np.arange(a, a + at)[symbol]), gram[symbol]


def learn(docs: DataFrame, order: int) -> DataFrame:
    """(kind, key, count) over the training texts ``docs(text)``: context grams, and hashed words with ends."""

    def count(batches):
        hasher = WordHasher(ascii_space_words())
        held: dict[int, list] = {GRAM: [], WORD: []}

        def merged(kind):
            key = np.concatenate([k for k, _ in held[kind]])
            order_ = np.argsort(key, kind="stable")
            key, n = key[order_], np.concatenate([c for _, c in held[kind]])[order_]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            held[kind] = [(key[first], np.add.reduceat(n, first))]

        def add(kind, keys):
            if len(keys):
                held[kind].append(np.unique(keys, return_counts=True))

        def flush(kind):
            merged(kind)
            key, n = held[kind].pop()
            return pa.RecordBatch.from_pydict({"kind": pa.array(np.full(len(key), kind), pa.int32()),
                                               "key": key, "count": n})

        for batch in batches:
            texts = batch.column("text")
            for _, grams in _symbols(texts, hasher, order):
                add(GRAM, grams)
                if len(held[GRAM]) >= 4:
                    merged(GRAM)
            for _, _, h, counts in hasher.batch(texts):
                add(WORD, np.append(h.view(np.int64), np.full(len(counts), END_WORD)))
                if len(held[WORD]) >= 4:
                    merged(WORD)
            for kind in held:
                if sum(len(k) for k, _ in held[kind]) > FLUSH:
                    yield flush(kind)
        for kind in held:
            if held[kind]:
                yield flush(kind)

    return written(docs.mapInArrow(count, "kind int, key long, count long")
                   .groupBy("kind", "key").agg(F.sum("count").alias("count")), "ppm-model")


class IntTable:
    """Open-addressing table from unsigned 63-bit keys to row numbers, built and read vectorised."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rows = np.zeros(1 << self.bits, np.int32)
        left, step = np.arange(len(keys)), 0
        while len(left):
            slot = self._slot(keys[left], step)
            empty = self.keys[slot] == -1
            self.keys[slot[empty]] = keys[left[empty]]
            won = self.keys[slot] == keys[left]
            self.rows[slot[won]] = left[won]
            left, step = left[~won], step + 1
        self.steps = step

    def _slot(self, keys: np.ndarray, step: int) -> np.ndarray:
        h = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)
        return ((h + np.uint64(step)) & np.uint64((1 << self.bits) - 1)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        keys = np.ascontiguousarray(keys, np.int64)
        slot = self._slot(keys, 0)
        out = np.where(self.keys[slot] == keys, self.rows[slot], -1)
        left = np.flatnonzero((out < 0) & (self.keys[slot] != -1))
        for step in range(1, self.steps):
            if not len(left):
                break
            slot = self._slot(keys[left], step)
            at = self.keys[slot]
            hit = at == keys[left]
            out[left[hit]] = self.rows[slot[hit]]
            left = left[~hit & (at != -1)]
        return out


def _sum_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(keys, return_inverse=True)
    return keys, np.bincount(inverse, counts, len(keys)).astype(np.int64)


class Trie:
    """The part of the model whose last two context bytes lie in [lo, hi), and all contexts below two bytes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, short: tuple[np.ndarray, np.ndarray], order: int,
                 lo: int = 0, hi: int = 1 << 16):
        self.order, self.lo, self.hi = order, lo, hi
        grams = {order: _sum_by(keys, counts)}
        for k in range(order - 1, 1, -1):
            grams[k] = _sum_by(grams[k + 1][0] & ((1 << 8 * (k + 1)) - 1), grams[k + 1][1])
        grams[1] = _sum_by(*short)
        grams[0] = _sum_by(short[0] & 0xFF, short[1])
        self.value, self.log_count, self.keys, self.contexts = {}, {}, {}, {}
        self.escape, self.log_rest, self.next_escape = {}, {}, {}
        below = None
        for k in range(order + 1):
            key, n = grams[k]
            ctx, first = np.unique(key >> 8, return_index=True)
            distinct = np.diff(np.r_[first, len(key)])
            total = np.add.reduceat(n, first) if len(key) else n
            of = np.repeat(np.arange(len(ctx)), distinct)
            self.keys[k], self.contexts[k] = key, ctx
            self.value[k] = np.log10(n / (total + distinct)[of]).astype(np.float32)
            self.log_count[k] = np.log10(n).astype(np.float32)
            self.escape[k] = np.log10(distinct / (total + distinct))
            if below is not None:
                b_key, b_n, b_total, b_distinct = below
                # the count in the suffix of the symbols seen here
                suffix = np.searchsorted(b_key, key & ((1 << 8 * k) - 1))
                ruled_out = np.add.reduceat(b_n[suffix], first) if len(key) else b_n[:0]
                c = np.searchsorted(self.contexts[k - 1], ctx & ((1 << 8 * (k - 1)) - 1))
                new = b_distinct[c] - distinct
                rest = b_total[c] - ruled_out + new
                with np.errstate(divide="ignore"):
                    self.log_rest[k] = np.where(new > 0, np.log10(np.maximum(rest, 1)), 0.0)
                    # nothing new in the suffix: the escape from it is certain
                    self.next_escape[k] = np.where(new > 0, np.log10(np.maximum(new, 1) / np.maximum(rest, 1)), 0.0)
            below = key, n, total, distinct
        self.uniform = -math.log10(max(1, SYMBOLS - len(grams[0][0])))

    def compile(self) -> Trie:
        """Makes the look-up tables (not part of the file)."""
        self.gram = {k: IntTable(x) for k, x in self.keys.items()}
        self.context = {k: IntTable(x) for k, x in self.contexts.items()}
        return self

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol in its context (0 where another part of the trie is in charge)."""
        out = np.zeros(len(grams))
        if self.lo or self.hi < 1 << 16:
            pair = (grams >> 8) & 0xFFFF
            mine = np.flatnonzero((pair >= self.lo) & (pair < self.hi))
            grams = grams[mine]
        else:
            mine = None
        row = self.gram[self.order].find(grams)
        p = np.where(row >= 0, self.value[self.order][row] if len(self.value[self.order]) else 0.0, 0.0)
        p = p.astype(np.float64)
        left = np.flatnonzero(row < 0)
        if len(left):
            p[left] = self._shorter(grams[left])
        if mine is None:
            return p
        out[mine] = p
        return out

    def _shorter(self, grams: np.ndarray) -> np.ndarray:
        """The same for symbols that the longest context hasn't seen."""
        p = np.zeros(len(grams))
        came = np.full(len(grams), -1)  # the row of the next longer context, if it is known
        open_ = np.arange(len(grams))
        for k in range(self.order, -1, -1):
            key = grams[open_] & ((1 << 8 * (k + 1)) - 1)
            gram = self.gram[k].find(key)
            context = self.context[k].find(key >> 8)
            seen, excluded = gram >= 0, came >= 0
            if excluded.any():
                c = came[excluded]
                p[open_[excluded]] += np.where(
                    seen[excluded],
                    (self.log_count[k][gram[excluded]] if len(self.log_count[k]) else 0) - self.log_rest[k + 1][c],
                    self.next_escape[k + 1][c])
            fresh = ~excluded & (context >= 0)
            if fresh.any():
                p[open_[fresh]] += np.where(seen[fresh], self.value[k][gram[fresh]], self.escape[k][context[fresh]])
            open_, came = open_[~seen], context[~seen]
        p[open_] += self.uniform
        return p


def _passes(model: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of two-byte contexts with at most ``most`` grams each (a single pair of bytes may exceed it
    only by what 2**24 contexts of it allow)."""
    sizes = (model.where(F.col("kind") == GRAM)
             .groupBy(F.shiftright("key", 8).bitwiseAND(0xFFFF).alias("pair")).count().toPandas())
    full = np.zeros(1 << 16, np.int64)
    full[sizes["pair"]] = sizes["count"]
    out, lo, held = [], 0, 0
    for pair in np.flatnonzero(full):
        if held and held + full[pair] > most:
            out.append((lo, int(pair)))
            lo, held = int(pair), 0
        held += full[pair]
    return [*out, (lo, 1 << 16)]


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Scores ``docs(doc_id, text)``; learns from rows whose crc32(doc_id as text) mod 7 is not 2.

    Returns, per row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.  A null text is empty (its end alone is scored); a
    null doc_id belongs to the training rows; repeated rows are learned and
    scored each; without training rows every symbol is uniform; other columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    docs = docs.select("doc_id", "text", held_out.alias("held_out"))
    model = learn(docs.where(~F.col("held_out")).select("text"), order)
    words = model.where(F.col("kind") == WORD)
    totals = words.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = totals["n"], totals["v"]
    log_all = math.log10(n + v + 1)
    least = _least_count(words, v)
    table = words.where(F.col("count") >= least).select("key", "count").toPandas().sort_values("key")
    frequent = spark.sparkContext.broadcast((table["key"].to_numpy(np.int64), np.log10(table["count"].to_numpy() + 1.0)))
    short = (model.where(F.col("kind") == GRAM).groupBy(F.col("key").bitwiseAND(0xFFFF).alias("key"))
             .agg(F.sum("count").alias("count")).toPandas())
    short = short["key"].to_numpy(np.int64), short["count"].to_numpy(np.int64)

    parts = _write_tries(model, short, order, scratch_dir(spark, "ppm-trie"))

    def add(batches):
        from pyspark import TaskContext

        unit = TaskContext.get().partitionId() << 40
        hasher = WordHasher(ascii_space_words())
        keys, logs = frequent.value
        for batch in batches:
            texts = batch.column("text")
            log_p = np.zeros(batch.num_rows)
            for part in parts:  # one part of the trie in memory at a time
                trie = _load_trie(part)
                for rows, grams in _symbols(texts, hasher, order):
                    log_p += np.bincount(rows, trie.log10(grams), batch.num_rows)
            for lo, hi, h, counts in hasher.batch(texts):
                m = hi - lo
                rows = np.append(row_of_word(counts), np.arange(m))
                h = np.append(h.view(np.int64), np.full(m, END_WORD))
                at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                total = np.bincount(rows[hit], logs[at[hit]], m) - (counts + 1) * log_all
                # other words: once per text, with how often
                order_ = np.lexsort((h[~hit], rows[~hit]))
                r, w = rows[~hit][order_], h[~hit][order_]
                first = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (w[1:] != w[:-1])]) if len(r) else r
                times = np.diff(np.r_[first, len(r)])
                offsets = np.r_[0, np.cumsum(np.bincount(r[first], minlength=m))].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unit + np.arange(m)), *(batch.column(c).slice(lo, m) for c in ("doc_id", "held_out")),
                     pa.array((counts + 1).astype(np.int64)), pa.array(np.bincount(rows[hit], minlength=m)),
                     pa.array(total), pa.array(log_p[lo:hi]), pa.ListArray.from_arrays(offsets, pa.array(w[first])),
                     pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64)))],
                    ["unit", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare", "tf"])
                unit += m

    kind = dict(docs.dtypes)["doc_id"]
    scored = docs.mapInArrow(add, f"unit long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
                                  "base_score double, score double, rare array<long>, tf array<long>")
    out = ["doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"]
    if least <= 1:  # all words are in the table; the others have no count, and log10(0 + 1) adds nothing
        return scored.select(*out)
    scored = written(scored, "ppm-scored")
    each = (scored.select("unit", F.explode(F.arrays_zip("rare", "tf")).alias("x"))
            .select("unit", F.col("x.rare").alias("key"), F.col("x.tf").alias("tf")))
    more = (each.join(words.where(F.col("count") < least).select("key", "count"), "key").groupBy("unit")
            .agg(F.sum("tf").alias("known"), F.sum(F.col("tf") * F.log10(F.col("count") + 1)).alias("logs")))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return (scored.drop("rare", "tf").join(more, "unit", "left")
            .withColumns({"n_known": F.col("n_known") + zero("known"), "base_score": F.col("base_score") + zero("logs")})
            .select(*out))


def _write_tries(model: DataFrame, short: tuple[np.ndarray, np.ndarray], order: int, folder: str) -> list[str]:
    """Files with the parts of the trie; a task builds one from its at most ``PASS_GRAMS`` entries."""
    pair = F.shiftright("key", 8).bitwiseAND(0xFFFF)
    names = []
    for lo, hi in _passes(model, PASS_GRAMS):
        def build(batches, lo=lo, hi=hi):
            held = [(b.column("key").to_numpy(), b.column("count").to_numpy()) for b in batches]
            none = [np.empty(0, np.int64)]
            trie = Trie(np.concatenate(none + [k for k, _ in held]), np.concatenate(none + [n for _, n in held]),
                        short, order, lo, hi)
            name = new_name(folder, lo, ".trie")
            fs, path = open_fs(name)
            fs.create_dir(path.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(path) as out:
                pickle.dump(trie, out, protocol=5)
            yield pa.RecordBatch.from_pydict({"file": [name]})

        part = model.where((F.col("kind") == GRAM) & (pair >= lo) & (pair < hi)).select("key", "count")
        # one task by design: its input is bounded
        files = [r["file"] for r in part.coalesce(1).mapInArrow(build, "file string").collect()]
        # no partition at all: an empty trie
        names += files or [b.column("file")[0].as_py() for b in build(())]
    return names


_LOADED: dict[str, Trie] = {}


def _load_trie(name: str) -> Trie:
    """The part of the trie in a file; a worker keeps the last one."""
    if name not in _LOADED:
        _LOADED.clear()
        fs, path = open_fs(name)
        with fs.open_input_file(path) as handle:
            _LOADED[name] = pickle.loads(handle.read()).compile()
    return _LOADED[name]


def _least_count(words: DataFrame, v: int) -> int:
    """Words of this count and more are at most ``WORD_TABLE``."""
    if v <= WORD_TABLE:
        return 1
    steps = words.groupBy(F.floor(F.log2("count") * 4).cast("int").alias("step")).count().toPandas()
    steps = steps.sort_values("step", ascending=False)
    fits = steps[steps["count"].cumsum() <= WORD_TABLE]
    return math.ceil(2 ** (fits["step"].min() / 4)) if len(fits) else 1 << 62
