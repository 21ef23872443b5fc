"""Shared pieces of the training-data operators.

* ``written`` cuts lineage with a Parquet table in the shared checkpoint folder;
* ``WordHasher`` splits UTF-8 text into words and hashes them, vectorised over Arrow batches;
* ``components`` finds connected components of a link table with Spark joins.
"""

from __future__ import annotations

import ctypes
import gc
import io
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapmart.llm.files import open_fs
from lapmart.operators.joins import input_bytes
from lapmart.sources.rawfiles import scratch_dir

# Bytes of text per Arrow batch sent to a Python worker (set only where the session leaves it open).
ARROW_BATCH_BYTES = 8 * 1024 * 1024
# Bytes of text that the vectorised code holds in 64-bit temporaries at a time.
SEGMENT_BYTES = 1 << 19

_SHIPPED: set[str] = set()
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes, so that long texts don't fill a Python worker, and ships this package to
    the executors (once per application, through the shared folder)."""
    try:
        now = int(spark.conf.get(_BATCH_CONF))
    except Exception:
        now = 2**31 - 1
    if now <= 0 or now > ARROW_BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(ARROW_BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        folder = scratch_dir(spark, "code")
        fs, path = open_fs(folder)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/{root.name}.zip") as out:
            out.write(data.getvalue())
        spark.sparkContext.addPyFile(f"{folder}/{root.name}.zip")
        _SHIPPED.add(app)


def release() -> None:
    """Gives freed memory of a Python worker back to the system; workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` below the shared checkpoint folder and reads it back (cuts the lineage)."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, name)}"
    df.write.parquet(path)
    return reads(spark.read.schema(df.schema).parquet(path), path)


def reads(df: DataFrame, *tables: DataFrame | str) -> DataFrame:
    """Notes on ``df`` the scratch tables that it still reads, for ``dropped``: folders, or tables with such notes."""
    df.scratch = [p for t in tables for p in ([t] if isinstance(t, str) else vars(t).get("scratch", []))]
    return df


def dropped(*tables: DataFrame) -> None:
    """Deletes the scratch tables that ``tables`` read; their last reader must have been written before.

    Input tables have no notes and are never touched.  The driver is then asked
    to collect garbage, whereupon Spark's context cleaner deletes the shuffle
    files of queries that nothing refers to any more.
    """
    paths = {p for t in tables if t is not None for p in vars(t).get("scratch", [])}
    for p in paths:
        fs, path = open_fs(p)
        try:
            fs.delete_dir(path)
        except FileNotFoundError:  # dropped by an earlier call
            pass
    if paths:
        shuffles_freed(tables[0].sparkSession)


def shuffles_freed(spark: SparkSession) -> None:
    """Has the shuffle files of queries that nothing refers to any more deleted."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    while name in df.columns:
        name += "_"
    return name


def salt(col: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


def salted_join(large: DataFrame, small: DataFrame, keys: list[str], by: str, n: int, how: str = "inner") -> DataFrame:
    """Joins ``large`` with the unique-keyed ``small``; rows of one key are dealt to ``n`` tasks by column ``by``."""
    spread = small.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return large.withColumn("_s", salt(F.col(by), n)).join(spread, [*keys, "_s"], how).drop("_s")


# Bytes of Parquet below which a table is broadcast as it is instead of being repeated for salted keys.
FEW_BYTES = 1 << 20


def spread_join(large: DataFrame, small: DataFrame, keys: list[str], by: str, n: int, how: str = "inner") -> DataFrame:
    """As ``salted_join``, for a written ``small``: one of few bytes is broadcast as it is, and a larger one, repeated
    for the salt, is never broadcast (Spark's estimate doesn't see that it is repeated)."""
    if input_bytes(small) <= FEW_BYTES:
        return large.join(F.broadcast(small), keys, how)
    spread = small.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).hint("merge")
    return large.withColumn("_s", salt(F.col(by), n)).join(spread, [*keys, "_s"], how).drop("_s")


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """Marks a written table of long ids for broadcast if it has at most ``rows`` rows; else Spark shuffles."""
    return F.broadcast(df) if df.count() <= rows else df


# --------------------------------------------------------------------------- hashing


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of the hash base, and of its inverse, at least ``n`` of each."""
    if n > len(_POWERS[0]):
        n = max(n, 2 * len(_POWERS[0]))
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b)], dtype=np.uint64) for b in (_BASE, _INV)]
    return _POWERS


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Non-negative 63-bit hashes of the spans of a byte array."""
    power, inverse = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.empty(len(data) + 1, np.uint64)
        total[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
        return (mix64((total[end] - total[start]) * inverse[start]) >> np.uint64(1)).view(np.int64)


class WordHasher:
    """64-bit hashes of the words of a batch of texts.

    ``word_byte``: for each of the 256 bytes whether it belongs to a word.
    A-Z are lower-cased first.  A word's hash depends on its bytes alone.
    Texts are worked off in segments that end at a separator, so temporaries
    stay near ``SEGMENT_BYTES`` whatever the length of a text.
    """

    def __init__(self, word_byte: np.ndarray):
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.lower = lower
        self.word = word_byte[lower]

    def segment(self, data: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple:
        """(hash, start, end, hash of the first bytes for each length in ``prefixes``) of each word of a byte array."""
        inside = self.word[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        start, end = edge[::2], edge[1::2]
        if not len(start):
            return np.empty(0, np.uint64), start, end, [np.empty(0, np.uint64) for _ in prefixes]
        power, inverse = powers(len(data) + 1)
        with np.errstate(over="ignore"):
            total = np.empty(len(data) + 1, np.uint64)
            total[0] = 0
            np.cumsum((self.lower[data].astype(np.uint64) + np.uint64(1)) * power[:len(data)],
                      out=total[1:])
            h = (total[end] - total[start]) * inverse[start]
            firsts = [mix64((total[np.minimum(end, start + m)] - total[start]) * inverse[start]) for m in prefixes]
        return mix64(h), start, end, firsts

    def batch(self, texts: pa.Array, prefixes: tuple[int, ...] = ()):
        """Yields (first row, last row + 1, hashes, words of each row) over a string array, and with ``prefixes``
        the hashes of the words' first bytes.

        Rows come in groups of about ``SEGMENT_BYTES``; a null counts as empty.
        """
        for lo, hi, data, offsets in byte_groups(texts):
            if len(data) <= 2 * SEGMENT_BYTES:
                # a separator between texts keeps words of different rows apart
                sep, n = offsets[1:-1], hi - lo
                shifted = np.insert(data, sep, 32) if n > 1 else data
                h, start, _, firsts = self.segment(shifted, prefixes)
                bounds = offsets + np.r_[np.arange(n), n - 1]
                counts = np.diff(np.searchsorted(start, bounds, "left"))
                yield (lo, hi, h, counts, firsts) if prefixes else (lo, hi, h, counts)
            else:  # one long text
                parts = [self.segment(data[a:b], prefixes) for a, b in self._cuts(data)]
                h = np.concatenate([p[0] for p in parts])
                firsts = [np.concatenate([p[3][j] for p in parts]) for j in range(len(prefixes))]
                counts = np.array([len(h)])
                yield (lo, hi, h, counts, firsts) if prefixes else (lo, hi, h, counts)

    def _cuts(self, data: np.ndarray):
        at = 0
        while at < len(data):
            to = min(len(data), at + SEGMENT_BYTES)
            while to < len(data) and self.word[data[to - 1]] and self.word[data[to]]:
                step = self.word[data[to:to + SEGMENT_BYTES]]
                gap = np.flatnonzero(~step)
                to += int(gap[0]) if len(gap) else len(step)
            yield at, to
            at = to


def byte_groups(texts: pa.Array, most: int = SEGMENT_BYTES):
    """Yields (first row, last row + 1, bytes, offsets) of consecutive rows of about ``most`` bytes;
    a text of more than that comes alone."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    off = off.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        hi = min(hi, len(texts))
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def ascii_space_words() -> np.ndarray:
    """Word bytes of ``[^\\x20\\x09-\\x0D]+``."""
    m = np.ones(256, bool)
    m[[0x20, 9, 10, 11, 12, 13]] = False
    return m


def letter_digit_words() -> np.ndarray:
    """Word bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` in lower-cased text."""
    m = np.zeros(256, bool)
    m[0x30:0x3A] = m[0x61:0x7B] = m[0x80:] = True
    return m


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each run of ``k`` words (by the index of its first word)."""
    if len(h) < k:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(len(h) - k + 1, np.uint64(k))
        for j in range(k):
            out = out * np.uint64(0xD6E8FEB86659FD93) + h[j:len(h) - k + 1 + j]
    return mix64(out)


def row_of_word(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def shingle_sets(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles per row: (hashes sorted within rows, size of each row's set).

    A row of fewer than ``k`` words, but not none, has its whole sequence as one shingle.
    """
    rows = row_of_word(counts)
    s = shingle_hashes(h, k)
    if len(s):
        same = rows[:len(s)] == rows[k - 1:]
        s, r = s[same], rows[:len(same)][same]
    else:
        r = rows[:0]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        first = np.cumsum(counts) - counts
        extra = np.array([shingle_hashes(h[first[i]:first[i] + counts[i]], int(counts[i]))[0] for i in short],
                         np.uint64)
        s, r = np.concatenate([s, extra]), np.concatenate([r, short])
    order = np.lexsort((s, r))
    s, r = s[order], r[order]
    if len(s):
        keep = np.r_[True, (s[1:] != s[:-1]) | (r[1:] != r[:-1])]
        s, r = s[keep], r[keep]
    return s, np.bincount(r, minlength=len(counts))


# --------------------------------------------------------------------------- components


# A hub's links are dealt to so many tasks; the label table is repeated as often.
HUB_SALT = 32


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``links(a long, b long)``: (node, component = smallest node).

    Minimum labels travel along the links and jump along the labels until
    nothing changes; each round is written to the shared folder.  Minima are
    combined map-side, and both joins are salted, so a hub with a third of
    all links is no single task.  Nodes without links don't appear.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = written(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                   f"{name}-links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("label")), f"{name}-l0")
    def total(df: DataFrame):
        return df.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]

    last, rounds = total(labels), 0
    while last is not None:
        rounds += 1
        spread = labels.select(F.col("node").alias("at"), F.col("label").alias("to"))
        # jump along the labels, and take the least label of the neighbours
        jump = spread_join(labels.select("node", F.col("label").alias("at")), spread, ["at"], "node", HUB_SALT)
        near = spread_join(both.select(F.col("a").alias("node"), F.col("b").alias("at")), spread, ["at"], "node",
                           HUB_SALT)
        jump, near = (x.select("node", F.col("to").alias("label")) for x in (jump, near))
        older = labels
        labels = written(jump.union(near).groupBy("node").agg(F.min("label").alias("label")), f"{name}-l{rounds}")
        del spread, jump, near
        dropped(older)
        now = total(labels)
        if now == last:
            break
        last = now
    dropped(both)
    return reads(labels.select("node", F.col("label").alias("component")), labels)
