"""Source divergence audit (13): term distributions of sources compared, with late string materialization.

For each language the terms in at least ``LEAST_DOCS`` of its documents are
kept; each of its sources, and the language as a whole, gives every kept term
a smoothed share in parts of 10**9.  Reported are the divergence of each
source from each other one, and the terms of which a source has most too much.

1. Tasks count terms per (lang, source) and shuffle (lang, source, 64-bit term digest, occurrences, documents):
   no term travels.  One exchange by (lang, digest) serves the counts, the documents of a term and its total.
2. The distinct terms of kept digests alone travel once, for each digest's minimum and maximum string.  Where the
   two differ, digests have collided: their terms are counted again by their strings, and only theirs.
3. Pairs of sources: the shares of a block of terms are a matrix of sources by terms in one task, whose sums for
   each two sources leave it; a block has ``CELLS`` places about, so a language of any size is spread.
4. Strings are joined back for the reported terms alone, ties at the last rank included.

Integer arithmetic is exact for up to 9 * 10**15 occurrences of terms in a language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapmart.llm.common import SEGMENT_BYTES, byte_groups, prepare, salted_join, small_enough, span_hashes, written

LEAST_DOCS = 3
TOP = 200
# Places (sources x terms) of a block's matrix.
CELLS = 1 << 19
# Rows that a task collects before it hands them on.
HELD_ROWS = 1 << 20
# Rows of the (lang, source) table, or of colliding digests, that are broadcast at most.
BROADCAST_ROWS = 200_000
ONE = 1_000_000_000


def _term_table() -> tuple[np.ndarray, np.ndarray]:
    """Lower-casing of A-Z, and whether a byte belongs to a term ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``."""
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 32
    inside = np.zeros(256, bool)
    inside[0x41:0x5B] = inside[0x61:0x7B] = inside[0x80:] = True
    return lower, inside


_LOWER, _INSIDE = _term_table()


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets of the rows in them) of a group of rows; one long text comes in parts that end between terms."""
    if len(offsets) > 2 or len(data) <= 2 * SEGMENT_BYTES:
        yield data, offsets
        return
    at = 0
    while at < len(data):
        to = min(len(data), at + SEGMENT_BYTES)
        while to < len(data) and _INSIDE[data[to - 1]] and _INSIDE[data[to]]:
            gap = np.flatnonzero(~_INSIDE[data[to:to + SEGMENT_BYTES]])
            to += int(gap[0]) if len(gap) else len(data[to:to + SEGMENT_BYTES])
        yield data[at:to], np.array([0, to - at])
        at = to


def _terms(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(row, number of its term, the terms) of all occurrences, group by group; rows ascend over the groups."""
    for lo, hi, data, offsets in byte_groups(texts):
        for part, rows in _segments(data, offsets):
            # a separator between rows keeps their terms apart
            sep = rows[1:-1]
            part = np.insert(part, sep, 32) if len(sep) else part
            bounds = rows[:-1] + np.arange(len(rows) - 1)
            inside = _INSIDE[part]
            edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
            start, end = edge[::2], edge[1::2]
            ends = np.r_[0, np.cumsum(end - start)].astype(np.int64)
            chars = _LOWER[part[inside]]
            words = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(chars)])
            coded = words.dictionary_encode()
            row = np.searchsorted(bounds, start, "right") - 1 + lo
            yield row, coded.indices.to_numpy(), coded.dictionary


def _digests(terms: pa.Array, bits: int) -> np.ndarray:
    """Digests of ``bits`` bits of the terms of an unsliced large binary array."""
    _, ends, chars = terms.buffers()
    ends = np.frombuffer(ends, np.int64)[:len(terms) + 1] if len(terms) else np.zeros(1, np.int64)
    chars = np.frombuffer(chars, np.uint8) if chars is not None else np.empty(0, np.uint8)
    return span_hashes(chars, ends[:-1], ends[1:]) >> (63 - bits)


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Values summed by key, keys ascending."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    if not len(order):
        return keys, values
    new = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
    return [k[new] for k in keys], [np.add.reduceat(v[order], new) for v in values]


class _Counts:
    """Occurrences and documents of the terms of (lang, source) groups, until they are handed on."""

    def __init__(self, bits: int, strings: bool):
        self.bits, self.strings = bits, strings
        self.clear()

    def clear(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.terms: dict[bytes, int] = {}
        self.parts: list[tuple] = []
        self.rows = 0

    def add(self, lang: list[str], source: list[str], texts: pa.Array) -> None:
        group = np.array([self.groups.setdefault(x, len(self.groups)) for x in zip(lang, source, strict=True)], np.int64)
        seen = [np.empty(0, np.int64)] * 2  # (row, term) of the last row, which may go on in the next part
        for row, code, terms in _terms(texts):
            if not len(row):
                continue
            if self.strings:
                each = np.array([self.terms.setdefault(t, len(self.terms)) for t in terms.to_pylist()], np.int64)
            else:
                each = _digests(terms, self.bits)
            (r, t), (n,) = _summed([row, each[code]], [np.ones(len(row), np.int64)])
            fresh = ~((r == r[0]) & np.isin(t, seen[1][seen[0] == r[0]]))
            (g, t2), (n, d) = _summed([group[r], t], [n, fresh.astype(np.int64)])
            self.parts.append((g, t2, n, d))
            self.rows += len(g)
            last = r == r[-1]
            if r[0] == r[-1] and len(seen[0]) and seen[0][0] == r[0]:
                seen = [np.concatenate([seen[0], r]), np.concatenate([seen[1], t])]
            else:
                seen = [r[last], t[last]]

    def reduced(self) -> tuple[np.ndarray, ...]:
        (g, t), (n, d) = _summed([np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts])],
                                 [np.concatenate([p[j] for p in self.parts]) for j in (2, 3)])
        self.parts, self.rows = [(g, t, n, d)], len(g)
        return g, t, n, d

    def batch(self) -> pa.RecordBatch:
        g, t, n, d = self.reduced()
        names = list(self.groups)
        columns = [pa.array([x[j] for x in names], pa.string()).take(pa.array(g)) for j in (0, 1)]
        if self.strings:
            terms = pa.array(list(self.terms), pa.large_binary())
            digests = _digests(terms, self.bits)[t]
            columns += [pa.array(digests), terms.cast(pa.large_string()).cast(pa.string()).take(pa.array(t))]
        else:
            columns.append(pa.array(t))
        self.clear()
        kinds = ["lang", "source", "digest", *(["term"] if self.strings else []), "n", "docs"]
        return pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(d)], kinds)


def _counted(docs: DataFrame, bits: int, strings: bool = False) -> DataFrame:
    """(lang, source, digest[, term], n, docs) as counted in the tasks; a key may come from several of them."""
    def count(batches):
        held = _Counts(bits, strings)
        for batch in batches:
            held.add(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"))
            if held.rows > HELD_ROWS:
                held.reduced()
                if held.rows > HELD_ROWS // 2:
                    yield held.batch()
        if held.rows:
            yield held.batch()

    return docs.mapInArrow(count, "lang string, source string, digest long, "
                           + ("term string, " if strings else "") + "n long, docs long")


def _strings(docs: DataFrame, bits: int) -> DataFrame:
    """(digest, term): the distinct terms of each task, some of them more than once."""
    def distinct(batches):
        held: list[pa.Array] = []

        def out():
            terms = pa.chunked_array(held, pa.large_binary()).unique()
            held.clear()
            return terms

        def rows(terms):
            return pa.RecordBatch.from_arrays(
                [pa.array(_digests(terms, bits)), terms.cast(pa.large_string()).cast(pa.string())], ["digest", "term"])

        for batch in batches:
            held += [terms for _, _, terms in _terms(batch.column("text"))]
            if sum(map(len, held)) > HELD_ROWS:
                held.append(out())
                if len(held[0]) > HELD_ROWS // 2:
                    yield rows(out())
        if held:
            yield rows(out())

    return docs.select("text").mapInArrow(distinct, "digest long, term string")


def _kept(counts: DataFrame, term: list[str], least_docs: int) -> DataFrame:
    """(lang, source, *term, n, total, first) of terms in enough documents; ``first`` marks one row of each term."""
    summed = (counts.repartition("lang", *term).groupBy("lang", *term, "source")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    each = Window.partitionBy("lang", *term)
    return (summed.withColumn("all_docs", F.sum("docs").over(each)).withColumn("total", F.sum("n").over(each))
            .withColumn("first", F.row_number().over(each.orderBy("source")) == 1)
            .where(F.col("all_docs") >= least_docs)
            .select("lang", "source", *term, "n", "total", "first"))


def _share(count: Column, of: Column) -> Column:
    """1 + floor(10**9 * count / of) for count <= of < 9 * 10**15, in long arithmetic: three digits at a time."""
    out, rest = F.lit(1).cast("long"), count.cast("long")
    for scale in (1_000_000, 1_000, 1):
        rest = rest * 1000
        out = out + F.call_function("div", rest, of) * scale
        rest = rest % of
    return out


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over a block's terms for each two sources; rows without digest bring the sources and their least shares."""
    table = pa.Table.from_batches(batches).combine_chunks()
    zero = table.column("digest").is_null().to_numpy()
    lang = table.column("lang")[0].as_py()
    names = table.column("source").to_numpy(zero_copy_only=False)
    share = table.column("p").to_numpy()
    sources, at = np.unique(names[zero], return_index=True)
    least = share[zero][at]
    terms = table.filter(pa.array(~zero))
    row = np.searchsorted(sources, names[~zero])
    split = terms.column("split").combine_chunks().dictionary_encode()
    code = split.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    key = np.stack([terms.column("digest").to_numpy(), code])
    unique, column = np.unique(key, axis=1, return_inverse=True)
    shares = np.repeat(least[:, None], unique.shape[1], axis=1)
    shares[row, column.ravel()] = share[~zero]
    items = pa.array(sources.tolist(), pa.string())
    for a, name in enumerate(sources):
        d = shares[a] - shares
        value = (d * d // shares).sum(axis=1)
        keep = np.arange(len(sources)) != a
        m = int(keep.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * m, pa.string()), pa.array([name] * m, pa.string()), items.filter(pa.array(keep)),
             pa.array(value[keep].astype(np.int64))], ["lang", "source", "item", "value"])


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, bits: int = 63) -> DataFrame:
    """Divergence of the sources of each language of ``docs(lang, source, text)``.

    Returns lang, source, part, item, value, rank.  With p and q smoothed
    shares, 1 + floor(10**9 (count + 1) / (N + V)) for V kept terms of which
    N occur: part ``pair`` has each other source of the language with the sum
    of floor((p - q)**2 / q) over all kept terms, q being the other's share;
    part ``term`` the ``top`` kept terms of the source whose share p is above
    the language's, q, by floor((p - q)**2 / q).  Ranks go by value
    descending, then item ascending by its UTF-8 bytes.

    Null texts, langs and sources count as empty; a source without terms is
    compared like any other, a language with one source has no pairs, and one
    without kept terms has pairs of value 0; repeated rows are documents of
    their own; other columns are ignored; an empty table gives no rows.
    ``bits``: size of the digests; whatever it is, results are exact.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = written(_kept(_counted(docs, bits), ["digest"], least_docs), "audit-kept")
    digests = kept.select("digest").distinct()
    strings = written(_strings(docs, bits).join(digests, "digest", "left_semi").groupBy("digest")
                      .agg(F.min("term").alias("term"), F.max("term").alias("last")), "audit-strings")
    collided = strings.where(F.col("term") != F.col("last")).select("digest")
    kept = kept.withColumn("split", F.lit(None).cast("string"))
    if not collided.isEmpty():
        few = small_enough(collided, BROADCAST_ROWS)
        again = _kept(_counted(docs, bits, strings=True).join(few, "digest", "left_semi"), ["digest", "term"], least_docs)
        again = again.withColumnRenamed("term", "split")
        kept = written(kept.join(few, "digest", "left_anti").unionByName(again), "audit-split")

    langs = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("lang_n"))
    groups = (docs.select("lang", "source").distinct()
              .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("source_n")), ["lang", "source"], "left")
              .join(langs, "lang", "left").na.fill(0, ["source_n", "v", "lang_n"]))
    same = Window.partitionBy("lang")
    groups = written(groups.withColumn("blocks", F.ceil(F.col("v") * F.count("*").over(same) / F.lit(CELLS)) + 1),
                     "audit-groups")
    if groups.count() <= BROADCAST_ROWS:
        shares = kept.join(F.broadcast(groups), ["lang", "source"])
    else:
        shares = salted_join(kept, groups, ["lang", "source"], "digest", 32)
    shares = shares.withColumn("p", _share(F.col("n") + 1, F.col("source_n") + F.col("v")))

    rows = shares.select("lang", F.pmod(F.xxhash64("digest", "split"), "blocks").alias("block"), "source", "digest",
                         "split", "p")
    least = F.when(F.col("v") > 0, _share(F.lit(1), F.col("source_n") + F.col("v"))).otherwise(1)
    zeros = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                          "source", F.lit(None).cast("long").alias("digest"), F.lit(None).cast("string").alias("split"),
                          least.alias("p"))
    pairs = (rows.unionByName(zeros).groupBy("lang", "block")
             .applyInArrow(_pair_sums, "lang string, source string, item string, value long")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))

    q = _share(F.col("total") + 1, F.col("lang_n") + F.col("v"))
    group = Window.partitionBy("lang", "source")
    over = (shares.withColumn("q", q).where(F.col("p") > F.col("q"))
            .select("lang", "source", "digest", "split", _excess(F.col("p"), F.col("q")).alias("value"))
            .withColumn("_rank", F.rank().over(group.orderBy(F.desc("value")))).where(F.col("_rank") <= top))
    terms = (over.join(strings.select("digest", "term"), "digest")
             .select("lang", "source", F.lit("term").alias("part"), F.coalesce("split", "term").alias("item"), "value"))
    ranked = F.row_number().over(group.orderBy(F.desc("value"), "item"))
    return (pairs.withColumn("rank", ranked)
            .unionByName(terms.withColumn("rank", ranked).where(F.col("rank") <= top)))
