"""Packing by lexical retrieval: seeds, BM25 neighbours, windows.

Each document's ids are cut into whole windows, which are sequences of their
own, and a tail shorter than a window.  The tails are ordered by content and
cut into shards of about ``SHARD_TOKENS`` ids; each shard has an inverted index
over ids with BM25 weights, whose document frequencies, count and mean length
come from all tails.  The order is by min-hashes over a tail's distinct ids,
weighted by a power of their inverse document frequency: two tails agree in
one as likely as their weighted sets are similar.  Tails of a frequent first
min-hash are parted by the second, and so on, at last by number.  A neighbour
in another shard is not found; how often is in the README.  In a shard, the
first unused tail is a seed; the index returns its
unused neighbours, best first, which fill the window; the last one is cut and
what is left of it stays unused.  A shard's last, unfilled window is cut into
sequences of powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapmart.llm.bpe import encoder, forget
from lapmart.llm.common import prepare, reads, release, written

WINDOW = 2048
# Ids in a shard's index: the memory of one packing task.
SHARD_TOKENS = 1_500_000
# How many ids of a seed make its query: all.
QUERY_TERMS = None
K1, B = 1.2, 0.75
# Min-hashes that order the tails, and the power of an id's idf that is its weight in them.
ROUTING_KEYS = 4
ROUTING_POWER = 2

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_UNITS = "unit long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def _cut(docs: DataFrame, vocabulary: str, end_id: int, window: int) -> DataFrame:
    """Whole windows (ids null) and tails (with ids) of each document; ``unit`` numbers them."""

    def cut(batches):
        from pyspark import TaskContext

        release()  # what earlier stages have left in this worker
        unit = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text")
            for lo, hi, ids, counts in encoder(vocabulary).groups(texts, end_id):
                data = memoryview(ids.astype("<u4").tobytes())
                rows, at = [], 0
                for key, n in zip(keys.slice(lo, hi - lo).to_pylist(), counts.tolist()):
                    for start in range(0, n, window):
                        part = data[at + 4 * start:at + 4 * min(start + window, n)]
                        whole = len(part) == 4 * window
                        rows.append((unit, key, start, len(part) // 4, zlib.crc32(part), n,
                                     None if whole else bytes(part)))
                        unit += 1
                    at += 4 * n
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.binary())],
                    ["unit", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(cut, _UNITS)


def _tail_arrays(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and the number of each row's."""
    rows = ids.to_pylist()
    return np.frombuffer(b"".join(rows), "<u4"), np.fromiter(map(len, rows), np.int64, len(rows)) // 4


# Ids of a vocabulary lie below this; a larger one is refused.
SPAN = 1 << 16


def _pairs(ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sorted (tail, id) pairs as one integer each, of 32 bits where that is enough."""
    if len(ids) and int(ids.max()) >= SPAN:
        raise ValueError(f"ids of {SPAN} and above cannot be packed")
    kind = np.uint32 if len(n) < SPAN else np.uint64
    key = np.repeat(np.arange(len(n), dtype=kind) * kind(SPAN), n) + ids.astype(kind)
    key.sort()
    return key


def document_frequencies(tails: DataFrame, end_id: int) -> DataFrame:
    """(term, df) over all tails; the end id is no term."""

    def count(batches):
        forget()
        release()
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids, n = _tail_arrays(batch.column("ids"))
            key = _pairs(ids, n)
            found = np.bincount(key[np.r_[True, key[1:] != key[:-1]]] % SPAN) if len(key) else np.zeros(0, np.int64)
            if len(found) > len(total):
                total = np.pad(total, (0, len(found) - len(total)))
            total[:len(found)] += found
        terms = np.flatnonzero(total)
        if len(terms):
            yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.int64()),
                                              "df": pa.array(total[terms], pa.int64())})

    return (tails.select("ids").mapInArrow(count, "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")).where(F.col("term") != end_id))


def routing_ranks(df: np.ndarray, idf: np.ndarray) -> list[np.ndarray]:
    """For each min-hash the rank of every id; ids of a single tail, which bring none together, rank last."""
    weight = np.where(df > 1, idf, 0.0) ** ROUTING_POWER
    out = []
    for key in range(ROUTING_KEYS):
        draw = -np.log1p(-np.random.default_rng(key).random(len(df)))
        at = np.divide(draw, weight, out=np.full(len(df), np.inf), where=weight > 0)
        rank = np.empty(len(df), np.int64)
        rank[np.argsort(at, kind="stable")] = np.arange(len(df))
        out.append(np.where(weight > 0, rank, len(df)))
    return out


def routing_keys(ids: np.ndarray, lengths: np.ndarray, ranks: list[np.ndarray]) -> list[np.ndarray]:
    """The min-hashes of each tail; no tail is empty."""
    at = np.cumsum(lengths) - lengths
    return [np.minimum.reduceat(rank[ids], at) if len(at) else at for rank in ranks]


# An id that more than this share of a shard's tails have is a row of weights, not a list: at most
# SHARD_TOKENS / COMMON weights of 8 bytes.
COMMON = 0.2


class ShardIndex:
    """BM25 inverted index of one shard: for each id its tails and their weights; of common ids the weights of all."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, idf: np.ndarray, mean_length: float):
        self.n = len(lengths)
        key = _pairs(ids, lengths)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        tf = np.diff(np.r_[first, len(key)]).astype(np.int32)
        unit, term = (key[first] // SPAN).astype(np.int32), (key[first] % SPAN).astype(np.int32)
        del key, first
        known = idf[term] > 0
        unit, term, tf = unit[known], term[known], tf[known]
        self.doc_terms = term
        self.doc_at = np.searchsorted(unit, np.arange(self.n + 1))
        norm = K1 * (1 - B + B * lengths / mean_length)
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[unit])
        order = np.argsort(term, kind="stable")
        self.unit, self.weight = unit[order], weight[order].astype(np.float64)
        del unit, weight, tf, known
        self.at = np.searchsorted(term[order], np.arange(len(idf) + 1))
        found = np.diff(self.at)
        common = np.flatnonzero(found > COMMON * self.n)
        self.row = np.full(len(idf), -1)
        self.row[common] = np.arange(len(common))
        self.columns, self.common = np.arange(self.n), np.zeros((len(common), self.n))
        row = np.repeat(self.row, found)
        listed = row < 0
        self.common[row[~listed], self.unit[~listed]] = self.weight[~listed]
        self._keep_postings(listed)

    def _keep_postings(self, kept: np.ndarray) -> None:
        self.at = np.r_[0, np.cumsum(kept)][self.at]
        self.unit, self.weight = self.unit[kept], self.weight[kept]

    def keep(self, free: np.ndarray) -> None:
        """Drops the postings of all other tails, which score 0 from now on."""
        self._keep_postings(free[self.unit])
        kept = free[self.columns]
        self.columns, self.common = self.columns[kept], self.common[:, kept]

    def scores(self, seed: int) -> np.ndarray:
        terms = self.doc_terms[self.doc_at[seed]:self.doc_at[seed + 1]]
        rows = self.row[terms]
        listed = terms[rows < 0]
        spans = [(a, b) for a, b in zip(self.at[listed].tolist(), self.at[listed + 1].tolist()) if a < b]
        out = np.zeros(self.n)
        if spans:
            out = np.bincount(np.concatenate([self.unit[a:b] for a, b in spans]),
                              np.concatenate([self.weight[a:b] for a, b in spans]), self.n)
        # added row by row, so equal tails have equal scores
        total = np.zeros(len(self.columns))
        for row in rows[rows >= 0].tolist():
            np.add(total, self.common[row], out=total)
        out[self.columns] += total
        return out


def pack_shard(ids: np.ndarray, lengths: np.ndarray, idf: np.ndarray, mean_length: float,
               window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (tail, first id in the tail, ids); every id is used once."""
    index = ShardIndex(ids, lengths, idf, mean_length)
    taken = np.zeros(len(lengths), np.int64)
    free = lengths > 0
    indexed = int(free.sum())
    sequences = []

    def take(unit: int, room: int) -> tuple[int, int, int]:
        start, n = int(taken[unit]), int(min(room, lengths[unit] - taken[unit]))
        taken[unit] += n
        free[unit] = taken[unit] < lengths[unit]
        return unit, start, n

    seed = 0
    while seed < len(lengths):
        if not free[seed]:
            seed += 1
            continue
        pieces = [take(seed, window)]
        room = window - pieces[0][2]
        left = int(free.sum())
        if left < 0.75 * indexed:
            index.keep(free)
            indexed = left
        if room:
            score = np.where(free, index.scores(seed), -1.0)
            ask = 16
            while room and free.any():
                best = np.argpartition(-score, min(ask, len(score)) - 1)[:ask]
                for unit in best[np.lexsort((best, -score[best]))].tolist():
                    if room and score[unit] > 0 and free[unit]:
                        pieces.append(take(unit, room))
                        room -= pieces[-1][2]
                    score[unit] = -1.0
                if score.max() <= 0:
                    break
                ask *= 4
            while room:  # nothing like the seed is left: the next in order
                rest = seed + int(np.argmax(free[seed:]))
                if not free[rest]:
                    break
                pieces.append(take(rest, room))
                room -= pieces[-1][2]
        sequences.append(pieces)
    if sequences and sum(n for _, _, n in sequences[-1]) < window:
        sequences[-1:] = split_powers(sequences[-1])
    return sequences


def split_powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Cuts a sequence into sequences of powers of two, the largest first."""
    total = sum(n for _, _, n in pieces)
    out, queue = [], list(pieces)
    for power in (1 << i for i in range(total.bit_length() - 1, -1, -1) if total >> i & 1):
        part, room = [], power
        while room:
            unit, start, n = queue.pop(0)
            use = min(n, room)
            part.append((unit, start, use))
            if use < n:
                queue.insert(0, (unit, start + use, n - use))
            room -= use
        out.append(part)
    return out


def pack(docs: DataFrame, vocabulary: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Packs ``docs(doc_id, text)`` into windows; returns one row per piece (columns of ``PIECES``).

    A null text is empty and gives its end id alone; null doc_ids and repeated
    rows are packed like any other; other columns are ignored; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    units = written(_cut(docs, vocabulary, end_id, window), "pack-units")
    whole = (units.where(F.col("ids").isNull())
             .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                     (F.col("unit") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    tails = units.where(F.col("ids").isNotNull()).select("unit", "doc_id", "start", "doc_tokens", "ids")
    totals = units.where(F.col("ids").isNotNull()).agg(F.count("*").alias("n"), F.sum("length").alias("t")).first()
    if not totals["n"]:
        return whole
    # bounded by the vocabulary
    frequency = document_frequencies(tails, end_id).toPandas()
    size = int(max(frequency["term"].max() if len(frequency) else 0, end_id)) + 1
    df = np.zeros(size)
    df[frequency["term"]] = frequency["df"]
    idf = np.where(df > 0, np.log1p((totals["n"] - df + 0.5) / (df + 0.5)), 0.0)
    shared = spark.sparkContext.broadcast(idf)
    ranks = spark.sparkContext.broadcast(routing_ranks(df, idf))
    mean, n_shards = totals["t"] / totals["n"], -(-totals["t"] // SHARD_TOKENS)

    keys = [f"key{i}" for i in range(ROUTING_KEYS)]

    def route(batches):
        forget()
        for batch in batches:
            found = routing_keys(*_tail_arrays(batch.column("ids")), ranks.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(k, pa.int64()) for k in found)],
                                             [*batch.schema.names, *keys])

    def shard(batches):
        forget()
        release()
        batches = list(batches)
        if sum(map(len, batches)):
            yield from pack_table(pa.Table.from_batches(batches)).to_batches()
        del batches
        release()

    def pack_table(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("unit")
        number = table.column("shard")[0].as_py()
        docs_of, starts = table.column("doc_id").to_pylist(), table.column("start").to_pylist()
        totals_of = table.column("doc_tokens").to_pylist()
        ids, lengths = _tail_arrays(table.column("ids"))
        at = np.cumsum(lengths) - lengths
        rows = []
        for i, pieces in enumerate(pack_shard(ids, lengths, shared.value, mean, window)):
            offset = 0
            for unit, start, n in pieces:
                a = at[unit] + start
                rows.append((docs_of[unit], starts[unit] + start, n, zlib.crc32(ids[a:a + n].tobytes()),
                             totals_of[unit], ((number << 24) + i) * 2 + 1, offset))
                offset += n
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    routed = tails.mapInArrow(route, ", ".join(["unit long, doc_id long, start long, doc_tokens long, ids binary",
                                                *(f"{k} long" for k in keys)]))
    # a partition is a shard; the partition's own number, which later coalescing doesn't change
    packed = (routed.repartitionByRange(int(n_shards), *keys, "unit").drop(*keys)
              .withColumn("shard", F.spark_partition_id()).mapInArrow(shard, PIECES))
    return reads(whole.unionByName(packed), units)
