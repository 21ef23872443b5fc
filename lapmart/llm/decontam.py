"""Benchmark decontamination by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of an item (a shorter item is one
window), and a document contains it exactly or not at all, so of a window's
shingles, ordered by rarity in the documents, one is the necessary prefix: the
rarest.  Documents are joined with these prefix shingles only.  A match fixes
where the window would lie (positional bound) and must leave room for it in
the document (length bound); then the whole item-sized window is compared.

Document frequencies of the items' shingles are counted over all documents.
The items' shingles and windows are worked off in blocks of at most
``BLOCK_WINDOWS`` windows, so what a task holds has a fixed bound however
large the benchmark is; the results of the blocks are united per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapmart.llm.common import (WordHasher, dropped, letter_digit_words, mix64, prepare, reads, row_of_word,
                                shingle_hashes, written)

WINDOW = 13
SHINGLE = 3
# Windows held by a task at a time: about 40 MB.
BLOCK_WINDOWS = 1_000_000


def _window_key(h: np.ndarray, k: int) -> np.ndarray:
    return shingle_hashes(mix64(h), k)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows: n_words, shingle length, key, the hash of each shingle, and the items that have it."""

    def cut(batches):
        hasher = WordHasher(letter_digit_words())
        for batch in batches:
            items = batch.column("item_id").to_pylist()
            rows = []
            for lo, hi, h, counts in hasher.batch(batch.column("text")):
                ends = np.cumsum(counts)
                for i in range(hi - lo):
                    w = h[ends[i] - counts[i]:ends[i]]
                    n = min(WINDOW, len(w))
                    if not n:
                        continue
                    k = min(SHINGLE, n)
                    s, keys = shingle_hashes(w, k).view(np.int64), _window_key(w, n).view(np.int64)
                    rows += [(items[lo + i], n, k, int(keys[j]), s[j:j + n - k + 1].tolist())
                             for j in range(len(keys))]
            if rows:
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], batch.schema.field("item_id").type), pa.array(c[1], pa.int32()),
                     pa.array(c[2], pa.int32()), pa.array(c[3], pa.int64()), pa.array(c[4], pa.list_(pa.int64()))],
                    ["item_id", "n", "k", "key", "shingles"])

    kind = dict(benchmark.dtypes)["item_id"]
    return (benchmark.select("item_id", "text")
            .mapInArrow(cut, f"item_id {kind}, n int, k int, key long, shingles array<long>"))


def _in_sorted(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into values, index into the sorted table) of values that the table has."""
    if not len(table) or not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # most values miss: a small bitmap over 16 bits settles them without a search
    bits = np.zeros(1 << 16, bool)
    bits[(table.view(np.uint64) >> np.uint64(48)).astype(np.int64)] = True
    maybe = np.flatnonzero(bits[(values.view(np.uint64) >> np.uint64(48)).astype(np.int64)])
    at = np.minimum(np.searchsorted(table, values[maybe]), len(table) - 1)
    ok = table[at] == values[maybe]
    return maybe[ok], at[ok]


def shingle_frequencies(docs: DataFrame, held: Broadcast) -> DataFrame:
    """(k, shingle, df): in how many documents each shingle of the sorted tables (by length) occurs."""

    def count(batches):
        shingles = held.value
        hasher = WordHasher(letter_digit_words())
        totals = {k: np.zeros(len(t), np.int64) for k, t in shingles.items()}
        for batch in batches:
            for _, _, h, counts in hasher.batch(batch.column("text")):
                rows = row_of_word(counts)
                for k, t in shingles.items():
                    s = shingle_hashes(h, k).view(np.int64)
                    i, at = _in_sorted(s, t)
                    inside = rows[i] == rows[i + k - 1]
                    seen = np.unique(rows[i[inside]].astype(np.int64) * len(t) + at[inside])
                    totals[k] += np.bincount(seen % len(t), minlength=len(t)) if len(t) else 0
        for k, t in shingles.items():
            some = np.flatnonzero(totals[k])
            if len(some):
                yield pa.RecordBatch.from_pydict({"k": pa.array(np.full(len(some), k), pa.int32()),
                                                  "shingle": t[some], "df": totals[k][some]})

    return (docs.select("text").mapInArrow(count, "k int, shingle long, df long")
            .groupBy("k", "shingle").agg(F.sum("df").alias("df")))


def _spans(words: np.ndarray, prefixes: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, window) of each occurrence in one document.

    prefixes: for each shingle length its sorted shingles, and for each of
    them the windows that need it with their length, the shingle's place in
    the window and the window's key.
    """
    found = []
    for k, table, start, window, n, place, key in prefixes:
        if len(words) < k:
            continue
        i, at = _in_sorted(shingle_hashes(words, k).view(np.int64), table)
        if not len(i):
            continue
        # all windows that need the matched shingle
        each = start[at + 1] - start[at]
        entry = np.repeat(start[at], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        first = np.repeat(i, each) - place[entry]
        fits = (first >= 0) & (first + n[entry] <= len(words))
        first, entry = first[fits], entry[fits]
        for size in np.unique(n[entry]):
            of = n[entry] == size
            f, e = first[of], entry[of]
            h = _window_key(words[f[:, None] + np.arange(size)].ravel(), int(size))[::size] if len(f) else f
            same = h.view(np.int64) == key[e]
            found.append((f[same], np.full(int(same.sum()), size), window[e[same]]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found))


def _merge(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint sorted spans of the same words."""
    if not len(first):
        return first, size
    order = np.argsort(first, kind="stable")
    first, end = first[order], (first + size)[order]
    reach = np.maximum.accumulate(end)
    new = np.r_[True, first[1:] > reach[:-1]]
    lo = first[new]
    return lo, reach[np.r_[np.flatnonzero(new)[1:] - 1, len(first) - 1]] - lo


def occurrences(docs: DataFrame, held: Broadcast) -> DataFrame:
    """Each document's other columns, n_words, hit words as disjoint spans, and the items with occurring windows.

    held: what ``_tables`` gives for the windows.
    """
    keep = [c for c in docs.columns if c != "text"]

    def search(batches):
        prefixes, items = held.value
        hasher = WordHasher(letter_digit_words())
        for batch in batches:
            n_words, firsts, sizes, found = [], [], [], []
            for lo, hi, h, counts in hasher.batch(batch.column("text")):
                rows_of, ends = row_of_word(counts), np.cumsum(counts)
                touched = set()
                for k, table, *_ in prefixes:
                    i, _ = _in_sorted(shingle_hashes(h, k).view(np.int64), table)
                    touched.update(rows_of[i].tolist())
                n_words += counts.tolist()
                for r in range(hi - lo):
                    if r not in touched:
                        firsts.append(())
                        sizes.append(())
                        found.append(())
                        continue
                    first, size, window = _spans(h[ends[r] - counts[r]:ends[r]], prefixes)
                    first, size = _merge(first, size)
                    firsts.append(first.tolist())
                    sizes.append(size.tolist())
                    found.append(sorted({x for w in np.unique(window).tolist() for x in items[w]}))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(n_words, pa.int64()), pa.array(firsts, longs),
                 pa.array(sizes, longs), pa.array(found, pa.list_(pa.string()))],
                [*keep, "n_words", "firsts", "sizes", "items"])

    kinds = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(
        search, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep),
                           "n_words long, firsts array<long>, sizes array<long>, items array<string>"]))


def prefix_windows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Distinct windows with their necessary prefix: n, k, key, shingle, place, items (written)."""
    windows = written(item_windows(benchmark), "decontam-windows")
    shingles = written(windows.select("k", F.explode("shingles").alias("shingle")).distinct(), "decontam-shingles")
    blocks = -(-shingles.count() // BLOCK_WINDOWS)
    frequency = None
    for b in range(blocks):
        part = shingles.where(F.pmod(F.xxhash64("shingle"), F.lit(blocks)) == b).toPandas()
        tables = {int(k): np.sort(x["shingle"].to_numpy()) for k, x in part.groupby("k")}
        held = docs.sparkSession.sparkContext.broadcast(tables)
        counted = written(shingle_frequencies(docs, held), "decontam-df")
        held.destroy()
        frequency = counted if frequency is None else reads(frequency.union(counted), frequency, counted)
    distinct = windows.groupBy("n", "k", "key").agg(
        F.first("shingles").alias("shingles"),
        F.collect_set(F.col("item_id").cast("string")).alias("items"))
    if frequency is None:
        out = written(distinct.withColumns({"shingle": F.lit(0).cast("long"), "place": F.lit(0)})
                      .select("n", "k", "key", "shingle", "place", "items"), "decontam-prefixes")
        dropped(windows, shingles)
        return out
    each = windows.dropDuplicates(["n", "k", "key"]).select(
        "n", "k", "key", F.posexplode("shingles").alias("place", "shingle"))
    rarest = (each.join(frequency, ["k", "shingle"], "left").groupBy("n", "k", "key")
              .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "shingle", "place")).alias("r")))
    out = written(distinct.drop("shingles").join(rarest, ["n", "k", "key"])
                  .where("r.df > 0")  # a window whose rarest shingle is in no document occurs nowhere
                  .select("n", "k", "key", "r.shingle", "r.place", "items"), "decontam-prefixes")
    dropped(windows, shingles, frequency)
    return out


def _tables(rows) -> tuple[list[tuple], list[list[str]]]:
    """What ``_spans`` needs, from the rows of a block of windows."""
    prefixes = []
    for k, part in rows.groupby("k"):
        part = part.sort_values("shingle", kind="stable")
        table, first = np.unique(part["shingle"].to_numpy(), return_index=True)
        prefixes.append((int(k), table, np.r_[first, len(part)], part.index.to_numpy(),
                         part["n"].to_numpy(np.int64), part["place"].to_numpy(np.int64), part["key"].to_numpy()))
    return prefixes, [list(x) for x in rows["items"]]


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hits of ``benchmark(item_id, text)`` in ``docs(doc_id, text)``, one row per document.

    Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and
    firsts and sizes, the disjoint spans of hit words.  A null or empty text
    has no words; a null text of an item has no window; windows of an item
    without an id count as hits, but name no item; repeated rows each get a
    row; items of equal text are all named.  Other columns are ignored.
    """
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    windows = prefix_windows(docs, benchmark)
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    found = rows = None
    if blocks > 1:
        docs = rows = written(docs.withColumn("row", F.monotonically_increasing_id()), "decontam-docs")
    for b in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).toPandas()
        held = docs.sparkSession.sparkContext.broadcast(_tables(part))
        one = occurrences(docs, held)
        if blocks > 1:  # driver and executors hold one block's tables at a time; rows without hits are kept once
            one = written(one if b == 0 else one.where(F.size("firsts") > 0), "decontam-block")
            held.destroy()
        found = one if found is None else reads(found.union(one), found, one)
    dropped(windows, rows)
    if blocks > 1:
        found = reads(_unite(found), found)
    items = F.array_sort("items")
    hit = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    return reads(found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (hit * 20 >= F.col("n_words"))).alias("contaminated"), "firsts", "sizes"), found)


def _unite(found: DataFrame) -> DataFrame:
    """One row per document from those of each block."""
    rows = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list(F.arrays_zip("firsts", "sizes"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def merge(batches):
        for batch in batches:
            spans = [_merge(np.array([x["firsts"] for x in r], np.int64), np.array([x["sizes"] for x in r], np.int64))
                     for r in batch.column("spans").to_pylist()]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array([a.tolist() for a, _ in spans], longs),
                 pa.array([b.tolist() for _, b in spans], longs), batch.column("items")],
                ["doc_id", "n_words", "firsts", "sizes", "items"])

    kind = dict(found.dtypes)["doc_id"]
    return rows.mapInArrow(merge, f"doc_id {kind}, n_words long, firsts array<long>, sizes array<long>, "
                                  "items array<string>")
