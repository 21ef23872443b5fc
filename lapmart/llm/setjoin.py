"""Exact Jaccard join of shingle sets with set-relation skipping.

1. Equal sets are one class (128-bit digest), represented by its smallest id.
2. Index lists hold each set's prefix: with tokens ordered by document
   frequency, sets of Jaccard similarity t share a token among their first
   n - ceil(t n) + 1.  Frequencies are exact for the tokens whose hash lies in
   the lowest ``share`` of the hash range; these come first in the order, by
   (frequency, hash); the rest follow by hash.  Tokens of one set only fill
   prefixes without being indexed, so most sets leave the index altogether.
3. A list is cut into blocks, and only sets of different components are
   compared.  The list's largest component stays where it is; the other sets
   visit blocks.  Sizes, positions in the lists and parity sketches (a lower
   bound of the symmetric difference) skip pairs; the rest are verified
   exactly.
4. Answers from similar sets: in the first rounds each set visits one block
   of a few of its lists and takes the set with the nearest sketch, a linear
   number of pairs.  A set that links to it takes over its component's answers, so
   nothing in that component is compared with it again, and a group of many
   similar sets soon is one component.  The last round visits all blocks and
   takes all pairs of different components, so no link is lost.

Positions, sizes and sketches only ever skip pairs that cannot link, so the
links' components are exact (64-bit shingle hashes stand for shingles).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapmart.llm.common import (FEW_BYTES, WordHasher, ascii_space_words, components, dropped, mix64, prepare, reads,
                                release, row_of_word, shingle_sets, shuffles_freed, small_enough, spread_join, written)
from lapmart.operators.joins import input_bytes

# Ids that are broadcast at most (8 MB of longs); beyond that the texts are shuffled.
BROADCAST_IDS = 1_000_000
SKETCH_BITS = 2048
# Rounds in which a set only looks for its nearest set in a block; after them all pairs left are looked at.
NEAREST_ROUNDS = 2
# Lists per set that are looked at in these rounds; the round after them takes all lists.
NEAREST_LISTS = 6
# Members of a block, and visitors of a block at a time.
BLOCK = 128
_HOT_SALT = 32
# A list of more than one such part of all lists' rows is broadcast, so at most so many are.
LONG_LISTS = 1000


def _share(num: int, den: int) -> float:
    return min(1.0, 1.7 * (1 - num / den) + 0.02)


def _limit(num: int, den: int) -> int:
    """Tokens below (as signed 64-bit integers) have exact frequencies."""
    return min((1 << 63) - 1, -(1 << 63) + int(_share(num, den) * (1 << 64)))


def _prefix_length(n, num: int, den: int):
    return n - (num * n + den - 1) // den + 1


def _sets(batch, k: int, hasher: WordHasher):
    """(first row, last row + 1, signed hashes in ascending order by row, set sizes)."""
    for lo, hi, h, counts in hasher.batch(batch.column("text")):
        s, sizes = shingle_sets(h, counts, k)
        # ascending as signed integers within each row
        s, rows = s.view(np.int64), row_of_word(sizes)
        order = np.lexsort((s, rows))
        yield lo, hi, s[order], sizes


def profiles(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n (set size), d1, d2 (digest), n_exact (tokens with exact frequencies)."""
    limit = _limit(num, den)

    def profile(batches):
        hasher = WordHasher(ascii_space_words())
        for batch in batches:
            for lo, hi, s, sizes in _sets(batch, k, hasher):
                at = np.cumsum(sizes) - sizes
                some = sizes > 0
                d1, d2 = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
                exact = np.zeros(hi - lo, np.int64)
                if some.any():
                    u = s.view(np.uint64)
                    with np.errstate(over="ignore"):
                        d1[some] = np.add.reduceat(mix64(u ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at[some])
                        d2[some] = np.add.reduceat(mix64(u + np.uint64(0x632BE59BD9B4E019)), at[some])
                    exact[some] = np.add.reduceat((s < limit).astype(np.int64), at[some])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(sizes.astype(np.int64)),
                     pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(exact)],
                    ["doc_id", "n", "d1", "d2", "n_exact"])
        release()

    return written(docs.mapInArrow(profile, "doc_id long, n long, d1 long, d2 long, n_exact long"), "sets-profiles")


def token_rows(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(token, doc): each set's tokens with exact frequencies, and as many more as its prefix needs."""
    limit = _limit(num, den)

    def tokens(batches):
        hasher = WordHasher(ascii_space_words())
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for lo, _, s, sizes in _sets(batch, k, hasher):
                rows = row_of_word(sizes)
                place = np.arange(len(s)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                keep = (s < limit) | (place < _prefix_length(sizes, num, den)[rows])
                yield pa.RecordBatch.from_pydict({"token": s[keep], "doc": ids[lo + rows[keep]]})
        release()

    return written(docs.mapInArrow(tokens, "token long, doc long"), "sets-tokens")


def indexed_prefixes(tokens: DataFrame, sizes: DataFrame, num: int, den: int) -> DataFrame:
    """doc, n, and the prefix tokens that other sets have too: arrays of (token, position), positions from 1."""
    limit = _limit(num, den)
    common = written(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "sets-common")
    shuffles_freed(tokens.sparkSession)          # before the next shuffle of all tokens
    # as rows: lists collected before the shuffle are longer in bytes, the more so the more tasks a document is spread over
    shared = (tokens.join(common, "token").repartition("doc").groupBy("doc")
              .agg(F.sort_array(F.collect_list(F.when(F.col("token") < limit, F.struct("df", "token")))).alias("exact"),
                   F.sort_array(F.collect_list(F.when(F.col("token") >= limit, F.col("token")))).alias("rest")))
    unique = F.col("n_exact") - F.size("exact")
    need = _prefix_length_sql(F.col("n"), num, den) - unique
    joined = shared.join(sizes, "doc").where(need > 0)
    first = F.transform(F.slice("exact", F.lit(1), F.greatest(need, F.lit(0)).cast("int")),
                        lambda x, i: F.struct(x["token"].alias("token"), (unique + i + 1).alias("pos")))
    rest = F.transform("rest", lambda x, i: F.struct(x.alias("token"), (F.col("n_exact") + i + 1).alias("pos")))
    out = written(joined.select("doc", "n", F.concat(first, rest).alias("prefix")).where(F.size("prefix") > 0),
                  "sets-prefixes")
    dropped(common)
    return out


def _prefix_length_sql(n: Column, num: int, den: int) -> Column:
    return n - F.floor((n * num + den - 1) / den) + 1


def whole_sets(docs: DataFrame, k: int, repeats: bool = True) -> DataFrame:
    """doc, tokens (the whole set), sketch (parity of the tokens on each of ``SKETCH_BITS`` bits).

    ``repeats``: whether a doc_id may stand on several rows, which give its set again.
    """

    def sets(batches):
        hasher = WordHasher(ascii_space_words())
        for batch in batches:
            for lo, hi, s, sizes in _sets(batch, k, hasher):
                n = hi - lo
                bit = (mix64(s.view(np.uint64)) & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
                at, times = np.unique(row_of_word(sizes) * SKETCH_BITS + bit, return_counts=True)
                odd = np.zeros(n * SKETCH_BITS, np.uint8)
                odd[at[times % 2 == 1]] = 1
                packed = np.packbits(odd.reshape(n, SKETCH_BITS), axis=1)
                offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, n), pa.ListArray.from_arrays(offsets, pa.array(s)),
                     pa.array([x.tobytes() for x in packed], pa.binary())], ["doc", "tokens", "sketch"])
        release()

    out = docs.mapInArrow(sets, "doc long, tokens array<long>, sketch binary")
    return written(out.dropDuplicates(["doc"]) if repeats else out, "sets-whole")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int, name: str) -> DataFrame:
    """Of pairs (a, b) those whose sets are similar enough, exactly."""
    x = sets.select(F.col("doc").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("doc").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    alike = both * den >= (F.size("x") + F.size("y") - both) * num
    return written(pairs.join(x, "a").join(y, "b").where(alike).select("a", "b"), name)


def list_join(known: DataFrame, lists: DataFrame) -> DataFrame:
    """The rows of ``known`` whose token has a row in the written ``lists(token, all, ...)``, with its columns.

    Few lists, or else the long ones, are broadcast, so no task gets a long list whole, and no list is repeated.
    """
    if input_bytes(lists) <= FEW_BYTES:
        return known.join(F.broadcast(lists), "token")
    total = lists.agg(F.sum("all")).first()[0] or 0
    long = F.col("all") * LONG_LISTS > total
    some = F.broadcast(lists.where(long))
    rest = known.join(F.broadcast(lists.where(long).select("token")), "token", "left_anti")
    return known.join(some, "token").unionByName(rest.join(lists.where(~long), "token"))


def cross_pairs(index: DataFrame, sets: DataFrame, found: DataFrame | None, num: int, den: int,
                best: bool) -> DataFrame:
    """Pairs (a, b) of different components that share a list and pass the size, position and sketch bounds.

    ``best``: of a set and a list at most the pair with the nearest sketch in one block; else all pairs.
    """
    if found is None:
        known = index.withColumn("c", F.col("doc"))
    else:
        known = index.join(found.select(F.col("node").alias("doc"), "component"), "doc", "left")
        known = known.select("token", "doc", "n", "pos", F.coalesce("component", "doc").alias("c"))
    known = known.select("token", "doc", "n", "pos", "c")
    if best:
        # alike sets choose alike: the lists of the few tokens with the smallest hashes
        few = known.groupBy("doc").agg(F.slice(F.sort_array(F.collect_list(
            F.struct(F.xxhash64("token").alias("h"), "token", "n", "pos", "c"))), 1, NEAREST_LISTS).alias("x"))
        known = few.select("doc", F.explode("x").alias("x")).select("x.token", "doc", "x.n", "x.pos", "x.c")
    known = written(known, "sets-index")
    lists = (known.groupBy("token", "c").agg(F.count("*").alias("m"))
             .groupBy("token").agg(F.max(F.struct("m", "c")).alias("most"), F.sum("m").alias("all"),
                                   F.count("*").alias("comps")).where("comps > 1")
             .select("token", F.col("most.c").alias("home"), "all",
                     F.ceil((F.col("all") - F.col("most.m")) / BLOCK).cast("int").alias("chunks"),
                     F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks")))
    lists = written(lists, "sets-mixed")
    rows = list_join(known, lists).join(sets.select("doc", "sketch"), "doc")
    guest = F.col("c") != F.col("home")
    block = F.pmod(F.xxhash64("doc", F.lit(1)), F.col("blocks")).cast("int")
    chunk = F.pmod(F.xxhash64("doc", F.lit(2)), F.col("chunks")).cast("int")
    entry = F.struct("doc", "n", "pos", "c", guest.alias("guest"), "sketch").alias("entry")
    place = lambda block, chunk, v: F.struct(
        block.alias("block"), chunk.alias("chunk"), F.lit(v).alias("v"))
    if best:
        visited = F.pmod(F.xxhash64("doc", "token", F.lit(3)), F.col("blocks")).cast("int")
        chunks, blocks = F.array(F.lit(0)), F.array(visited)
        chunk = F.lit(0)
    else:
        chunks, blocks = (F.sequence(F.lit(0), F.col(c) - 1) for c in ("chunks", "blocks"))
    stay = F.transform(chunks, lambda x: place(block, x, False))
    visit = F.transform(F.when(guest, blocks).otherwise(F.array().cast("array<int>")), lambda x: place(x, chunk, True))
    # the rows are joined once for both
    dealt = rows.select("token", entry, F.explode(F.concat(stay, visit)).alias("p"))
    groups = dealt.groupBy("token", "p.block", "p.chunk").agg(
        F.collect_list(F.when(~F.col("p.v"), F.col("entry"))).alias("stay"),
        F.collect_list(F.when(F.col("p.v"), F.col("entry"))).alias("visit"))

    def columns(entries: pa.Array) -> dict[str, np.ndarray]:
        f = entries.flatten() if isinstance(entries, pa.ListArray) else entries
        out = {c: f.field(c).to_numpy(zero_copy_only=False) for c in ("doc", "n", "pos", "c", "guest")}
        sketch = np.frombuffer(b"".join(f.field("sketch").to_pylist()), np.uint64)
        return out | {"sketch": sketch.reshape(len(f), SKETCH_BITS // 64)}

    def compare(batches):
        for batch in batches:
            s_col, v_col = batch.column("stay"), batch.column("visit")
            s_at, v_at = (np.asarray(c.offsets) - c.offsets[0].as_py() for c in (s_col, v_col))
            s_all, v_all = columns(s_col), columns(v_col)
            a, b = [], []
            for r in range(batch.num_rows):
                s = {c: x[s_at[r]:s_at[r + 1]] for c, x in s_all.items()}
                v = {c: x[v_at[r]:v_at[r + 1]] for c, x in v_all.items()}
                i, j = np.nonzero(
                    (v["c"][:, None] != s["c"][None, :])
                    & (best | ~s["guest"][None, :] | (v["doc"][:, None] < s["doc"][None, :]))
                    & (np.minimum(v["n"][:, None], s["n"][None, :]) * den
                       >= np.maximum(v["n"][:, None], s["n"][None, :]) * num))
                if not len(i):
                    continue
                total = v["n"][i] + s["n"][j]
                needed = -(-total * num // (num + den))
                # the first token that two prefixes share leaves room for so many more
                fits = 1 + np.minimum(v["n"][i] - v["pos"][i], s["n"][j] - s["pos"][j]) >= needed
                i, j, spare = i[fits], j[fits], (total - 2 * needed)[fits]
                apart = np.bitwise_count(v["sketch"][i] ^ s["sketch"][j]).sum(axis=1, dtype=np.int64)
                near = np.flatnonzero(apart <= spare)
                if best:
                    near = near[np.lexsort((s["doc"][j[near]], apart[near], i[near]))]
                    near = near[np.r_[True, i[near][1:] != i[near][:-1]]] if len(near) else near
                a.append(v["doc"][i[near]])
                b.append(s["doc"][j[near]])
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})
        release()

    return reads(groups.mapInArrow(compare, "a long, b long").distinct(), known, lists)


def jaccard_components(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links documents whose sets of ``k``-word shingles have Jaccard similarity >= num / den.

    Returns one row per row of ``docs(doc_id, text)``: doc_id, n_shingles
    (set size) and component_id (smallest doc_id reachable by links, itself
    included).  Words are runs of other characters than ASCII white space,
    A-Z lower-cased; fewer than ``k`` words are one shingle.  A null or empty
    text has an empty set and links with nothing; a null doc_id links with
    nothing and has a null component; rows that repeat a doc_id are one
    document, so their texts' links are all its own (n_shingles is that of the
    row's text); other columns are ignored; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not has_repeats(docs):
        return _joined(docs, k, num, den, False)
    # texts stand for themselves; those of one document are linked afterwards
    unit = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))
    docs = docs.withColumn("unit", unit)
    joined = _joined(docs.select(F.col("unit").alias("doc_id"), "text"), k, num, den)
    found = written(joined.select(F.col("doc_id").alias("unit"), "n_shingles", "component_id"), "sets-units")
    dropped(joined)
    names = written(docs.where("unit IS NOT NULL").select("unit", "doc_id").distinct(), "sets-names")
    same = names.join(names.groupBy("doc_id").agg(F.min("unit").alias("first")), "doc_id")
    links = (found.where("unit IS NOT NULL").select(F.col("unit").alias("a"), F.col("component_id").alias("b"))
             .union(same.select("unit", "first")))
    group = components(links, "sets-docs")
    named = names.join(group.withColumnRenamed("node", "unit"), "unit", "left")
    named = written(named.select("unit", "doc_id", F.coalesce("component", "unit").alias("c")), "sets-named")
    dropped(names, group)
    least = named.groupBy("c").agg(F.min("doc_id").alias("least"))
    out = found.join(named.join(least, "c").select("unit", "doc_id", "least"), "unit", "left")
    return reads(out.select("doc_id", "n_shingles", F.col("least").alias("component_id")), found, named)


def has_repeats(docs: DataFrame) -> bool:
    """Whether a doc_id stands on several rows."""
    return not docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty()


def _joined(docs: DataFrame, k: int, num: int, den: int, repeats: bool = True) -> DataFrame:
    """``jaccard_components`` where rows of one doc_id have one text; ``repeats``: whether there are such rows."""
    rows = profiles(docs, k, num, den)
    real = rows.where("doc_id IS NOT NULL AND n > 0")
    digest = ["n", "d1", "d2"]
    copies = written(real.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
                     .where("copies > 1").select(*digest, "rep"), "sets-copies")
    extra = written(spread_join(real, copies, digest, "doc_id", _HOT_SALT).where("doc_id > rep")
                    .select("doc_id").distinct(), "sets-extra")
    reps = docs.where("doc_id IS NOT NULL").join(small_enough(extra, BROADCAST_IDS), "doc_id", "left_anti")
    tokens = token_rows(reps, k, num, den)
    sizes = real.select(F.col("doc_id").alias("doc"), "n", "n_exact").dropDuplicates(["doc"])
    prefixes = indexed_prefixes(tokens, sizes, num, den)
    index = prefixes.select("doc", "n", F.explode("prefix").alias("p")).select("doc", "n", "p.token", "p.pos")
    sets = whole_sets(reps.join(small_enough(prefixes.select(F.col("doc").alias("doc_id")), BROADCAST_IDS),
                                "doc_id", "left_semi"), k, repeats)
    del reps
    dropped(tokens, extra)
    found = None
    for best in (*(True,) * NEAREST_ROUNDS, False):
        looked = cross_pairs(index, sets, found, num, den, best)
        pairs = written(looked, "sets-pairs")    # the shuffles of the blocks go before those of the sets come
        dropped(looked)
        del looked
        links = new = verified(pairs, sets, num, den, "sets-links")
        dropped(pairs)
        if found is not None:
            new = new.union(found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")))
        older, found = found, components(new, "sets")
        del pairs, new
        dropped(links, older)
    dropped(prefixes, sets)
    # classes of equal sets and linked sets, by digest
    linked = (real.join(found.withColumnRenamed("node", "doc_id"), "doc_id")
              .groupBy(*digest).agg(F.min("component").alias("component")))
    table = written(copies.join(linked, digest, "full").select(*digest, F.coalesce("component", "rep").alias("component")),
                    "sets-table")
    dropped(copies, found)
    out = spread_join(rows, table, digest, "doc_id", _HOT_SALT, "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"),
                     F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return reads(out, rows, table)
