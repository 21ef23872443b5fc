"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors are turned onto their principal axes and sorted by label and by
their grid cells (of side epsilon, the distance that the cosine allows) on the
leading axes.  The sequence is cut into blocks with bounding boxes.  Pairs of
sequence intervals are refined from the top of an implicit tree over block
numbers, ``FAN`` children at a time; a pair whose boxes are further apart than
epsilon is dropped with everything below it.  What reaches the leaves is
compared in double precision, block against block.  A task returns link counts
and a spanning forest, never all pairs, so its output is linear in its input.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapmart.llm.common import components, prepare, salted_join, written

BLOCK = 256
FAN_BITS = 4
GRID_DIMS = 6
BOX_DIMS = 8
_HOT_SALT = 32


def _vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of vector in a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    at = np.cumsum(lengths) - lengths
    out = []
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        out.append((rows, flat[at[rows][:, None] + np.arange(d)]))
    return out


def unit(m: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in double precision (scaled first, so that squares neither vanish nor overflow)."""
    m = m.astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def principal_axes(reps: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal axes (columns) by vector length, from all vectors; d*d sums reach the driver."""

    def moments(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, m in _vectors(batch.column("embedding")):
                u = unit(m)
                sums[u.shape[1]] = sums.get(u.shape[1], 0) + u.T @ u
        for d, s in sums.items():
            yield pa.RecordBatch.from_pydict({"dim": pa.array(np.full(d * d, d), pa.int64()),
                                              "at": pa.array(np.arange(d * d), pa.int64()), "v": s.ravel()})

    rows = (reps.select("embedding").mapInArrow(moments, "dim long, at long, v double")
            .groupBy("dim", "at").agg(F.sum("v").alias("v")).toPandas())
    out = {}
    for d, part in rows.groupby("dim"):
        m = np.zeros(int(d) * int(d))
        m[part["at"]] = part["v"]
        out[int(d)] = np.linalg.eigh(m.reshape(int(d), int(d)))[1][:, ::-1][:, :BOX_DIMS]
    return out


def grid_blocks(reps: DataFrame, eps: float) -> DataFrame:
    """Blocks of the sequence in epsilon grid order.

    reps: label, vec, copies, embedding.  Blocks: part, i (order within
    the label), label, dim, lo and hi (boxes on the principal axes), ids,
    copies, vecs (the vectors as they are).
    """
    axes = principal_axes(reps)
    wide = reps.schema["embedding"].dataType.elementType.typeName() == "double"
    kind = np.float64 if wide else np.float32

    def place(batches):
        for batch in batches:
            n = batch.num_rows
            dim, proj = np.zeros(n, np.int64), np.zeros((n, BOX_DIMS))
            for rows, m in _vectors(batch.column("embedding")):
                p = unit(m) @ axes[m.shape[1]]
                dim[rows] = m.shape[1]
                proj[rows, :p.shape[1]] = p
            cells = np.floor(proj[:, :GRID_DIMS] / eps).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dim), *(pa.array(cells[:, j]) for j in range(GRID_DIMS)),
                 pa.FixedSizeListArray.from_arrays(proj.ravel(), BOX_DIMS).cast(pa.list_(pa.float64()))],
                [*batch.schema.names, "dim", *(f"c{j}" for j in range(GRID_DIMS)), "proj"])

    types = {f.name: f.dataType.simpleString() for f in reps.schema.fields}
    label_type = types["label"]
    cells = [f"c{j}" for j in range(GRID_DIMS)]
    placed = written(reps.mapInArrow(place, ", ".join(
        [*(f"`{n}` {t}" for n, t in types.items()), "dim long", *(f"{c} long" for c in cells), "proj array<double>"])),
        "ego-placed")

    def block(batches):
        from pyspark import TaskContext

        part, i, held, key = TaskContext.get().partitionId(), 0, [], None

        def emit():
            proj = np.array([r["proj"] for r in held])
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "i": pa.array([i], pa.int64()),
                "label": pa.array([key[0]], label), "dim": pa.array([key[1]], pa.int64()),
                "lo": [proj.min(0).tolist()], "hi": [proj.max(0).tolist()],
                "ids": pa.array([[r["vec"] for r in held]], pa.list_(pa.int64())),
                "copies": pa.array([[r["copies"] for r in held]], pa.list_(pa.int64())),
                "vecs": pa.array([np.array([r["embedding"] for r in held], kind).tobytes()], pa.binary())})

        for batch in batches:
            label = batch.schema.field("label").type
            for r in batch.to_pylist():
                if held and ((r["label"], r["dim"]) != key or len(held) == BLOCK):
                    yield emit()
                    i, held = i + 1, []
                key = r["label"], r["dim"]
                held.append(r)
        if held:
            yield emit()

    order = ["label", "dim", *cells, "vec"]
    return written(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        block, f"part long, i long, label {label_type}, dim long, lo array<double>, hi array<double>, "
               "ids array<long>, copies array<long>, vecs binary"), "ego-blocks")


def near_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs (a, b), a <= b, of block numbers whose boxes are within ``eps``: recursion over sequence intervals."""
    top = blocks.agg(F.max("node")).first()[0]
    depth = max(1, -(-int(top).bit_length() // FAN_BITS))
    boxes = {}
    for level in range(depth):  # boxes of intervals of FAN**level blocks
        boxes[level] = blocks.groupBy("label", "dim", F.shiftright("node", level * FAN_BITS).alias("node")).agg(
            *(F.min(F.col("lo")[j]).alias(f"lo{j}") for j in range(BOX_DIMS)),
            *(F.max(F.col("hi")[j]).alias(f"hi{j}") for j in range(BOX_DIMS)))

    def side(level: int, s: str) -> DataFrame:
        b = boxes[level]
        return b.select(F.col("label"), F.col("dim"), F.shiftright("node", FAN_BITS).alias(f"{s}_up"),
                        F.col("node").alias(s), *(F.col(f"{e}{j}").alias(f"{s}_{e}{j}")
                                                  for e in ("lo", "hi") for j in range(BOX_DIMS)))

    gap = sum((F.pow(F.greatest(F.col(f"b_lo{j}") - F.col(f"a_hi{j}"), F.col(f"a_lo{j}") - F.col(f"b_hi{j}"),
                                F.lit(0.0)), F.lit(2.0)) for j in range(BOX_DIMS)), F.lit(0.0))
    pairs = None
    for level in reversed(range(depth)):
        a, b = side(level, "a"), side(level, "b")
        if pairs is None:  # at most FAN intervals of a label on top
            found = a.join(b, ["label", "dim"])
        else:
            found = (pairs.withColumnsRenamed({"a": "a_up", "b": "b_up"})
                     .join(a, ["label", "dim", "a_up"]).join(b, ["label", "dim", "b_up"]))
        pairs = found.where((F.col("a") <= F.col("b")) & (gap <= eps * eps)).select("label", "dim", "a", "b")
        if level:
            pairs = written(pairs, f"ego-pairs{level}")
    return pairs


def link_blocks(blocks: DataFrame, pairs: DataFrame, threshold: float, wide: bool) -> DataFrame:
    """(vec, links, root) per pair of blocks: how many vectors a vector links to, and its local component."""
    kind = np.float64 if wide else np.float32

    def roots(hit: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least ids over the bipartite links."""
        far = np.iinfo(np.int64).max
        la, lb = a.copy(), b.copy()
        while True:
            nb = np.minimum(lb, np.where(hit, la[:, None], far).min(0))
            na = np.minimum(la, np.where(hit, nb[None, :], far).min(1))
            if (na == la).all() and (nb == lb).all():
                return la, lb
            la, lb = na, nb

    def compare(batches):
        for batch in batches:
            vec, links, root = [], [], []
            cols = {c: batch.column(c) for c in batch.schema.names}
            for r in range(batch.num_rows):
                ids = [cols[f"{s}_ids"][r].values.to_numpy() for s in "ab"]
                copies = [cols[f"{s}_copies"][r].values.to_numpy() for s in "ab"]
                ms = [unit(np.frombuffer(cols[f"{s}_vecs"][r].as_buffer(), kind).reshape(len(i), -1))
                      for s, i in zip("ab", ids)]
                hit = ms[0] @ ms[1].T >= threshold
                if cols["a"][r].as_py() == cols["b"][r].as_py():
                    np.fill_diagonal(hit, False)
                    if not hit.any():
                        continue
                    la, lb = roots(hit, *ids)
                    sides = [(ids[0], hit @ copies[1], np.minimum(la, lb), hit.any(1))]
                else:
                    if not hit.any():
                        continue
                    la, lb = roots(hit, *ids)
                    sides = [(ids[0], hit @ copies[1], la, hit.any(1)), (ids[1], hit.T @ copies[0], lb, hit.any(0))]
                for i, n, l, some in sides:
                    vec.append(i[some])
                    links.append(n[some])
                    root.append(l[some])
            if vec:
                yield pa.RecordBatch.from_pydict({"vec": np.concatenate(vec), "links": np.concatenate(links),
                                                  "root": np.concatenate(root)})

    def content(s: str) -> DataFrame:
        return blocks.select("label", "dim", F.col("node").alias(s), F.col("ids").alias(f"{s}_ids"),
                             F.col("copies").alias(f"{s}_copies"), F.col("vecs").alias(f"{s}_vecs"))

    both = (pairs.join(content("a"), ["label", "dim", "a"]).join(content("b"), ["label", "dim", "b"])
            .select("a", "b", "a_ids", "a_copies", "a_vecs", "b_ids", "b_copies", "b_vecs"))
    return written(both.mapInArrow(compare, "vec long, links long, root long"), "ego-links")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """Links ``vectors(vec_id, embedding, label)`` of equal labels with cosine >= ``threshold``.

    Returns one row per input row: vec_id, n_links, component_id, kept.
    Equal vectors of a label are compared once.  A vector that is null,
    empty, zero or holds null or non-finite components, or whose label or
    vec_id is null, links with nothing (a null vec_id has no component and is
    not kept); vectors of different lengths don't link; rows that repeat a
    vec_id are vectors of their own that share a component.  Other columns
    are ignored; an empty table gives no rows.
    """
    prepare(vectors.sparkSession)
    eps = math.sqrt(2 - 2 * threshold) * (1 + 1e-9) + 1e-9
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(e, lambda x: x != 0)
    valid = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & ~zero, F.lit(False))
    rows = vectors.select("vec_id", "embedding", "label", valid.alias("valid"))
    good = rows.where("valid")
    reps = written(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("vec"), F.count("*").alias("copies"))
                   .select("label", "vec", "copies", "embedding"), "ego-reps")
    wide = reps.schema["embedding"].dataType.elementType.typeName() == "double"
    blocks = grid_blocks(reps, eps)
    most = blocks.agg(F.max("i").alias("i")).first()["i"]
    if most is None:  # no vector can link
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    node = F.shiftleft(F.col("part"), int(most).bit_length()) + F.col("i")
    blocks = blocks.withColumn("node", node)
    found = link_blocks(blocks, near_blocks(blocks, eps), threshold, wide)
    # copies of one vector share its smallest id; two labels may share a vec_id's component
    linked = found.groupBy("vec").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("vec").alias("a"), F.col("root").alias("b")), "ego")
    table = written(reps.join(linked, "vec", "left")
                    .join(comp.withColumnRenamed("node", "vec"), "vec", "left")
                    .where((F.col("copies") > 1) | F.col("links").isNotNull())
                    .select("label", "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
                            F.coalesce("component", "vec").alias("c")), "ego-table")
    out = salted_join(rows, table, ["label", "embedding"], "vec_id", _HOT_SALT, "left")
    named = F.col("vec_id").isNotNull()
    component = F.when(named, F.coalesce("c", "vec_id"))
    return out.select("vec_id", F.coalesce(F.when(named, F.col("n")), F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
