"""Token-ID output: Simple-8b word-aligned files.

A 64-bit word has a 4-bit selector on top and 60 bits of payload: selector
``s`` packs ``COUNTS[s]`` ids of ``WIDTHS[s]`` bits each, the first id in the
lowest bits; selector 0 is an escape, whose id (of 60 bits or more) stands in
the block's list of raw words.  Ids are cut into blocks of ``BLOCK_IDS``; a
file's index has each block's offset, words, escapes and ids, so any block is
read and decoded by itself, one vectorised step per selector.

File: words of all blocks, each block followed by its escapes; then a JSON
index (blocks, and the documents as ids and lengths); then the index's offset
and the magic (16 bytes).  All integers are little-endian.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapmart.llm.bpe import encoder
from lapmart.llm.common import prepare, written
from lapmart.llm.files import new_name, one_row_tasks, open_fs
from lapmart.sources.rawfiles import scratch_dir

MAGIC = b"S8BFILE1"
BLOCK_IDS = 1 << 15
# Selector 0 is the escape; 1 to 14: ids in a word and bits of each.
COUNTS = (0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
_LIMITS = np.array([1 << w for w in WIDTHS[1:]], np.uint64)


def encode_block(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of a block of unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    # the first selector whose width takes each id; 15: none
    need = (np.searchsorted(_LIMITS, ids, "right") + 1).astype(np.uint8)
    room = np.zeros(n + 128, np.uint8)  # behind the end everything fits
    room[:n] = need
    # the largest need among the next c ids, for each count c
    most = {1: room}
    for c in (2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60):
        a = max(x for x in most if x < c)
        b = next(x for x in sorted(most) if x >= c - a)
        top = room.copy()
        step = c - b
        np.maximum(most[a][:len(room) - step], most[b][step:], out=top[:len(room) - step])
        most[c] = top
    pick = np.zeros(n, np.uint8)
    for s in range(14, 0, -1):  # the selector with the most ids comes last and wins
        pick[most[COUNTS[s]][:n] <= s] = s
    count = np.array((1, *COUNTS[1:]), np.uint8)[pick].tolist()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at += count[at]
    starts = np.array(starts, np.int64)
    chosen = pick[starts] if n else pick
    words = np.zeros(len(starts), np.uint64)
    padded = np.zeros(n + 64, np.uint64)
    padded[:n] = ids
    for s in np.unique(chosen):
        if s:
            of = np.flatnonzero(chosen == s)
            word = np.full(len(of), np.uint64(int(s) << 60))
            for j in range(COUNTS[s]):
                word |= padded[starts[of] + j] << np.uint64(j * WIDTHS[s])
            words[of] = word
    return words, padded[starts[chosen == 0]]


def decode_block(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    selector = (words >> np.uint64(60)).astype(np.uint8)
    count = np.array((1, *COUNTS[1:], 0), np.int64)[selector]
    ends = np.cumsum(count)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    starts = ends - count
    for s in np.unique(selector):
        of = np.flatnonzero(selector == s)
        if s == 0:
            out[starts[of]] = escapes
            continue
        mask = np.uint64((1 << WIDTHS[s]) - 1)
        for j in range(COUNTS[s]):
            out[starts[of] + j] = (words[of] >> np.uint64(j * WIDTHS[s])) & mask
    return out[:n]


class Writer:
    """Streams documents' ids into one file."""

    def __init__(self, stream):
        self.out, self.at = stream, 0
        self.blocks: list[tuple[int, int, int, int]] = []  # offset, words, escapes, ids
        self.docs: list[tuple[int | None, int]] = []
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint64)
        lo = 0
        while len(ids) - lo >= BLOCK_IDS or last and lo < len(ids):
            part = ids[lo:lo + BLOCK_IDS]
            words, escapes = encode_block(part)
            self.blocks.append((self.at, len(words), len(escapes), len(part)))
            data = words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes()
            self.out.write(data)
            self.at += len(data)
            lo += len(part)
        self.held, self.n_held = [ids[lo:]], len(ids) - lo

    def close(self) -> None:
        self._flush(True)
        index = json.dumps({"blocks": self.blocks, "docs": self.docs}).encode()
        self.out.write(index + struct.pack("<Q", self.at) + MAGIC)


def read_documents(handle):
    """Yields (doc_id, first id's place in the file, ids, crc32) of each document of an open file.

    Blocks are decoded one by one; a document's checksum runs on across them.
    """
    size = handle.size()
    offset, magic = struct.unpack("<Q8s", handle.read_at(16, size - 16))
    if magic != MAGIC:
        raise ValueError("not a Simple-8b file")
    index = json.loads(handle.read_at(size - 16 - offset, offset))
    blocks = iter(index["blocks"])
    data, at, start = memoryview(b""), 0, 0
    for doc_id, n in index["docs"]:
        crc, left = 0, 4 * n
        while left:
            if at == len(data):
                where, n_words, n_escapes, n_ids = next(blocks)
                raw = np.frombuffer(handle.read_at(8 * (n_words + n_escapes), where), "<u8")
                ids = decode_block(raw[:n_words], raw[n_words:], n_ids)
                data, at = memoryview(ids.astype("<u4").tobytes()), 0
            part = data[at:at + left]
            crc = zlib.crc32(part, crc)
            at += len(part)
            left -= len(part)
        yield doc_id, start, n, crc
        start += n


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, folder: str) -> DataFrame:
    """Writes each document's ids and ``end_id`` in ascending doc_id order; returns the written manifest.

    ``docs(doc_id, text)``: a null text is empty, a null doc_id sorts first,
    rows of equal ids are ordered by text; other columns are ignored.  Each
    range of doc_ids becomes one file.  Manifest: file, shard, n_docs, n_ids.
    """
    prepare(docs.sparkSession)

    def write(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        writer = stream = name = None
        n_docs = n_ids = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                name = new_name(folder, shard, ".s8b")
                fs, path = open_fs(name)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                stream = fs.open_output_stream(path)
                writer = Writer(stream)
            keys, texts = batch.column("doc_id"), batch.column("text")
            for lo, hi, ids, counts in encoder(vocabulary).groups(texts, end_id):
                ids, ends = ids.astype(np.uint64), np.cumsum(counts)
                for key, a, b in zip(keys.slice(lo, hi - lo).to_pylist(), (ends - counts).tolist(), ends.tolist()):
                    writer.add(key, ids[a:b])
                n_docs += hi - lo
                n_ids += len(ids)
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "shard": pa.array([shard], pa.int64()),
                                              "n_docs": pa.array([n_docs], pa.int64()),
                                              "n_ids": pa.array([n_ids], pa.int64())})

    ordered = (docs.select("doc_id", "text").repartitionByRange(F.col("doc_id"))
               .sortWithinPartitions("doc_id", "text"))
    return written(ordered.mapInArrow(write, "file string, shard long, n_docs long, n_ids long"), "s8b-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Documents of the manifest's files: doc_id, start, n_tokens, ids_crc32 (see op2's contract)."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = open_fs(row["file"])
                with fs.open_input_file(path) as handle:
                    found = list(read_documents(handle))
                if found:
                    key, start, n, crc = zip(*found)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(key, pa.int64()),
                        "start": pa.array(np.array(start, np.int64) + row["base"]),
                        "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    # one row per file: the ids of all files before it
    base = manifest.withColumn("base", F.sum("n_ids").over(
        W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))).fillna(0, ["base"])
    return one_row_tasks(base, manifest.count()).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Writes the token files and returns what is read back from them.  An empty table gives no files and no rows."""
    folder = folder or scratch_dir(docs.sparkSession, "s8b")
    return read_token_files(write_token_files(docs, vocabulary, end_id, folder))
