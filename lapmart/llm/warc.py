"""WARC archives with the index first: write, index, then coalesced byte-range reads.

Each task writes one archive after another (``ROLL_BYTES``), every record a
gzip member of its own, and yields an index row per record: file, offset,
length, URL, payload digest.  The index is written before anything is read.
Selected records are sorted by offset and neighbouring ranges joined up to
``RANGE_BYTES``; a task reads a range at once and parses its records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapmart.llm.common import prepare, salted_join, written
from lapmart.llm.files import new_name, one_row_tasks, open_fs
from lapmart.sources.rawfiles import scratch_dir

ROLL_BYTES = 1 << 30
RANGE_BYTES = 2 << 20
# Bytes that a reading task gets.
TASK_BYTES = 16 << 20
# Unselected bytes between two ranges that are read rather than skipped.
GAP_BYTES = 64 << 10
MIN_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
# Tasks that records of one payload are dealt to.
_HOT_SALT = 32

INDEX = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
         "payload_digest string, file string, offset long, length long")


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]+", lambda m: "".join(f"%{ord(c):02X}" for c in m[0]), value)


def record(page_id, url, kind, refers_to, payload: bytes, digest: str) -> bytes:
    """One WARC/1.1 record; a revisit has no block and names the response's page and payload."""
    block = b"" if kind == "revisit" else payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: text/html", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    n = int(headers["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a WARC record's length is wrong")
    return headers, rest[:n]


def decide(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, digest -> record type and, for revisits, the page of the response.

    Of records with equal payloads of at least ``min_bytes`` the largest
    page_id is the response.  Digests are combined map-side and the join is
    salted, as one payload may be a third of all records.
    """
    named = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    named = named.withColumns({"payload_digest": F.sha1(F.encode("html", "UTF-8")),
                               "payload_bytes": F.octet_length("html").cast("long")})
    narrow = named.where(F.col("payload_bytes") >= min_bytes).select("page_id", "payload_digest")
    largest = written(narrow.groupBy("payload_digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
                      .where("n > 1").select("payload_digest", "response"), "warc-repeats")
    same = F.col("response").isNull() | F.col("page_id").eqNullSafe(F.col("response"))
    return (salted_join(named, largest, ["payload_digest"], "page_id", _HOT_SALT, "left")
            .select("page_id", "url", "html", "payload_digest", "payload_bytes",
                    F.when(same, "response").otherwise("revisit").alias("record_type"),
                    F.when(~same, F.col("response")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Writes one record per row of ``pages(page_id, url, html)``; returns the written index (``INDEX``).

    A null html is an empty payload; a null url is left out of the header; a
    null page_id can only revisit; rows that repeat the largest page_id of
    equal payloads are all responses; other columns are ignored.
    """

    def write(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        stream, name, at = None, None, 0
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "html", "payload_digest", "record_type", "refers_to")]
            names, offsets, lengths = [], [], []
            for i in range(batch.num_rows):
                page, url, html, digest, kind, refers = (c[i].as_py() for c in cols)
                payload = html.encode()
                if hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError("a payload doesn't have its digest")
                if stream is None or at >= ROLL_BYTES:
                    if stream is not None:
                        stream.close()
                    name = new_name(folder, shard, ".warc.gz")
                    fs, path = open_fs(name)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    stream, at = fs.open_output_stream(path, compression=None), 0
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = packer.compress(record(page, url, kind, refers, payload, digest)) + packer.flush()
                stream.write(data)
                names.append(name)
                offsets.append(at)
                lengths.append(len(data))
                at += len(data)
            if names:
                keep = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), pa.array(names), pa.array(offsets, pa.int64()),
                     pa.array(lengths, pa.int64())], [*keep, "file", "offset", "length"])
        if stream is not None:
            stream.close()

    prepare(pages.sparkSession)
    return written(decide(pages, min_bytes).mapInArrow(write, INDEX), "warc-index")


def coalesce_ranges(selected: DataFrame, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """(file, lo, hi, records) from rows of the index: sorted ranges joined over gaps of at most ``gap`` bytes.

    A file's records are first dealt to cells of ``most`` bytes by offset, so
    no window or list holds more than a cell's records.
    """
    cell = F.floor(F.col("offset") / F.lit(most)).alias("cell")
    rows = selected.select("file", "offset", "length", cell)
    w = W.partitionBy("file", "cell").orderBy("offset")
    far = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(w) > gap
    runs = rows.withColumn("far", far.cast("int")).withColumn("run", F.sum("far").over(w))
    return (runs.groupBy("file", "cell", F.coalesce("run", F.lit(0)).alias("run"))
            .agg(F.min("offset").alias("lo"), F.max(F.col("offset") + F.col("length")).alias("hi"),
                 F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"))
            .select("file", "lo", "hi", "records"))


def read_records(selected: DataFrame) -> DataFrame:
    """Reads the records of index rows ``selected`` back from the archives.

    Returns page_id, url, record_type, refers_to, payload_bytes,
    payload_digest (from the headers; a response's are checked against its
    block) and html (null for revisits).
    """

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = open_fs(row["file"])
                with fs.open_input_file(path) as handle:
                    data = handle.read_at(row["hi"] - row["lo"], row["lo"])
                out = []
                for r in row["records"]:
                    a = r["offset"] - row["lo"]
                    head, block = parse(zlib.decompress(data[a:a + r["length"]], 31))
                    kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(head["X-Payload-Length"])
                    if kind == "response" and (len(block), hashlib.sha1(block).hexdigest()) != (size, digest):
                        raise ValueError("a response's block doesn't have its digest")
                    page, refers = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
                    out.append((page and int(page), head.get("WARC-Target-URI"), kind, refers and int(refers), size,
                                digest, block.decode() if kind == "response" else None))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64(),
                                                           pa.int64(), pa.string(), pa.string()))],
                    ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "html"])

    prepare(selected.sparkSession)
    ranges = written(coalesce_ranges(selected), "warc-ranges")
    # dealt out by the bytes to read, not by those of the range rows
    size = ranges.agg(F.sum(F.col("hi") - F.col("lo"))).first()[0] or 0
    return one_row_tasks(ranges, -(-size // TASK_BYTES)).mapInArrow(
        read, "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
              "payload_digest string, html string")


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes all pages and reads all records back."""
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder))