"""Metadata-only file-system calls through the session's Hadoop configuration.

Used for listing snapshot folders and version directories and for the
publish marker; no data ever passes through the driver here.  Works for any
Hadoop-compatible store the cluster is configured for (HDFS, S3A, ABFS, …).
"""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def snapshot_folders_with(spark: SparkSession, raw_root: str, rel_pattern: str) -> list[str]:
    """Snapshot folders below ``raw_root`` that contain a match of ``rel_pattern``."""
    fs, root = _fs(spark, raw_root)
    root_q = str(fs.makeQualified(root).toUri().getPath()).rstrip("/")
    jvm = spark.sparkContext._jvm
    hits = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{raw_root.rstrip('/')}/*/{rel_pattern}"))
    out = set()
    for st in hits or []:
        rel = str(st.getPath().toUri().getPath())[len(root_q):].lstrip("/")
        out.add(rel.split("/", 1)[0])
    return sorted(out)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (overwriting an existing one)."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file if there is none; False when somebody else has created it."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    return bool(fs.createNewFile(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` (empty when it does not exist)."""
    fs, p = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def list_units(spark: SparkSession, path: str) -> list[str]:
    """Partition directories (``a=1/b=2``) below ``path``, or its data files where it has none."""
    fs, p = _fs(spark, path)
    out = []
    for st in fs.listStatus(p) if fs.exists(p) else ():
        name = st.getPath().getName()
        if name[:1] in "_.":
            continue
        if st.isDirectory():
            below = [u for u in list_units(spark, f"{path}/{name}") if "=" in u.split("/", 1)[0]]
            out += [f"{name}/{u}" for u in below] or [name]
        else:
            out.append(name)
    return sorted(out)


def age_seconds(spark: SparkSession, path: str) -> float | None:
    """Seconds since the file was written, or None when there is none."""
    fs, p = _fs(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000 if fs.exists(p) else None


def set_time(spark: SparkSession, path: str, days_ago: float) -> None:
    """Set the modification time of the files at or below ``path``, as a preserving copy does."""
    fs, p = _fs(spark, path)
    when = int((time.time() - days_ago * 86400) * 1000)
    for st in fs.listStatus(p):
        fs.setTimes(st.getPath(), when, -1)


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, s = _fs(spark, src)
    jvm = spark.sparkContext._jvm
    d = jvm.org.apache.hadoop.fs.Path(dst)
    if d.getParent() is not None:
        fs.mkdirs(d.getParent())
    return bool(fs.rename(s, d))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, recursive))


def qualify(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    return str(fs.makeQualified(p).toString())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small metadata file (UTF-8)."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small metadata file, or None when it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()
