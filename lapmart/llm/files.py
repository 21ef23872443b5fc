"""Binary files on shared storage, written and read inside tasks through pyarrow's file systems.

A task writes under a name of its own and returns it; only names that reach
the written manifest count, so a retried or speculative task does no harm.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def open_fs(path: str):
    """(file system, path in it) of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def new_name(folder: str, shard: int, suffix: str) -> str:
    return f"{folder}/part-{shard:06d}-{uuid.uuid4().hex[:12]}{suffix}"


def one_row_tasks(df: DataFrame, n: int) -> DataFrame:
    """Deals out ``n`` small rows (of files or byte ranges) one by one."""
    return df.repartition(max(1, n))
