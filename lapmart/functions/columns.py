"""Column expressions shared by the layers (all JVM-side built-ins)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapmart.schemas import RACE_TIMESTAMP_FORMAT

# A snapshot folder is the path segment directly below the raw root.
# The folder name is the snapshot version (a date such as 2021-03-21).


def snapshot_version(raw_root: str) -> Column:
    """``file_date`` of a row: the first folder below ``raw_root`` in its file path.

    Uses the hidden ``_metadata.file_path`` column of file sources, so one
    glob scan over every snapshot replaces a driver-side folder loop.
    """
    root = raw_root.rstrip("/")
    # file paths come back as URIs (file:/..., s3a://bucket/...): match the
    # root's path component, then take the next segment.
    if "://" in root:
        root = "/" + root.split("://", 1)[1].split("/", 1)[-1]
    elif root.startswith("file:"):
        root = root[len("file:"):]
    pattern = _regex_escape(root.rstrip("/")) + "/([^/]+)/"
    # the path is URI-encoded (a space is %20); keep a literal '+' as is
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(decoded, pattern, 1)


def _regex_escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch)
    return "".join(out)


def full_name(forename: Column | str, surname: Column | str) -> Column:
    """``forename || ' ' || surname``; NULL when either part is NULL."""
    return F.concat(_c(forename), F.lit(" "), _c(surname))


def race_timestamp(date: Column | str, time: Column | str) -> Column:
    """Parse ``date time`` with the fixed pattern; NULL (not an error) on any mismatch."""
    return F.try_to_timestamp(F.concat(_c(date), F.lit(" "), _c(time)),
                              F.lit(RACE_TIMESTAMP_FORMAT))


def any_null(cols) -> Column:
    """``c1 IS NULL OR c2 IS NULL OR ...``."""
    return reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols])


def win_flag(position: Column | str) -> Column:
    """TRUE when the position is 1, otherwise NULL (no ``otherwise``)."""
    return F.when(_c(position) == 1, F.lit(True))


def count_wins(position: Column | str) -> Column:
    """Number of rows with position 1; 0 for a group without wins."""
    return F.count(win_flag(position))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(col: str) -> Column:
    """AGG-03: the sum of a column of doubles that doesn't depend on the order of the rows.

    Each value is cut, without error, into whole 1024ths and two further parts
    of 26 bits, whose sums are integers (in longs, so hash aggregation with
    map-side combine stays); these are put together once per group.  Exact but
    for bits below 2**-62.  A group with a value of 2**40 or more, or one that
    is not finite, has the plain sum.  NULLs are left out; only NULLs give NULL.
    """
    x = F.col(col).cast("double")
    wild = F.isnan(x) | (F.abs(x) >= F.lit(float(1 << 40)))
    tame = F.when(~wild, x * 1024)
    high = F.floor(tame)
    rest = (tame - high) * (1 << 26)
    middle = F.floor(rest)
    low = F.floor((rest - middle) * (1 << 26))
    parts = F.sum(low) / F.lit(float(1 << 62)) + F.sum(middle) / F.lit(float(1 << 36)) + F.sum(high) / F.lit(1024.0)
    return F.when(F.count_if(wild) > 0, F.sum(x)).otherwise(parts)
