"""Raw snapshot files: compressed, bounded, and read back as they were."""

from __future__ import annotations

import os

import pytest

from lapmart.sources import rawfiles


@pytest.mark.parametrize("fmt, options, name", [("csv", {"header": True}, "a.csv"), ("json", {}, "a.json"),
                                                ("json", {"multiline": True}, "a.json")])
def test_files_are_compressed_and_read_back(spark, monkeypatch, tmp_path, fmt, options, name):
    monkeypatch.setattr(rawfiles, "MOST_RECORDS", 300)
    df = spark.range(1000).selectExpr("id", "repeat('ab, \"c', 20) AS t", "if(id % 2 = 0, 'x', 'y') AS folder").coalesce(1)
    assert rawfiles.write_snapshots(df, str(tmp_path), name, fmt, "folder", **options) == ["x", "y"]
    files = [os.path.join(d, f) for d, _, names in os.walk(tmp_path) for f in names if f.startswith("part-")]
    assert all(f.endswith(rawfiles.CODEC) for f in files)
    assert sum(map(os.path.getsize, files)) < 40_000              # 130 KB as plain text
    assert len(files) == 2 if options.get("multiline") else len(files) == 4
    reader = spark.read.schema("id long, t string").option("multiLine", str(options.get("multiline", False)).lower())
    path = f"{tmp_path}/*/{name}"
    out = reader.option("header", "true").option("escape", "\\").csv(path) if fmt == "csv" else reader.json(path)
    assert sorted(map(tuple, out.collect())) == [(i, 'ab, "c' * 20) for i in range(1000)]
