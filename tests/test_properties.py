"""Property tests: upsert against a dictionary model, bucketed rank against the window."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lapmart.operators.ranking import rank_desc, rank_desc_window
from lapmart.operators.upsert import MergeCardinalityError, upsert_all, upsert_columns

keys = st.one_of(st.none(), st.integers(0, 6))
row = st.tuples(keys, st.integers(0, 99), st.integers(0, 99))
SCHEMA = "k int, a int, b int"
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _unique_source(src):
    seen, out = set(), []
    for r in src:
        if r[0] is None or r[0] not in seen:
            out.append(r)
            if r[0] is not None:
                seen.add(r[0])
    return out


def model_upsert(target, source, update=None):
    src_by_key = {r[0]: r for r in source if r[0] is not None}
    out = []
    for r in target:
        s = src_by_key.get(r[0]) if r[0] is not None else None
        if s is None:
            out.append(r)
        elif update is None:
            out.append(s)
        else:
            out.append((r[0], s[1] if "a" in update else r[1], s[2] if "b" in update else r[2]))
    matched = {r[0] for r in target if r[0] is not None}
    out += [s for s in source if s[0] is None or s[0] not in matched]
    return sorted(out, key=repr)


@SETTINGS
@given(st.lists(row, max_size=12), st.lists(row, max_size=12), st.booleans())
def test_upsert_all_matches_model(spark, target, source, whole):
    """Target keys may repeat; the source may lack a column; repeated source keys that match raise."""
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    s = s if whole else s.drop("b")
    known = {r[0] for r in target if r[0] is not None}
    keys = [r[0] for r in source if r[0] in known]
    if len(keys) != len(set(keys)):
        with pytest.raises(MergeCardinalityError):
            upsert_all(t, s, ["k"])
        return
    got = sorted((tuple(r) for r in upsert_all(t, s, ["k"]).collect()), key=repr)
    if whole:
        assert got == model_upsert(target, source)
    else:
        lacking = [(r[0], r[1], None) for r in source]
        assert got == model_upsert(target, lacking, update={"a"})


@SETTINGS
@given(st.lists(row, max_size=12), st.lists(row, max_size=12))
def test_upsert_columns_matches_model(spark, target, source):
    source = _unique_source(source)
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    got = sorted((tuple(r) for r in upsert_columns(t, s, ["k"], ["b"],
                                                   check_cardinality=False).collect()), key=repr)
    assert got == model_upsert(target, source, update={"b"})


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), st.one_of(
    st.none(), st.sampled_from([0.0, 1.5, 2.0, 7.0, -3.0]))), min_size=1, max_size=30),
    st.sampled_from([1, 3, 8]))
def test_rank_matches_window(spark, data, buckets):
    df = spark.createDataFrame([(p, v, i) for i, (p, v) in enumerate(data)],
                               "p int, v double, i int")
    got = sorted((r.i, r["rank"]) for r in rank_desc(df, ["p"], "v", buckets=buckets).collect())
    exp = sorted((r.i, r["rank"]) for r in rank_desc_window(df, ["p"], "v").collect())
    assert got == exp
