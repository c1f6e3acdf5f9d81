"""Randomised checks of the custom operators against plain-Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from blotter.operators.dedupe import latest_by
from blotter.operators.merge import merge_upsert
from blotter.operators.snapshot import snapshot_check

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
vals = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
keys = st.integers(min_value=0, max_value=6)


def rows_sorted(rows):
    return sorted(rows, key=repr)


@SETTINGS
@given(target=st.dictionaries(keys, st.tuples(vals, vals), max_size=6),
       source=st.dictionaries(keys, st.tuples(vals, vals), max_size=6),
       null_source=st.lists(st.tuples(vals, vals), max_size=2),
       broadcast=st.booleans())
def test_merge_matches_model(spark, target, source, null_source, broadcast):
    schema = "k int, a string, b string"
    t = spark.createDataFrame([(k, a, b) for k, (a, b) in target.items()], schema)
    src_rows = [(k, a, b) for k, (a, b) in source.items()] + [(None, a, b) for a, b in null_source]
    s = spark.createDataFrame(src_rows, schema)
    got = merge_upsert(t, s, ["k"], update_cols=["a"], change_cols=["a", "b"],
                       broadcast_rows=1000 if broadcast else 0).collect()
    expected = []
    for k, (a, b) in target.items():
        if k in source:
            na, nb = source[k]
            changed = (a, b) != (na, nb)
            expected.append((k, na if changed else a, b))
        else:
            expected.append((k, a, b))
    expected += [(k, a, b) for k, (a, b) in source.items() if k not in target]
    expected += [(None, a, b) for a, b in null_source]
    assert rows_sorted(tuple(r) for r in got) == rows_sorted(expected)


@SETTINGS
@given(runs=st.lists(st.dictionaries(keys, vals, max_size=5), min_size=1, max_size=3),
       broadcast=st.booleans())
def test_snapshot_matches_model(spark, runs, broadcast):
    snap, model = None, {}          # model: key -> list of [value, from, to]
    for i, incoming in enumerate(runs):
        stamp = f"2024-01-0{i + 1} 00:00:00"
        df = spark.createDataFrame(list(incoming.items()), "k int, v string")
        snap = snapshot_check(snap, df, "k", ["v"], stamp, broadcast_rows=1000 if broadcast else 0)
        snap = snap.checkpoint(eager=True)
        for k, v in incoming.items():
            versions = model.setdefault(k, [])
            if versions and versions[-1][2] is None and versions[-1][0] == v:
                continue
            if versions and versions[-1][2] is None:
                versions[-1][2] = stamp
            versions.append([v, stamp, None])
    got = [(r.k, r.v, str(r.valid_from), None if r.valid_to is None else str(r.valid_to))
           for r in snap.collect()]
    expected = [(k, v, f, t) for k, vs in model.items() for v, f, t in vs]
    assert rows_sorted(got) == rows_sorted(expected)


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                               st.integers(0, 5), st.sampled_from(["x", "y", "z"])), max_size=12))
def test_latest_by_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, v string")
    got = {r.k: (r.ts, r.v) for r in latest_by(df, ["k"], ["ts"]).collect()}
    expected = {}
    for k, ts, v in rows:
        if k not in expected or (ts, v) > expected[k]:
            expected[k] = (ts, v)
    assert got == expected
