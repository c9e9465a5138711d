"""Properties over random trips (hypothesis): invariants and agreement of the three plans."""

import random

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from roadprint.operators import arrays, assembly, events, features, kinematics

coord = st.one_of(st.integers(-20, 20).map(float),
                  st.floats(-50, 50, allow_nan=False, allow_infinity=False))
trip_pts = st.lists(st.tuples(coord, coord), min_size=1, max_size=40)
fleet = st.lists(trip_pts, min_size=1, max_size=4)

SETTINGS = settings(max_examples=6, deadline=None,
                    phases=[Phase.explicit, Phase.reuse, Phase.generate],
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


def to_df(spark, trips, shuffle_seed=None):
    rows = [(7, f"t{t}", i + 1, x, y) for t, pts in enumerate(trips) for i, (x, y) in enumerate(pts)]
    if shuffle_seed is not None:
        random.Random(shuffle_seed).shuffle(rows)
    return spark.createDataFrame(rows, "driver long, trip string, step long, x double, y double")


def close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if not isinstance(a, float) or not isinstance(b, float):
        return a == b
    return abs(a - b) <= tol * max(1.0, abs(a), abs(b))


@SETTINGS
@given(trips=fleet)
def test_invariants(spark, trips):
    k = kinematics.kinematics(to_df(spark, trips)).orderBy("trip", "step").collect()
    by_trip = {}
    for r in k:
        by_trip.setdefault(r["trip"], []).append(r)
    for rows in by_trip.values():
        assert all(r["v"] >= 0 for r in rows)
        assert close(sum(r["jerk"] for r in rows), rows[-1]["a"], 1e-7)     # telescoping
        assert close(sum(r["a"] for r in rows), rows[-1]["v"], 1e-7)
    ev = events.accel_events(kinematics.kinematics(to_df(spark, trips))).collect()
    lengths = {}
    for e in ev:
        lengths[e["trip"]] = lengths.get(e["trip"], 0) + e["n_steps"]
    assert lengths == {f"t{t}": len(p) for t, p in enumerate(trips)}


@SETTINGS
@given(trips=fleet, smoothed=st.booleans())
def test_windows_equal_arrays_and_shuffle(spark, trips, smoothed):
    df = to_df(spark, trips)
    win = {(r["trip"], r["step"]): r for r in kinematics.kinematics(df, smoothed=smoothed).collect()}
    arr = arrays.explode_kinematics(arrays.kinematics_arrays(
        assembly.trip_vectors(to_df(spark, trips, shuffle_seed=1)), smoothed=smoothed)).collect()
    assert len(arr) == len(win)
    for r in arr:
        w = win[(r["trip"], r["step"])]
        for c in ("r", "theta", "v", "a", "cent_acc", "ang_vel", "tan_acc", "jerk"):
            assert close(w[c], r[c]), (c, w[c], r[c])


@SETTINGS
@given(trips=fleet, smoothed=st.booleans(), chunk=st.sampled_from([9, 10, 13]), hot=st.sampled_from([None, 12]))
def test_chunked_arrays_equal_windows(spark, trips, smoothed, chunk, hot):
    df = to_df(spark, trips)
    win = {(r["trip"], r["step"]): r for r in kinematics.kinematics(df, smoothed=smoothed).collect()}
    cut = arrays.kinematics_chunks(to_df(spark, trips, shuffle_seed=2), smoothed, chunk_points=chunk, hot_rows=hot)
    arr = arrays.explode_kinematics(cut).collect()
    assert sorted((r["trip"], r["step"]) for r in arr) == sorted(win)
    for r in arr:
        for c in ("r", "theta", "v", "a", "cent_acc", "ang_vel", "tan_acc", "jerk"):
            assert close(win[(r["trip"], r["step"])][c], r[c]), c


@SETTINGS
@given(trips=fleet, version=st.sampled_from([2, 4]))
def test_hot_trip_plan_equals_window_plan(spark, trips, version):
    df = to_df(spark, trips)
    a = {r["trip"]: r.asDict() for r in features.features_for_version(df, version, hot_rows=None).collect()}
    b = {r["trip"]: r.asDict() for r in features.features_for_version(df, version, hot_rows=12,
                                                                     segment_rows=9).collect()}
    assert a.keys() == b.keys()
    for t in a:
        for c, x in a[t].items():
            assert close(x, b[t][c]), (t, c, x, b[t][c])
