"""The hand-made 12-point trip of FIXTURES.md section 3, through every step and trip operator."""

import random

import pytest
from pyspark.sql import functions as F

from roadprint.operators import arrays, assembly, events, features, kinematics

X = [0, 3, 3, 6, 6, 6, 6.2, 9.2, 15.2, 15.2, 12.2, 12.2]
Y = [0, 4, 4, 8, 8, 8, 8, 12, 20, 20, 16, 16]
EXPECTED = {
    "r": [0, 5, 5, 10, 10, 10, 10.121265, 15.120847, 25.12051, 25.12051, 20.120636, 20.120636],
    "theta": [0, .927295, .927295, .927295, .927295, .927295, .911486, .916714, .920926,
              .920926, .919343, .919343],
    "v": [0, 5, 0, 5, 0, 0, 0.2, 5, 10, 0, 5, 0],
    "a": [0, 5, -5, 5, -5, 0, 0.2, 4.8, 5, -10, 5, -5],
    "jerk": [0, 5, -10, 10, -10, 5, 0.2, 4.6, 0.2, -15, 15, -10],
    "cent_acc": [0, 5, 0, 2.5, 0, 0, .003952, 1.653347, 3.980811, 0, 1.242505, 0],
    "ang_vel": [0, .927295, 0, 0, 0, 0, -.015809, .005227, .004212, 0, -.001583, 0],
    "tan_acc": [0, .927295, -.927295, 0, 0, 0, -.015809, .021036, -.001015, -.004212,
                -.001583, .001583],
}
TOL = 1e-6


def steps_df(spark, shuffle=False):
    rows = [(1, "t1", i + 1, float(x), float(y)) for i, (x, y) in enumerate(zip(X, Y))]
    if shuffle:
        random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "driver long, trip string, step long, x double, y double")


def close(a, b, tol=TOL):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tol + 1e-9 * abs(b)


@pytest.mark.parametrize("shuffle", [False, True])
def test_step_columns(spark, shuffle):
    kin = kinematics.kinematics(steps_df(spark, shuffle)).orderBy("step").collect()
    for col, want in EXPECTED.items():
        got = [r[col] for r in kin]
        assert all(close(g, w) for g, w in zip(got, want)), (col, got)


def test_smoothed_speed(spark):
    kin = kinematics.kinematics(steps_df(spark), smoothed=True).orderBy("step").collect()
    assert [round(r["v"], 6) for r in kin[:3]] == [2.52, 3.02, 2.52]
    assert all(r["v"] is None for r in kin[3:])
    assert [round(r["a"], 6) for r in kin[:3]] == [2.52, 0.5, -0.5]
    assert [round(r["jerk"], 6) for r in kin[:3]] == [2.52, -2.02, -1.0]
    # angular series keep every row
    assert all(r["ang_vel"] is not None for r in kin)


def test_trip_features(spark):
    kin = kinematics.kinematics(steps_df(spark))
    names = features.V1 + features.PCT7 + ["distance", "a_first", "a_second"]
    f = features.trip_features(kin, names).collect()[0].asDict()
    want = {
        "mean_v": 2.516667, "std_v": 3.215025, "min_v": 0, "max_v": 10,
        "mean_a": 0, "std_a": 4.983974, "min_a": -10, "max_a": 5,
        "mean_pos_a": 3.125, "std_pos_a": 2.370522, "mean_neg_a": -6.25, "std_neg_a": 2.165064,
        "mean_ang_vel": 0.076612, "std_ang_vel": 0.256538,
        "mean_tan_acc": 0, "std_tan_acc": 0.378646,
        "mean_jerk": -0.416667, "std_jerk": 8.751936,
        "distance": 30.2, "trip_length": 12, "time_stop": 7, "a_first": 0, "a_second": 5,
        "v_p05": 0, "v_p50": 0.1, "v_p95": 7.25,
        "a_p05": -7.25, "a_p50": 0.1, "a_p95": 5,
        "a_pos_p05": 0, "a_pos_p50": 4.9, "a_pos_p95": 5,
        "a_neg_p05": -9.25, "a_neg_p50": -5, "a_neg_p95": -5,
        "ang_vel_p05": -0.007985, "ang_vel_p50": 0, "ang_vel_p95": 0.420158,
        "tan_acc_p05": -0.425978, "tan_acc_p50": 0, "tan_acc_p95": 0.428853,
        "jerk_p05": -12.25, "jerk_p50": 0.2, "jerk_p95": 12.25,
    }
    for k, w in want.items():
        assert close(f[k], w), (k, f[k], w)


def test_events(spark):
    kin = kinematics.kinematics(steps_df(spark))
    ev = events.accel_events(kin).orderBy("event_no").collect()
    got = [(r["sign"], r["n_steps"], r["end_index"]) for r in ev]
    assert got == [(0, 1, 0), (1, 1, 1), (-1, 1, 2), (1, 1, 3), (-1, 1, 4), (0, 1, 5),
                   (1, 3, 8), (-1, 1, 9), (1, 1, 10), (-1, 1, 11)]
    assert sum(r["n_steps"] for r in ev) == 12
    m = events.event_means(events.accel_events(kin)).collect()[0]
    assert close(m["mean_pos_events"], 4.583333) and m["n_pos_events"] == 4
    assert close(m["mean_neg_events"], -6.25) and m["n_neg_events"] == 4


def test_arrays_equal_windows(spark):
    steps = steps_df(spark, shuffle=True)
    for smoothed in (False, True):
        win = kinematics.kinematics(steps, smoothed=smoothed).orderBy("step").collect()
        arr = arrays.explode_kinematics(
            arrays.kinematics_arrays(assembly.trip_vectors(steps), smoothed=smoothed)
        ).orderBy("step").collect()
        assert len(win) == len(arr) == 12
        for a, b in zip(win, arr):
            for c in ("r", "theta", "v", "a", "cent_acc", "ang_vel", "tan_acc", "jerk"):
                assert close(a[c], b[c], 1e-12), (smoothed, c, a[c], b[c])


def test_edge_trips(spark):
    rows = [(9, "one", 1, 3.0, 4.0), (9, "two", 1, 0.0, 0.0), (9, "two", 2, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "driver long, trip string, step long, x double, y double")
    f = {r["trip"]: r for r in features.features_for_version(df, 3).collect()}
    assert f["one"]["trip_length"] == 1 and f["one"]["mean_v"] is None  # shorter than the MA order
    f1 = {r["trip"]: r for r in features.features_for_version(df, 1).collect()}
    assert f1["one"]["mean_v"] == 5.0 and f1["two"]["mean_neg_a"] is None
    empty = df.where("driver < 0")
    assert features.features_for_version(empty, 2).count() == 0


def _trip(spark, pts, trip="e"):
    rows = [(1, trip, i + 1, float(x), float(y)) for i, (x, y) in enumerate(pts)]
    return spark.createDataFrame(rows, "driver long, trip string, step long, x double, y double")


def test_smoothing_border_9_and_10_points(spark):
    nine = _trip(spark, [(i, 0) for i in range(9)], "nine")
    ten = _trip(spark, [(i, 0) for i in range(10)], "ten")
    k9 = kinematics.kinematics(nine, smoothed=True).collect()
    k10 = kinematics.kinematics(ten, smoothed=True).orderBy("step").collect()
    assert all(r["v"] is None for r in k9)                    # 0 smoothed values
    assert [r["v"] is not None for r in k10] == [True] + [False] * 9   # exactly 1
    assert abs(k10[0]["v"] - 0.9) < 1e-12                      # (0 + 1*9) / 10


def test_origin_mid_trip_all_equal_and_no_braking(spark):
    k = kinematics.kinematics(_trip(spark, [(1, 1), (0, 0), (2, 0)])).orderBy("step").collect()
    assert k[1]["r"] == 0 and k[1]["cent_acc"] == 0.0 and k[1]["theta"] == 0.0
    same = features.trip_features(kinematics.kinematics(_trip(spark, [(2, 2)] * 5)),
                                  features.V1).collect()[0]
    # v = [2*sqrt(2), 0, 0, 0, 0]: v[0] is the distance from the origin
    assert same["time_stop"] == 4 and same["min_v"] == 0.0
    assert abs(same["max_v"] - 8 ** 0.5) < 1e-12 and abs(same["std_v"] - 2 * 8 ** 0.5 / 5) < 1e-12
    mono = features.trip_features(kinematics.kinematics(_trip(spark, [(i * i, 0) for i in range(6)])),
                                  ["mean_neg_a", "std_neg_a", "mean_pos_a"]).collect()[0]
    assert mono["mean_neg_a"] is None and mono["std_neg_a"] is None and mono["mean_pos_a"] is not None


def test_heading_crossing_pi(spark):
    # points just above and just below the negative x axis: theta jumps by about 2 pi
    pts = [(-1, 0.01), (-1, -0.01), (-1, 0.01)]
    raw = kinematics.kinematics(_trip(spark, pts)).orderBy("step").collect()
    assert abs(raw[1]["ang_vel"]) > 6.0                        # literal difference (reference)
    wrapped = kinematics.kinematics(_trip(spark, pts), wrap=True).orderBy("step").collect()
    assert all(-3.1416 <= r["ang_vel"] < 3.1416 for r in wrapped)
    assert abs(wrapped[1]["ang_vel"] - 0.02) < 1e-3


def test_hot_trip_path_equals_window_path(spark):
    import math
    pts = [(math.cos(i / 7.0) * i, math.sin(i / 5.0) * 3 + (i % 4)) for i in range(120)]
    df = _trip(spark, pts, "long").unionByName(_trip(spark, pts[:15], "short"))
    for v in (2, 4):
        a = {r["trip"]: r for r in features.features_for_version(df, v, hot_rows=None).collect()}
        b = {r["trip"]: r for r in features.features_for_version(df, v, hot_rows=50,
                                                                 segment_rows=11).collect()}
        for t in a:
            for c in a[t].asFields() if hasattr(a[t], "asFields") else a[t].asDict():
                x, y = a[t][c], b[t][c]
                assert (x is None and y is None) or x == y or abs(x - y) < 1e-9, (v, t, c, x, y)


def test_hot_trip_path_with_gapped_steps(spark):
    import math
    rows, s = [], 0
    for i in range(90):
        s += 1 + (i * 7) % 5 * 3          # gaps of 1..13 between step values
        rows.append((2, "gap", s, math.sin(i / 3.0) * 10, float(i % 6)))
    df = spark.createDataFrame(rows, "driver long, trip string, step long, x double, y double")
    for smoothed in (False, True):
        a = {r["step"]: r for r in kinematics.kinematics(df, smoothed=smoothed).collect()}
        b = {r["step"]: r for r in kinematics.kinematics(df, smoothed=smoothed, hot_rows=10,
                                                         segment_rows=9).collect()}
        assert a.keys() == b.keys()
        for k in a:
            assert a[k]["step_no"] == b[k]["step_no"]
            for c in ("v", "a", "jerk", "cent_acc", "ang_vel", "tan_acc"):
                assert close(a[k][c], b[k][c], 1e-12), (smoothed, k, c)
    ea = sorted(tuple(r) for r in events.events_from_steps(df, hot_rows=None).collect())
    eb = sorted(tuple(r) for r in events.events_from_steps(df, hot_rows=10, segment_rows=9).collect())
    assert ea == eb


def test_approx_percentiles_close_to_exact(spark):
    import math
    pts = [(math.cos(i / 9.0) * i, (i % 11) * 1.5) for i in range(400)]
    kin = kinematics.kinematics(_trip(spark, pts, "long"), hot_rows=None)
    exact = features.trip_features(kin, features.PCT7).collect()[0]
    approx = features.trip_features(kin, features.PCT7, approx=True).collect()[0]
    for n in features.PCT7:
        assert abs(exact[n] - approx[n]) <= 0.05 * max(1.0, abs(exact[n])) + 1.0, n


def test_fixed_values():
    """Levels, thresholds and feature order, written out here so that no shared constant can drift."""
    from roadprint.functions import columns
    from roadprint.operators import models
    assert columns.PERCENT_LEVELS == [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7,
                                      0.75, 0.8, 0.85, 0.9, 0.95]
    assert (columns.MA_ORDER, columns.STOP_SPEED, columns.MPS_TO_MPH, columns.BAND_MPH) == (10, 0.5, 2.23694, 15.0)
    assert models.GBT_TREES == [5, 25, 45, 65, 85] and models.LABELS == ["0.0", "1.0"]
    assert features.V1 == ["min_v", "max_v", "min_a", "max_a", "trip_length", "mean_v", "std_v", "mean_a", "std_a",
                           "mean_pos_a", "std_pos_a", "mean_neg_a", "std_neg_a", "mean_ang_vel", "std_ang_vel",
                           "mean_tan_acc", "std_tan_acc", "mean_jerk", "std_jerk", "time_stop"]
    assert features.V2[-20:] == features.V1 and features.V2[:2] == ["v_p05", "v_p10"] and len(features.V2) == 153
    assert {v: s for v, (s, _) in features.VERSIONS.items()} == {1: False, 2: False, 3: True, 4: True}
