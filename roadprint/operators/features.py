"""Trip-level aggregates and the named feature vectors.

One ``groupBy(driver, trip)`` over the kinematics; the grouping keys equal
the window partition keys, so no second Exchange is planned.  Every feature
is a named DoubleType/BIGINT column; ``assemble`` turns a list of names into
an ML vector.

Percentiles are exact (``percentile``, linear interpolation as numpy) by
default; ``approx=True`` switches to ``percentile_approx`` for very long trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadprint.functions.columns import (HOT_TRIP_ROWS, KEYS, MA_ORDER, PERCENT_LEVELS,
                                         PERCENT_NAMES, STOP_SPEED)
from roadprint.operators.kinematics import kinematics


# Series the statistics are taken over.
SERIES_NAMES = ["v", "a", "a_pos", "a_neg", "ang_vel", "tan_acc", "jerk"]


def series() -> dict[str, Column]:
    a = F.col("a")
    return {"v": F.col("v"), "a": a, "a_pos": F.when(a >= 0, a), "a_neg": F.when(a < 0, a),
            "ang_vel": F.col("ang_vel"), "tan_acc": F.col("tan_acc"), "jerk": F.col("jerk")}


def _base_aggs() -> dict[str, Column]:
    s = series()
    return {
        "min_v": F.min(s["v"]), "max_v": F.max(s["v"]),
        "min_a": F.min(s["a"]), "max_a": F.max(s["a"]),
        "trip_length": F.count(F.lit(1)),
        "distance": F.sum(s["v"]),
        "mean_v": F.avg(s["v"]), "std_v": F.stddev_pop(s["v"]),
        "mean_a": F.avg(s["a"]), "std_a": F.stddev_pop(s["a"]),
        "mean_pos_a": F.avg(s["a_pos"]), "std_pos_a": F.stddev_pop(s["a_pos"]),
        "mean_neg_a": F.avg(s["a_neg"]), "std_neg_a": F.stddev_pop(s["a_neg"]),
        "mean_ang_vel": F.avg(s["ang_vel"]), "std_ang_vel": F.stddev_pop(s["ang_vel"]),
        "mean_tan_acc": F.avg(s["tan_acc"]), "std_tan_acc": F.stddev_pop(s["tan_acc"]),
        "mean_jerk": F.avg(s["jerk"]), "std_jerk": F.stddev_pop(s["jerk"]),
        "time_stop": F.count(F.when(s["v"] < STOP_SPEED, 1)),
        "a_first": F.max(F.when(F.col("step_no") == 1, s["a"])),
        "a_second": F.max(F.when(F.col("step_no") == 2, s["a"])),
    }


BASE_FEATURES = ["min_v", "max_v", "min_a", "max_a", "trip_length", "distance", "mean_v",
                 "std_v", "mean_a", "std_a", "mean_pos_a", "std_pos_a", "mean_neg_a",
                 "std_neg_a", "mean_ang_vel", "std_ang_vel", "mean_tan_acc", "std_tan_acc",
                 "mean_jerk", "std_jerk", "time_stop", "a_first", "a_second"]


def pct_names(series) -> list[str]:
    return [f"{s}_{p}" for s in series for p in PERCENT_NAMES]


# The feature order of each vector.
V1 = ["min_v", "max_v", "min_a", "max_a", "trip_length", "mean_v", "std_v", "mean_a", "std_a",
      "mean_pos_a", "std_pos_a", "mean_neg_a", "std_neg_a", "mean_ang_vel", "std_ang_vel",
      "mean_tan_acc", "std_tan_acc", "mean_jerk", "std_jerk", "time_stop"]
PCT7 = pct_names(["v", "a", "a_pos", "a_neg", "ang_vel", "tan_acc", "jerk"])
V2 = PCT7 + V1
MINIMAL = ["min_v", "max_v", "min_a", "max_a"]
F11 = ["min_v", "max_v", "min_a", "max_a", "trip_length", "distance", "mean_v", "std_v",
       "mean_a", "std_a", "time_stop"]
F48 = pct_names(["v", "a"]) + ["min_v", "max_v", "min_a", "max_a", "trip_length", "mean_v",
                               "std_v", "mean_a", "std_a", "time_stop"]
F90 = pct_names(["v", "a", "a_pos", "a_neg"]) + [
    "min_v", "max_v", "min_a", "max_a", "trip_length", "mean_v", "std_v", "mean_a", "std_a",
    "mean_pos_a", "std_pos_a", "mean_neg_a", "std_neg_a", "time_stop"]

# The four model versions (smoothed speed?, vector).
VERSIONS = {1: (False, V1), 2: (False, V2), 3: (True, V1), 4: (True, V2)}
VECTORS = {"v1": V1, "v2": V2, "minimal": MINIMAL, "f11": F11, "f48": F48, "f90": F90}


def trip_features(kin: DataFrame, names: list[str], keys=None, approx: bool = False,
                  accuracy: int = 10000) -> DataFrame:
    """Aggregate kinematics to one row per trip with the named features (+ label)."""
    keys = keys or KEYS
    base = _base_aggs()
    aggs = [base[n].alias(n) for n in BASE_FEATURES if n in names]
    levels = F.array(*[F.lit(p) for p in PERCENT_LEVELS])
    wanted = {n.rpartition("_")[0] for n in names if n not in base}
    ser = series()
    for s in [s for s in SERIES_NAMES if s in wanted]:
        pct = (F.percentile_approx(ser[s], levels, accuracy) if approx
               else F.percentile(ser[s], levels))
        aggs.append(pct.alias(f"_pct_{s}"))
    has_label = "label" in kin.columns
    if has_label:
        aggs.append(F.max("label").alias("label"))
    out = kin.groupBy(*keys).agg(*aggs)
    cols = []
    for n in names:
        s, _, p = n.rpartition("_")
        if n in base:
            cols.append(F.col(n))
        else:
            cols.append(F.col(f"_pct_{s}").getItem(PERCENT_NAMES.index(p)).alias(n))
    return out.select(*keys, *cols, *(["label"] if has_label else []))


def trip_features_ranked(kin: DataFrame, names: list[str], keys=None, n: int | None = None) -> DataFrame:
    """Same features as ``trip_features`` for hot trips: every aggregate is partial-
    aggregation friendly and the percentiles come from a distributed rank."""
    from roadprint.operators.segments import ranked_percentiles
    keys = keys or KEYS
    base = _base_aggs()
    aggs = [base[n].alias(n) for n in BASE_FEATURES if n in names]
    if "label" in kin.columns:
        aggs.append(F.max("label").alias("label"))
    out = kin.groupBy(*keys).agg(*aggs) if aggs else kin.select(*keys).distinct()
    pct = [n for n in names if n not in base]
    if pct:
        out = out.join(ranked_percentiles(kin, pct, keys, n), keys, "left")
    return out.select(*keys, *names, *(["label"] if "label" in kin.columns else []))


def features_for_version(steps: DataFrame, version: int, keys=None, order: int = MA_ORDER,
                         approx: bool = False, hot_rows: int | None = HOT_TRIP_ROWS,
                         segment_rows: int | None = None) -> DataFrame:
    """Model-version vectors 1-4 straight from steps.

    ``hot_rows``: trips with more rows take the segmented path (no trip in one task).
    """
    smoothed, names = VERSIONS[version]
    return features_from_steps(steps, names, smoothed, keys, order, approx, hot_rows, segment_rows)


def features_from_steps(steps: DataFrame, names: list[str], smoothed: bool = False, keys=None,
                        order: int = MA_ORDER, approx: bool = False,
                        hot_rows: int | None = HOT_TRIP_ROWS,
                        segment_rows: int | None = None) -> DataFrame:
    keys = keys or KEYS
    if hot_rows is None:
        return trip_features(kinematics(steps, smoothed=smoothed, order=order, keys=keys,
                                        hot_rows=None),
                             names, keys, approx=approx)
    from roadprint.operators import segments
    normal, hot, n = segments.split_hot(steps, hot_rows, keys)
    a = trip_features(kinematics(normal, smoothed=smoothed, order=order, keys=keys, hot_rows=None),
                      names, keys,
                      approx=approx)
    if hot is None:
        return a
    kin_hot = segments.segmented_kinematics(hot, smoothed, order, False, keys,
                                            segment_rows or segments.SEGMENT_ROWS, n=n)
    # approximate percentiles aggregate partially, so hot trips need no ranks for them
    b = trip_features(kin_hot, names, keys, approx=True) if approx else trip_features_ranked(kin_hot, names, keys, n)
    return a.unionByName(b)


def features_vector(steps: DataFrame, vector: str, smoothed: bool = False, keys=None) -> DataFrame:
    """A17-A20 and the canonical vectors by name (see ``VECTORS``)."""
    return features_from_steps(steps, VECTORS[vector], smoothed, keys)


def assemble(features: DataFrame, names: list[str], out: str = "features") -> DataFrame:
    """Named columns -> one ML vector; nulls (short smoothed trips) become NaN."""
    from pyspark.ml.feature import VectorAssembler
    filled = features.fillna(float("nan"), subset=[n for n in names])
    return VectorAssembler(inputCols=names, outputCol=out, handleInvalid="keep").transform(filled)
