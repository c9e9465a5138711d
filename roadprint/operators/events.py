"""V1-V8: acceleration events (runs of equal sign of ``a``) and speed plateaus.

A gaps-and-islands pattern: a change flag against the previous row's sign,
a running sum of the flags numbers the runs, and a ``groupBy`` on
(driver, trip, event_no) summarises them.  Both the window and the two
aggregation levels are clustered by (driver, trip): one Exchange in all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadprint.functions.columns import BAND_MPH, HOT_TRIP_ROWS, KEYS, MPS_TO_MPH, trip_window


def accel_events(kin: DataFrame, keys=None) -> DataFrame:
    """V1, V2, V6, V7: one row per run of equal sign(a) in {-1, 0, 1}.

    ``end_index`` is the 0-based index of the last step of the run (the
    reference's index), ``end_speed`` the speed at that step.
    """
    keys = keys or KEYS
    w = trip_window(keys)
    k = kin.where(F.col("a").isNotNull()).withColumn("sign", F.signum("a").cast("int"))
    prev = F.lag("sign").over(w)
    k = k.withColumn("_chg", F.when(prev.isNull() | (prev != F.col("sign")), 1).otherwise(0))
    k = k.withColumn("event_no", F.sum("_chg").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("bigint"))
    return summarise_events(k, keys)


def summarise_events(k: DataFrame, keys) -> DataFrame:
    """One row per (trip, event_no) from rows carrying ``sign`` and ``event_no``."""
    return k.groupBy(*keys, "event_no").agg(
        F.max("sign").alias("sign"),
        F.count(F.lit(1)).alias("n_steps"),
        F.avg("a").alias("mean_a"),
        F.min("step").alias("start_step"),
        F.max("step").alias("end_step"),
        (F.max("step_no") - 1).alias("end_index"),
        F.max_by("v", "step").alias("end_speed"),
    )


def positive_events(events: DataFrame) -> DataFrame:
    """V3: acceleration events (first value > 0)."""
    return events.where(F.col("sign") == 1)


def negative_events(events: DataFrame) -> DataFrame:
    """V4: deceleration events (first value < 0)."""
    return events.where(F.col("sign") == -1)


def event_means(events: DataFrame, keys=None) -> DataFrame:
    """V5: per trip, the unweighted mean of event means (null when there is none)."""
    keys = keys or KEYS
    pos = F.col("sign") == 1
    neg = F.col("sign") == -1
    return events.groupBy(*keys).agg(
        F.count(F.when(pos, 1)).alias("n_pos_events"),
        F.avg(F.when(pos, F.col("mean_a"))).alias("mean_pos_events"),
        F.count(F.when(neg, 1)).alias("n_neg_events"),
        F.avg(F.when(neg, F.col("mean_a"))).alias("mean_neg_events"),
        F.count(F.lit(1)).alias("n_events"),
        F.avg("mean_a").alias("mean_all_events"),
    )


def speed_bands(kin: DataFrame, keys=None, band_mph: float = BAND_MPH) -> DataFrame:
    """V8: mean speed per plateau band of ``band_mph`` miles per hour."""
    keys = keys or KEYS
    band = F.floor(F.col("v") * MPS_TO_MPH / band_mph).cast("bigint")
    return (kin.where(F.col("v").isNotNull()).withColumn("band", band)
               .groupBy(*keys, "band")
               .agg(F.count(F.lit(1)).alias("n_steps"), F.avg("v").alias("mean_v")))


def _events_one_window(steps: DataFrame, smoothed: bool, keys) -> DataFrame:
    """Events with the previous row's acceleration taken from the kinematics window
    (no separate lag window); the running sum is the only extra window."""
    from roadprint.operators.kinematics import kinematics
    k = kinematics(steps, smoothed=smoothed, keys=keys, hot_rows=None, with_prev=True)
    k = (k.where(F.col("a").isNotNull())
          .withColumn("sign", F.signum("a").cast("int"))
          .withColumn("_chg", F.when((F.col("step_no") == 1)
                                     | (F.col("sign") != F.signum("_a_prev").cast("int")), 1)
                      .otherwise(0)))
    w = trip_window(keys)
    k = k.withColumn("event_no", F.sum("_chg").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("bigint"))
    return summarise_events(k, keys)


def events_from_steps(steps: DataFrame, smoothed: bool = False, keys=None,
                      hot_rows: int | None = HOT_TRIP_ROWS,
                      segment_rows: int | None = None) -> DataFrame:
    """V1/V2 straight from steps; trips above ``hot_rows`` rows take the segmented path."""
    from roadprint.operators.kinematics import kinematics
    keys = keys or KEYS
    if hot_rows is None:
        return _events_one_window(steps, smoothed, keys)
    from roadprint.operators import segments
    normal, hot, n = segments.split_hot(steps, hot_rows, keys)
    out = _events_one_window(normal, smoothed, keys)
    if hot is None:
        return out
    return out.unionByName(
        segments.segmented_accel_events(hot, smoothed, keys, segment_rows or segments.SEGMENT_ROWS, n))
