"""Kinematics on the array layouts (one row per trip, or rows of bounded size).

Higher-order array functions (``transform``, ``zip_with``) replace the
reference's Python UDFs; each derived array is bound to a column before the
next one reads it, so every element is computed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadprint.functions.columns import HOT_TRIP_ROWS, KEYS, MA_ORDER
from roadprint.operators.assembly import CHUNK_POINTS, own_points, trip_chunks

BACK = 3  # points before a point that its jerk depends on
SERIES = ["x", "y", "step", "r", "theta", "v", "a", "cent_acc", "ang_vel", "tan_acc", "jerk"]


def _shift(col: str):
    arr = F.col(col)
    return F.transform(arr, lambda q, i: F.when(i == 0, F.lit(0.0)).otherwise(F.get(arr, i - 1)))


def _diff(df: DataFrame, col: str, out: str) -> DataFrame:
    df = df.withColumn("_prev", _shift(col))
    return df.withColumn(out, F.zip_with(col, "_prev", lambda a, b: a - b)).drop("_prev")


def polar_arrays(trips: DataFrame) -> DataFrame:
    """r and theta arrays next to x and y."""
    return (trips.withColumn("r", F.zip_with("x", "y", lambda p, q: F.sqrt(p * p + q * q)))
                 .withColumn("theta", F.zip_with("x", "y", lambda p, q: F.atan2(q, p))))


def _moving_average_array(col: str, order: int):
    arr = F.col(col)
    n = F.size(arr)

    def frame(i):
        total = F.get(arr, i)
        for k in range(1, order):
            total = total + F.get(arr, i + k)
        return total / float(order)

    return F.when(n >= order, F.transform(F.sequence(F.lit(0), n - order), frame)) \
            .otherwise(F.array().cast("array<double>"))


def kinematics_arrays(trips: DataFrame, smoothed: bool = False, order: int = MA_ORDER) -> DataFrame:
    """The K1-K11 series as arrays (same values as the window form)."""
    df = polar_arrays(trips)
    df = _diff(df, "x", "_dx")
    df = _diff(df, "y", "_dy")
    df = df.withColumn("v", F.zip_with("_dx", "_dy", lambda p, q: F.sqrt(p * p + q * q)))
    if smoothed:
        df = df.withColumn("v", _moving_average_array("v", order))
    df = _diff(df, "v", "a")
    df = df.withColumn("cent_acc", F.zip_with(
        "v", "r", lambda v, r: F.when(r == 0, F.lit(0.0)).otherwise(v * v / r)))
    df = _diff(df, "theta", "ang_vel")
    df = _diff(df, "ang_vel", "tan_acc")
    df = _diff(df, "a", "jerk")
    return df.drop("_dx", "_dy")


def kinematics_chunks(steps: DataFrame, smoothed: bool = False, order: int = MA_ORDER, keys=None,
                      chunk_points: int = CHUNK_POINTS, hot_rows: int | None = HOT_TRIP_ROWS) -> DataFrame:
    """K13 / F2 for trips of any length: the series of a chunk's own points, read off the chunk with its halos.

    Values that the first halo points lack neighbours for are cut off with the halo.  A smoothed series
    ends where its trip has no whole frame left, which is inside one of the trip's last two chunks.
    """
    chunks = trip_chunks(steps, keys, chunk_points, BACK, order - 1 if smoothed else 0, hot_rows)
    return own_points(kinematics_arrays(chunks, smoothed, order), SERIES)


def polar_chunks(steps: DataFrame, keys=None, chunk_points: int = CHUNK_POINTS,
                 hot_rows: int | None = HOT_TRIP_ROWS) -> DataFrame:
    """F1 for trips of any length."""
    return polar_arrays(trip_chunks(steps, keys, chunk_points, hot_rows=hot_rows))


def explode_kinematics(karr: DataFrame, keys=None, series: list[str] | None = None) -> DataFrame:
    """Arrays of K13 back to one row per step; smoothed series are null past their end.

    The arrays are exploded as one zipped array, so a filter on a series reads the exploded rows: one
    on an array element would be pushed below, into a condition that computes the series anew.
    ``series``: those wanted, in order (all by default); the planner drops arrays that none of them needs, which it
    cannot tell from the fields of a zipped array.
    """
    keys = keys or KEYS
    wanted = [c for c in series or SERIES if c != "step"]
    point = F.explode(F.arrays_zip(*[F.col(c) for c in ["step", *wanted]])).alias("p")
    return karr.select(*keys, point).select(*keys, "p.step", *[f"p.{c}" for c in wanted])
