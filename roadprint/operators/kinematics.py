"""Step-level kinematics as window expressions over one trip window.

Every difference is taken against the previous row of the same trip, with
0.0 before the first row (so ``v[0]`` is the distance from the origin and
``a[0] = v[0]``).  All windows share ``partitionBy(driver, trip).orderBy(step)``;
Spark plans one Exchange and one sort for all of them, and the trip
aggregates that follow reuse that partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadprint.functions.columns import HOT_TRIP_ROWS, KEYS, MA_ORDER, lag0, trip_window

KINEMATIC_COLUMNS = ["r", "theta", "v", "a", "cent_acc", "ang_vel", "tan_acc", "jerk"]


def polar(steps: DataFrame) -> DataFrame:
    """K1, K2: distance from the origin and polar angle."""
    x, y = F.col("x"), F.col("y")
    return steps.withColumn("r", F.sqrt(x * x + y * y)).withColumn("theta", F.atan2(y, x))


def lag_zero(steps: DataFrame, cols=("x", "y"), keys=None, hot_rows: int | None = HOT_TRIP_ROWS,
             segment_rows: int | None = None) -> DataFrame:
    """K3: previous value in the trip, 0.0 for the first row; hot trips in row segments."""
    from roadprint.operators.segments import over_trips
    return over_trips(steps, lambda df, w: df.select("*", *[lag0(c, w).alias(f"prev_{c}") for c in cols]), 1, 0,
                      keys, hot_rows, segment_rows)


def speed(steps: DataFrame, keys=None, hot_rows: int | None = HOT_TRIP_ROWS,
          segment_rows: int | None = None) -> DataFrame:
    """K4: displacement per step (one step = one second); hot trips in row segments."""
    from roadprint.operators.segments import over_trips

    def series(df: DataFrame, w) -> DataFrame:
        dx, dy = F.col("x") - lag0("x", w), F.col("y") - lag0("y", w)
        return df.withColumn("v", F.sqrt(dx * dx + dy * dy))
    return over_trips(steps, series, 1, 0, keys, hot_rows, segment_rows)


def moving_average(df: DataFrame, col: str = "v", order: int = MA_ORDER, keys=None, out: str | None = None,
                   hot_rows: int | None = HOT_TRIP_ROWS, segment_rows: int | None = None) -> DataFrame:
    """Forward moving average over rows i .. i+order-1; null where the frame is short.

    Written as an explicit left-to-right sum of leads so that the result does
    not depend on how an engine evaluates sliding frames.  Hot trips go in row segments.
    """
    from roadprint.operators.segments import over_trips

    def series(rows: DataFrame, w) -> DataFrame:
        total = F.col(col)
        for k in range(1, order):
            total = total + F.lead(col, k).over(w)
        complete = F.lead(col, order - 1).over(w).isNotNull() if order > 1 else F.col(col).isNotNull()
        return rows.withColumn(out or f"{col}_ma", F.when(complete, total / float(order)))
    return over_trips(df, series, 0, order - 1, keys, hot_rows, segment_rows)


def _wrap_angle(c):
    two_pi = 2.0 * math.pi
    return c - F.floor((c + math.pi) / two_pi) * two_pi


def kinematics(steps: DataFrame, smoothed: bool = False, order: int = MA_ORDER,
               wrap: bool = False, keys=None, hot_rows: int | None = HOT_TRIP_ROWS,
               segment_rows: int | None = None, with_prev: bool = False) -> DataFrame:
    """K12 (raw) or K11 (smoothed): r, theta, v, a, cent_acc, ang_vel, tan_acc, jerk.

    Smoothed: ``v`` is the order-``order`` forward moving average of the raw
    speed (null for the last ``order - 1`` rows, all null for shorter trips),
    and ``a``, ``jerk`` and ``cent_acc`` follow from it; ``ang_vel`` and
    ``tan_acc`` keep every row.  ``step_no`` is the 1-based row in the trip.

    Plan: one Window operator fetches the neighbouring points (x, y up to
    three rows back, and ``order - 1`` rows ahead when smoothed; theta two
    rows back); one code-generated projection then computes every series.
    ``v`` of row i-1 is recomputed from the same two points that row i-1
    used, so the values equal the chained form (lag of v, lag of a) exactly.

    ``hot_rows``: trips with more rows are not sent to one task; they are cut
    into row segments with halos (see ``operators.segments``).  One count job
    checks the trip sizes; ``hot_rows=None`` skips the check (one window).
    """
    keys = keys or KEYS
    if hot_rows is not None:
        from roadprint.operators import segments
        return segments.split_kinematics(steps, smoothed, order, wrap, keys, hot_rows,
                                         segment_rows, with_prev)
    w = trip_window(keys)
    return kinematics_frame(steps, w, smoothed, order, wrap, keys,
                            [c for c in steps.columns if c not in set(keys) | {"step", "x", "y"}],
                            with_prev=with_prev, number_rows=True)


def kinematics_frame(df: DataFrame, w, smoothed: bool, order: int, wrap: bool, keys,
                     extra, with_prev: bool = False, number_rows: bool = False) -> DataFrame:
    """The kinematics projection over window ``w``.

    ``number_rows`` numbers the rows (``step_no``) in the same window operator;
    otherwise ``df`` already has ``step_no``.  ``with_prev`` adds ``_a_prev``,
    the acceleration of the previous row.
    """
    ahead = order - 1 if smoothed else 0
    nb = {"step_no": F.row_number().over(w).cast("bigint")} if number_rows else {}
    for k in range(1, 4):
        nb[f"_x_m{k}"], nb[f"_y_m{k}"] = lag0("x", w, k), lag0("y", w, k)
    for k in range(1, 3):
        nb[f"_t_m{k}"] = lag0("theta", w, k)
    for k in range(1, ahead + 1):
        nb[f"_x_p{k}"], nb[f"_y_p{k}"] = F.lead("x", k).over(w), F.lead("y", k).over(w)
    df = polar(df).select("*", *[c.alias(n) for n, c in nb.items()])

    def pt(j):
        if j == 0:
            return F.col("x"), F.col("y")
        tag = f"m{-j}" if j < 0 else f"p{j}"
        return F.col(f"_x_{tag}"), F.col(f"_y_{tag}")

    def speed_at(j):  # displacement from row j-1 to row j, relative to the current row
        (x1, y1), (x0, y0) = pt(j), pt(j - 1)
        dx, dy = x1 - x0, y1 - y0
        return F.sqrt(dx * dx + dy * dy)

    if smoothed:
        def ma(j):  # forward moving average starting at relative row j
            total = speed_at(j)
            for k in range(1, order):
                total = total + speed_at(j + k)
            return total / float(order)
        no = F.col("step_no")
        v0 = ma(0)
        v1 = F.when(no > 1, ma(-1)).otherwise(F.lit(0.0))
        v2 = F.when(no > 2, ma(-2)).otherwise(F.lit(0.0))
    else:
        v0, v1, v2 = speed_at(0), speed_at(-1), speed_at(-2)
    a0, a1 = v0 - v1, v1 - v2
    t0, t1, t2 = F.col("theta"), F.col("_t_m1"), F.col("_t_m2")
    ang0, ang1 = t0 - t1, t1 - t2
    if wrap:
        ang0, ang1 = _wrap_angle(ang0), _wrap_angle(ang1)
    r = F.col("r")
    return df.select(
        *keys, "step", "step_no", "x", "y", "r", "theta",
        v0.alias("v"), a0.alias("a"),
        F.when(r == 0, F.lit(0.0)).otherwise(v0 * v0 / r).alias("cent_acc"),
        ang0.alias("ang_vel"), (ang0 - ang1).alias("tan_acc"), (a0 - a1).alias("jerk"),
        *extra, *([a1.alias("_a_prev")] if with_prev else []))
