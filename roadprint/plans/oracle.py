"""DuckDB SQL text that reproduces the registered queries (the correctness oracle).

Building blocks are CTE strings; the feature and percentile lists are the
same Python lists the Spark operators use, so the two sides cannot drift.
Doubles are rounded half-up to 4 decimals with plain IEEE arithmetic on
both sides (``floor(x * 10000 + 0.5) / 10000``), which absorbs last-bit
differences of summation order without engine-specific rounding rules.
"""

from __future__ import annotations

import math

from roadprint.functions.columns import (BAND_MPH, MA_ORDER, MPS_TO_MPH, PERCENT_LEVELS,
                                         PERCENT_NAMES, STOP_SPEED, U32)
from roadprint.sources.testdata import ADAPTERS_SQL

SEED = 42

W = "WINDOW w AS (PARTITION BY driver, trip ORDER BY step)"


def q(c: str, alias: str | None = None) -> str:
    return f"FLOOR(({c}) * 10000.0 + 0.5) / 10000.0 AS {alias or c}"


def h(*parts: str) -> str:
    """md5 of '|'-joined parts as an integer in [0, 2**32) -- same as ``columns.u32``."""
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT"


def steps_cte(adapter: str = "events") -> str:
    return f"steps AS ({ADAPTERS_SQL[adapter]})"


def _wrap(c: str) -> str:
    pi, two_pi = repr(math.pi), repr(2.0 * math.pi)
    return (f"(({c}) - FLOOR((({c}) + CAST({pi} AS DOUBLE)) / CAST({two_pi} AS DOUBLE)) "
            f"* CAST({two_pi} AS DOUBLE))")


def kin_ctes(smoothed: bool = False, src: str = "steps", order: int = MA_ORDER,
             wrap: bool = False) -> str:
    """CTEs ending in ``kin`` (driver, trip, step, step_no, x, y, r, theta, v, a, cent_acc,
    ang_vel, tan_acc, jerk)."""
    dx = "(x - lag(x, 1, 0.0) OVER w)"
    dy = "(y - lag(y, 1, 0.0) OVER w)"
    k1 = (f"k1 AS (SELECT driver, trip, step, x, y, sqrt(x * x + y * y) AS r, atan2(y, x) AS theta, "
          f"CAST(row_number() OVER w AS BIGINT) AS step_no, "
          f"sqrt({dx} * {dx} + {dy} * {dy}) AS v FROM {src} {W})")
    prev = "k1"
    ctes = [k1]
    if smoothed:
        total = " + ".join(["v"] + [f"lead(v, {k}) OVER w" for k in range(1, order)])
        ctes.append(
            f"k1s AS (SELECT driver, trip, step, x, y, r, theta, step_no, "
            f"CASE WHEN lead(v, {order - 1}) OVER w IS NOT NULL THEN ({total}) / {float(order)} END AS v "
            f"FROM k1 {W})")
        prev = "k1s"
    ctes.append(
        f"k2 AS (SELECT *, v - lag(v, 1, 0.0) OVER w AS a, "
        f"CASE WHEN r = 0 THEN CAST(0.0 AS DOUBLE) ELSE v * v / r END AS cent_acc, "
        f"{_wrap('theta - lag(theta, 1, 0.0) OVER w') if wrap else 'theta - lag(theta, 1, 0.0) OVER w'}"
        f" AS ang_vel FROM {prev} {W})")
    ctes.append(
        f"kin AS (SELECT driver, trip, step, step_no, x, y, r, theta, v, a, cent_acc, ang_vel, "
        f"ang_vel - lag(ang_vel, 1, 0.0) OVER w AS tan_acc, a - lag(a, 1, 0.0) OVER w AS jerk "
        f"FROM k2 {W})")
    return ",\n".join(ctes)


SERIES_SQL = {
    "v": "v", "a": "a",
    "a_pos": "CASE WHEN a >= 0 THEN a END", "a_neg": "CASE WHEN a < 0 THEN a END",
    "ang_vel": "ang_vel", "tan_acc": "tan_acc", "jerk": "jerk",
}

BASE_SQL = {
    "min_v": "min(v)", "max_v": "max(v)", "min_a": "min(a)", "max_a": "max(a)",
    "trip_length": "count(*)", "distance": "sum(v)",
    "mean_v": "avg(v)", "std_v": "stddev_pop(v)", "mean_a": "avg(a)", "std_a": "stddev_pop(a)",
    "mean_pos_a": f"avg({SERIES_SQL['a_pos']})", "std_pos_a": f"stddev_pop({SERIES_SQL['a_pos']})",
    "mean_neg_a": f"avg({SERIES_SQL['a_neg']})", "std_neg_a": f"stddev_pop({SERIES_SQL['a_neg']})",
    "mean_ang_vel": "avg(ang_vel)", "std_ang_vel": "stddev_pop(ang_vel)",
    "mean_tan_acc": "avg(tan_acc)", "std_tan_acc": "stddev_pop(tan_acc)",
    "mean_jerk": "avg(jerk)", "std_jerk": "stddev_pop(jerk)",
    "time_stop": f"count(CASE WHEN v < {STOP_SPEED} THEN 1 END)",
    "a_first": "max(CASE WHEN step_no = 1 THEN a END)",
    "a_second": "max(CASE WHEN step_no = 2 THEN a END)",
}
INT_FEATURES = {"trip_length", "time_stop"}


def feature_sql(name: str) -> str:
    if name in BASE_SQL:
        return BASE_SQL[name]
    s, _, p = name.rpartition("_")
    level = PERCENT_LEVELS[PERCENT_NAMES.index(p)]
    return f"quantile_cont({SERIES_SQL[s]}, CAST({level!r} AS DOUBLE))"


def features_ctes(names: list[str], smoothed: bool = False, adapter: str = "events") -> str:
    """CTEs ending in ``f`` (driver, trip, <names>), unrounded."""
    aggs = ", ".join(f"{feature_sql(n)} AS {n}" for n in names)
    return (f"{steps_cte(adapter)},\n{kin_ctes(smoothed)},\n"
            f"f AS (SELECT driver, trip, {aggs} FROM kin GROUP BY driver, trip)")


def features_query(names: list[str], smoothed: bool = False, adapter: str = "events") -> str:
    outs = ", ".join(n if n in INT_FEATURES else q(n) for n in names)
    return f"WITH {features_ctes(names, smoothed, adapter)}\nSELECT driver, trip, {outs} FROM f"


def events_ctes() -> str:
    return (
        "ev0 AS (SELECT *, CAST(sign(a) AS INTEGER) AS sign FROM kin WHERE a IS NOT NULL),\n"
        "ev1 AS (SELECT *, CASE WHEN lag(sign) OVER w IS NULL OR lag(sign) OVER w <> sign "
        f"THEN 1 ELSE 0 END AS chg FROM ev0 {W}),\n"
        "ev2 AS (SELECT *, CAST(sum(chg) OVER (PARTITION BY driver, trip ORDER BY step ROWS BETWEEN "
        "UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS event_no FROM ev1),\n"
        "events AS (SELECT driver, trip, event_no, max(sign) AS sign, count(*) AS n_steps, "
        "avg(a) AS mean_a, min(step) AS start_step, max(step) AS end_step, "
        "max(step_no) - 1 AS end_index, arg_max(v, step) AS end_speed "
        "FROM ev2 GROUP BY driver, trip, event_no)")


EVENT_COLS = ("driver, trip, event_no, sign, n_steps, " + q("mean_a") + ", start_step, end_step, "
              "end_index, " + q("end_speed"))


def speed_bands_sql() -> str:
    return (f"SELECT driver, trip, CAST(floor(v * CAST({MPS_TO_MPH} AS DOUBLE) / {BAND_MPH}) AS BIGINT) "
            f"AS band, count(*) AS n_steps, {q('avg(v)', 'mean_v')} FROM kin WHERE v IS NOT NULL "
            f"GROUP BY 1, 2, 3")


# ---- sampling ----

def fleet_ctes(k: int, target=None) -> str:
    """trips, tidx, didx, nd, pairs (target, slot, driver, trip)."""
    tfilter = f" WHERE t.driver = {target}" if target is not None else ""
    return (
        "trips AS (SELECT DISTINCT driver, trip FROM steps),\n"
        "tidx AS (SELECT driver, trip, row_number() OVER (ORDER BY driver, trip) - 1 AS gpos FROM trips),\n"
        "drv AS (SELECT driver, min(gpos) AS start, count(*) AS n_trips FROM tidx GROUP BY driver),\n"
        "didx AS (SELECT driver, start, n_trips, row_number() OVER (ORDER BY driver) - 1 AS dpos FROM drv),\n"
        "nd AS (SELECT count(*) AS d FROM didx),\n"
        f"slots AS (SELECT t.driver AS target, t.dpos AS tpos, CAST(s.slot AS BIGINT) AS slot "
        f"FROM didx t CROSS JOIN range(0, {k}) s(slot){tfilter}),\n"
        f"pk AS (SELECT target, slot, (tpos + 1 + {h(repr(str(SEED)), 'target', 'slot', repr('d'))} "
        f"% (nd.d - 1)) % nd.d AS pdpos FROM slots CROSS JOIN nd),\n"
        f"pairs AS (SELECT pk.target, pk.slot, ti.driver, ti.trip FROM pk "
        f"JOIN didx p ON p.dpos = pk.pdpos "
        f"JOIN tidx ti ON ti.gpos = p.start + {h(repr(str(SEED)), 'pk.target', 'pk.slot', repr('t'))} % p.n_trips)")


def fleet_labelled_ctes(k: int, first_foreign: int) -> str:
    return (fleet_ctes(k) + ",\n"
            "own AS (SELECT ti.driver AS target, ti.driver, ti.trip, CAST(NULL AS BIGINT) AS slot, "
            "ti.gpos - d.start + 1 AS trip_no, 1 AS label FROM tidx ti JOIN didx d USING (driver)),\n"
            f"neg AS (SELECT pr.target, pr.driver, pr.trip, pr.slot, "
            f"greatest(d.n_trips + 1, {first_foreign}) + pr.slot AS trip_no, 0 AS label "
            f"FROM pairs pr JOIN didx d ON d.driver = pr.target),\n"
            "labelled AS (SELECT * FROM own UNION ALL SELECT * FROM neg)")


def u32_threshold(fraction: float) -> int:
    return int(fraction * U32)


def fleet_entities_ctes(k: int, draws: int) -> str:
    """trips, tidx, drv, didx, nd, ents (target, driver): first k distinct partners by slot."""
    return (
        "trips AS (SELECT DISTINCT driver, trip FROM steps),\n"
        "tidx AS (SELECT driver, trip, row_number() OVER (ORDER BY driver, trip) - 1 AS gpos FROM trips),\n"
        "drv AS (SELECT driver, min(gpos) AS start, count(*) AS n_trips FROM tidx GROUP BY driver),\n"
        "didx AS (SELECT driver, start, n_trips, row_number() OVER (ORDER BY driver) - 1 AS dpos FROM drv),\n"
        "nd AS (SELECT count(*) AS d FROM didx),\n"
        f"eslots AS (SELECT t.driver AS target, t.dpos AS tpos, CAST(s.slot AS BIGINT) AS slot "
        f"FROM didx t CROSS JOIN range(0, {draws}) s(slot)),\n"
        f"epk AS (SELECT target, slot, (tpos + 1 + {h(repr(str(SEED)), 'target', 'slot', repr('e'))} "
        f"% (nd.d - 1)) % nd.d AS pdpos FROM eslots CROSS JOIN nd),\n"
        "efirst AS (SELECT epk.target, p.driver, min(epk.slot) AS slot FROM epk "
        "JOIN didx p ON p.dpos = epk.pdpos GROUP BY epk.target, p.driver),\n"
        f"ents AS (SELECT target, driver FROM (SELECT *, row_number() OVER (PARTITION BY target "
        f"ORDER BY slot) AS r FROM efirst) WHERE r <= least({k}, (SELECT d FROM nd) - 1))")


def skip_ctes(fraction: float, block: int) -> str:
    """After ``fleet_entities_ctes``: kept (target, driver, pos), the positions of a drawn driver's trips
    that geometric skips keep; a chain covers ``block`` positions."""
    scale = repr(math.log1p(-fraction))
    at = (f"CAST(floor(ln(({h(repr(str(SEED)), 'target', 'driver', 'b', '{i}', repr('g'))} + 0.5) / {float(U32)}) "
          f"/ CAST({scale} AS DOUBLE)) AS BIGINT)")
    return (
        "eb AS (SELECT e.target, e.driver, d.n_trips, unnest(range(0, (d.n_trips - 1) // "
        f"{block} + 1)) AS b FROM ents e JOIN didx d ON d.driver = e.driver),\n"
        f"chain AS (SELECT target, driver, b, least({block}, n_trips - b * {block}) AS size, 1 AS i, {at.format(i='1')} AS p FROM eb "
        f"UNION ALL SELECT target, driver, b, size, i + 1, p + 1 + {at.format(i='i + 1')} FROM chain WHERE p < size),\n"
        f"kept AS (SELECT target, driver, b * {block} + p AS pos FROM chain WHERE p < size)")
