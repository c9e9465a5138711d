"""Between the long ``steps`` form and rows of arrays.

``trip_vectors`` and ``trip_signature`` build the trip-per-row layout of JSON trips, which puts
one trip in one row.  ``trip_chunks`` and ``signature_chunks`` are the same for trips of any
length: a row holds at most ``chunk_points`` points of its trip, with the halo points beside them
that the array series (``arrays.kinematics_chunks``) look at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadprint.functions.columns import HOT_TRIP_ROWS, KEYS
from roadprint.operators.segments import number_rows

CHUNK_POINTS = 10_000


def trip_vectors(steps: DataFrame, keys=None) -> DataFrame:
    """G1: x, y and step arrays per trip, ordered by step (never by arrival)."""
    keys = keys or KEYS
    extra = [c for c in steps.columns if c == "label"]
    pts = F.array_sort(F.collect_list(F.struct("step", "x", "y")))
    agg = [pts.alias("pts")] + [F.max(c).alias(c) for c in extra]
    return (steps.groupBy(*keys).agg(*agg)
            .select(*keys,
                    F.transform("pts", lambda p: p["x"]).alias("x"),
                    F.transform("pts", lambda p: p["y"]).alias("y"),
                    F.transform("pts", lambda p: p["step"]).alias("step"),
                    *extra))


def trip_signature(steps: DataFrame, keys=None) -> DataFrame:
    """One ``signature`` struct of x, y and steps per trip, with its label."""
    keys = keys or KEYS
    vec = trip_vectors(steps, keys)
    extra = [c for c in vec.columns if c == "label"]
    return vec.select(*keys, F.struct("x", "y", F.col("step").alias("steps")).alias("signature"),
                      *extra)


def explode_trips(trips: DataFrame, keys=None) -> DataFrame:
    """Arrays back to one row per step (``pos`` is the 0-based index)."""
    keys = keys or KEYS
    extra = [c for c in trips.columns if c == "label"]
    z = F.arrays_zip(F.col("x").alias("x"), F.col("y").alias("y"), F.col("step").alias("step"))
    return (trips.select(*keys, *extra, F.posexplode(z).alias("pos", "p"))
            .select(*keys, F.col("pos").cast("bigint").alias("pos"),
                    F.col("p.step").alias("step"), F.col("p.x").alias("x"),
                    F.col("p.y").alias("y"), *extra))


def trip_chunks(steps: DataFrame, keys=None, chunk_points: int = CHUNK_POINTS, back: int = 0, ahead: int = 0,
                hot_rows: int | None = HOT_TRIP_ROWS) -> DataFrame:
    """G1 in rows of bounded size: (keys, chunk, first_pos, lead, n_core, x, y, step [, label]).

    Chunk ``c`` owns the points at positions ``c * chunk_points`` on of its trip (``first_pos``,
    0-based, ordered by step and then by the other columns).  Its arrays also hold ``lead`` <= ``back``
    points before the ``n_core`` own ones and at most ``ahead`` points after them.  Every row is copied
    at most twice, in one pass; trips above ``hot_rows`` rows are numbered without a window per trip.
    An empty table gives no chunks.
    """
    keys = keys or KEYS
    if chunk_points < max(1, back, ahead):
        raise ValueError("chunk_points must cover the halo")
    extra = [c for c in steps.columns if c == "label"]
    rows = steps.select(*keys, "step", "x", "y", *extra)
    rows = number_rows(rows, ["step", "x", "y", *extra], "_no", keys, hot_rows).withColumn("_no", F.col("_no") - 1)
    chunk = F.floor(F.col("_no") / chunk_points).cast("bigint")
    pos = F.col("_no") % chunk_points
    copy = lambda c, core: F.struct(c.alias("chunk"), F.lit(core).alias("core"))
    copies = F.array(copy(chunk, True), F.when(pos >= chunk_points - back, copy(chunk + 1, False)),
                     F.when((pos < ahead) & (chunk > 0), copy(chunk - 1, False)))
    rows = (rows.withColumn("_c", F.explode(F.filter(copies, lambda c: c.isNotNull())))
            .select(*keys, "_no", "step", "x", "y", *extra, "_c.*"))
    pts = F.sort_array(F.collect_list(F.struct("_no", "step", "x", "y")))
    # A plain field of ``pts`` would be read anew for every element of the series built on it.
    part = lambda name: F.transform("pts", lambda p: p[name]).alias(name)
    first = F.min(F.when(F.col("core"), F.col("_no")))
    grouped = rows.groupBy(*keys, "chunk").agg(
        pts.alias("pts"), first.alias("first_pos"), (first - F.min("_no")).cast("int").alias("lead"),
        F.count_if("core").cast("int").alias("n_core"), *[F.max(c).alias(c) for c in extra])
    # The last points of a trip are copied into a chunk after it that owns none.
    return grouped.where("n_core > 0").select(
        *keys, "chunk", "first_pos", "lead", "n_core",
        *[part(c) for c in ("x", "y", "step")], *extra)


def own_points(chunks: DataFrame, columns: list[str]) -> DataFrame:
    """Chunks whose array ``columns`` hold their own points only (shorter arrays stay shorter)."""
    return chunks.withColumns({c: F.slice(c, F.col("lead") + 1, F.col("n_core")) for c in columns}).drop("lead")


def signature_chunks(steps: DataFrame, keys=None, chunk_points: int = CHUNK_POINTS,
                     hot_rows: int | None = HOT_TRIP_ROWS) -> DataFrame:
    """G2 in rows of bounded size: a ``signature`` struct of x, y and steps per chunk, with the label."""
    keys = keys or KEYS
    vec = trip_chunks(steps, keys, chunk_points, hot_rows=hot_rows)
    extra = [c for c in vec.columns if c == "label"]
    return vec.select(*keys, "chunk", "first_pos", F.struct("x", "y", F.col("step").alias("steps")).alias("signature"),
                      *extra)


def explode_chunks(chunks: DataFrame, keys=None) -> DataFrame:
    """G3 of chunks without halos: one row per step, ``pos`` being the 0-based index in the trip."""
    keys = keys or KEYS
    rows = explode_trips(chunks, [*keys, "first_pos"])
    return rows.withColumn("pos", F.col("first_pos") + F.col("pos")).drop("first_pos")
