"""Hot trips: kinematics, trip features and events for trips too large for one task.

A trip window sends every row of a trip to one task.  Trips whose row count
exceeds ``hot_rows`` are split off (a size check on a ``groupBy`` count with
partial aggregation) and processed in row segments instead:

1. ``step_no``: rows are sorted by key and step over ranges between sampled splitters and numbered
   there; a trip that goes on in a later range adds its rows in the earlier ones.  Steps may be sparse or
   tied: ranges follow the rows, not the step values, and ties are ordered by the other columns.
2. Row segments of ``segment_rows`` rows by ``step_no``; each segment also
   receives the 3 rows before it and the ``order - 1`` rows after it (halo
   copies), so lags and leads inside the segment window see exactly the rows
   the trip window would.  Only the core rows are kept.
3. Trip aggregates are partial-aggregation friendly (min, max, sum, avg,
   stddev, counts); for exact percentiles rows are sorted by trip over ranges between sampled
   splitters, and a trip that begins and ends in a range is finished there.  Those of a trip over several
   ranges come from a table of distinct values with cumulative counts (equal values are one row)
   and equi-joins on the two ranks each percentile interpolates between.  No task ever holds
   more of a hot trip than its range.

The results equal the one-window path (checked against the same oracle SQL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadprint.functions.columns import (HOT_TRIP_ROWS, KEYS, MA_ORDER, PERCENT_LEVELS, PERCENT_NAMES,
                                         cumulative_counts_largest, find_ranks, key_changes, run_numbers, spread, task_count)

SEGMENT_ROWS = 500_000
BROADCAST_HOT_KEYS = 100_000


def hot_trip_keys(steps: DataFrame, hot_rows: int, keys=None) -> DataFrame:
    """Keys of trips with more than ``hot_rows`` rows (at most total_rows / hot_rows of them)."""
    return _hot_trips(steps, hot_rows, keys or KEYS).drop("_n")


def _hot_trips(steps: DataFrame, hot_rows: int, keys) -> DataFrame:
    return steps.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)


def split_hot(steps: DataFrame, hot_rows: int, keys=None):
    """(normal steps, hot steps or None when no trip is hot, number of all steps).

    A table of no more than ``hot_rows`` rows has no hot trip.  Else one count job sizes the hot
    key table (at most total_rows / hot_rows keys); it is broadcast only below a checked size.  Where there are
    more keys and most rows are theirs, all trips go as hot ones, which hold for trips of any size: telling the
    others apart would shuffle all rows twice.
    """
    keys = keys or KEYS
    rows = steps.count()
    if rows <= hot_rows:
        return steps, None, rows
    found = _hot_trips(steps, hot_rows, keys)
    n_hot, n_rows = found.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if n_hot == 0:
        return steps, None, rows
    if n_hot > BROADCAST_HOT_KEYS and 2 * n_rows > rows:
        return steps.limit(0), steps, rows
    hot = hot_trip_keys(steps, hot_rows, keys)
    if n_hot <= BROADCAST_HOT_KEYS:
        hot = F.broadcast(hot)
    return steps.join(hot, keys, "left_anti"), steps.join(hot, keys, "left_semi"), rows


def _tasks(df: DataFrame, rows: int | None) -> int:
    """Ranges to sort ``rows`` rows (an upper bound, or not known) in."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), task_count(rows or 0))


def dense_numbers(rows: DataFrame, order: list[str], keys=None, out: str = "step_no", n: int | None = None) -> DataFrame:
    """1-based number ``out`` of every row of its trip in the order given, without a per-trip window.

    ``n``: the number of rows, or more; a large table is sorted in more tasks.
    """
    return run_numbers(rows, keys or KEYS, order, out, _tasks(rows, n))


def number_steps(hot: DataFrame, keys=None, n: int | None = None) -> DataFrame:
    """1-based ``step_no`` of every row of hot trips; tied steps in the order of the other columns."""
    keys = keys or KEYS
    return dense_numbers(hot, ["step", *[c for c in hot.columns if c not in {*keys, "step"}]], keys, n=n)


def number_rows(rows: DataFrame, order: list[str], out: str = "step", keys=None,
                hot_rows: int | None = HOT_TRIP_ROWS) -> DataFrame:
    """1-based number ``out`` of every row of its trip: one window, but for hot trips."""
    keys = keys or KEYS
    normal, hot, n = (rows, None, 0) if hot_rows is None else split_hot(rows, hot_rows, keys)
    numbered = (spread(normal, n, *keys) if hot is None else normal).withColumn(out, F.row_number().over(
        Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    return numbered if hot is None else numbered.unionByName(dense_numbers(hot, order, keys, out, n))


def with_halos(df: DataFrame, segment_rows: int, back: int, ahead: int) -> DataFrame:
    """Row segments ``_seg`` with ``back`` rows before and ``ahead`` rows after each one."""
    s0 = F.col("step_no") - 1
    seg = F.floor(s0 / segment_rows).cast("bigint")
    pos = s0 - seg * segment_rows
    core = df.withColumn("_seg", seg).withColumn("_core", F.lit(True))
    parts = [core]
    if back:
        parts.append(df.where(pos >= segment_rows - back)
                       .withColumn("_seg", seg + 1).withColumn("_core", F.lit(False)))
    if ahead:
        parts.append(df.where((pos < ahead) & (seg > 0))
                       .withColumn("_seg", seg - 1).withColumn("_core", F.lit(False)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def segmented_kinematics(hot: DataFrame, smoothed: bool = False, order: int = MA_ORDER,
                         wrap: bool = False, keys=None, segment_rows: int = SEGMENT_ROWS,
                         internal: bool = False, n: int | None = None) -> DataFrame:
    """Kinematics of hot trips; ``internal`` keeps ``_seg`` and ``_a_prev`` for events; ``n``: as in ``dense_numbers``."""
    from roadprint.operators.kinematics import kinematics_frame
    keys = keys or KEYS
    ahead = order - 1 if smoothed else 0
    if segment_rows < max(3, ahead):
        raise ValueError("segment_rows must cover the halo")
    extra = [c for c in hot.columns if c not in set(keys) | {"step", "x", "y"}]
    df = spread(with_halos(number_steps(hot, keys, n), segment_rows, 3, ahead), n or 0, *keys, "_seg")
    w = Window.partitionBy(*keys, "_seg").orderBy("step_no")
    kin = kinematics_frame(df, w, smoothed, order, wrap, keys, extra + ["_core", "_seg"],
                           with_prev=internal)
    kin = kin.where(F.col("_core")).drop("_core")
    return kin if internal else kin.drop("_seg")


def segmented_accel_events(hot: DataFrame, smoothed: bool = False, keys=None,
                           segment_rows: int = SEGMENT_ROWS, n: int | None = None) -> DataFrame:
    """V1/V2 for hot trips: the running event number is a segment-local running sum of
    change flags plus the flags of all earlier segments (a window over the small
    per-segment table)."""
    from roadprint.operators.events import summarise_events
    keys = keys or KEYS
    k = segmented_kinematics(hot, smoothed, keys=keys, segment_rows=segment_rows, internal=True, n=n)
    k = (k.where(F.col("a").isNotNull())
          .withColumn("sign", F.signum("a").cast("int"))
          .withColumn("_chg", F.when((F.col("step_no") == 1)
                                     | (F.col("sign") != F.signum("_a_prev").cast("int")), 1)
                      .otherwise(0)))
    local = F.sum("_chg").over(Window.partitionBy(*keys, "_seg").orderBy("step_no")
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    tot = k.groupBy(*keys, "_seg").agg(F.sum("_chg").alias("_c"))
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*keys, "_seg", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    k = (k.withColumn("_local", local).join(off, keys + ["_seg"])
          .withColumn("event_no", (F.col("_off") + F.col("_local")).cast("bigint")))
    return summarise_events(k, keys)


def over_trips(steps: DataFrame, series, back: int, ahead: int, keys=None, hot_rows: int | None = HOT_TRIP_ROWS,
               segment_rows: int | None = None) -> DataFrame:
    """``series(steps, window)`` over every trip, where it looks ``back`` rows back and ``ahead`` rows on at most.

    A hot trip's windows are its row segments with halos.  A lag's default at the trip's first row holds
    there too: the first segment has no rows before it.
    """
    keys = keys or KEYS
    window = lambda *more: Window.partitionBy(*keys, *more)
    normal, hot, n = (steps, None, 0) if hot_rows is None else split_hot(steps, hot_rows, keys)
    out = series(normal, window().orderBy("step"))
    if hot is None:
        return out
    rows = with_halos(number_steps(hot, keys, n), max(segment_rows or SEGMENT_ROWS, back, ahead), back, ahead)
    rows = spread(rows, n, *keys, "_seg")
    return out.unionByName(series(rows, window("_seg").orderBy("step_no")).where("_core").select(out.columns))


def split_kinematics(steps: DataFrame, smoothed: bool, order: int, wrap: bool, keys,
                     hot_rows: int, segment_rows: int | None, with_prev: bool = False) -> DataFrame:
    from roadprint.operators.kinematics import kinematics
    normal, hot, n = split_hot(steps, hot_rows, keys)
    out = kinematics(normal, smoothed, order, wrap, keys, hot_rows=None, with_prev=with_prev)
    if hot is None:
        return out
    split = segmented_kinematics(hot, smoothed, order, wrap, keys, segment_rows or SEGMENT_ROWS, internal=with_prev,
                                 n=n)
    return out.unionByName(split.drop("_seg"))


def _finished_runs(keys: list[str], values: list[str], wanted: list[str], levels: list[float]):
    """For ``mapInArrow`` on partitions sorted by ``keys``: a row with ``_pct``, the percentiles of the ``wanted`` series, for
    each trip that begins and ends in the partition; the rows of its first and last trip, which may go on in others, as
    they are, in ``_row``."""
    changes = key_changes()

    def finish(batches):
        import numpy as np
        import pyarrow as pa
        share, first, held = np.array(levels), True, []  # held: the rows of the last trip so far

        def lists(flat, valid, width):
            offsets = pa.array(np.arange(0, flat.size + 1, width), pa.int32())
            return pa.ListArray.from_arrays(offsets, pa.array(flat, mask=~valid))

        def numbers(rows, c):
            col = rows[c].combine_chunks()
            col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
            return col.fill_null(0.0).to_numpy(zero_copy_only=False), col.is_valid().to_numpy(zero_copy_only=False)

        def out(rows, pct, row):
            none = pa.nulls(len(rows), pa.list_(pa.float64()))
            arrays = [*(rows[k].combine_chunks() for k in keys), none if pct is None else pct, none if row is None else row]
            return pa.Table.from_arrays(arrays, [*keys, "_pct", "_row"]).to_batches()

        def as_they_are(rows):
            got = [numbers(rows, c) for c in values]
            flat, valid = (np.column_stack(x).ravel() for x in zip(*got, strict=True))
            return out(rows, None, lists(flat, valid, len(values)))

        def percentiles(rows, starts):
            trip = np.zeros(len(rows), np.int64)
            trip[starts[1:]] = 1
            trip, m = np.cumsum(trip), len(starts)
            pct, there = np.zeros((m, len(wanted), len(share))), np.zeros((m, len(wanted), len(share)), bool)
            for i, s in enumerate(wanted):
                val, valid = numbers(rows, s.removesuffix("_pos").removesuffix("_neg"))
                if s.endswith(("_pos", "_neg")):  # NaN is above all numbers
                    valid = valid & ((val < 0) == s.endswith("_neg"))
                val, of = val[valid], trip[valid]
                val = val[np.lexsort((val, of))]
                n = np.bincount(of, minlength=m)
                some = n > 0
                start, pos = (np.cumsum(n) - n)[some, None], (n[some, None] - 1).astype(float) * share
                lo, hi = np.floor(pos), np.ceil(pos)
                low, high = val[start + lo.astype(np.int64)], val[start + hi.astype(np.int64)]
                pct[some, i] = np.where((hi == lo) | (low == high), low, (hi - pos) * low + (pos - lo) * high)
                there[some, i] = True
            return out(rows.take(pa.array(starts)), lists(pct.ravel(), there.ravel(), len(wanted) * len(share)), None)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if not len(rows):
                continue
            before = pa.concat_tables([held[-1].slice(len(held[-1]) - 1) if held else rows.slice(0, 1), rows.slice(0, len(rows) - 1)])
            new = np.zeros(len(rows), bool)
            for k in keys:
                new |= changes(before[k].combine_chunks(), rows[k].combine_chunks())
            at = np.flatnonzero(new)
            if not len(at):
                held.append(rows)
                continue
            if first:
                for part in (*held, rows.slice(0, at[0])):
                    yield from as_they_are(part)
                done = rows.slice(at[0], at[-1] - at[0])
                starts, first = at[:-1] - at[0], False
            else:
                done = pa.concat_tables([*held, rows.slice(0, at[-1])])
                starts = np.r_[0, at[:-1] + sum(map(len, held))]
            held = [rows.slice(at[-1])]
            if len(done):
                yield from percentiles(done, starts)
        for part in held:
            yield from as_they_are(part)
    return finish


def ranked_percentiles(kin: DataFrame, names: list[str], keys=None, n: int | None = None) -> DataFrame:
    """Exact percentiles (as Spark's ``percentile``) of trips of any size.

    Rows are sorted by trip over ranges, each as large as a task may hold; trips that begin and end in a range are
    finished there.  The first and the last trip of a range may go on in others: the values of these are ranked over
    all tasks.  So every row is shuffled once, and only those of trips over ranges again.
    ``names`` are percentile feature names (``<series>_pNN``); ``n``: as in ``dense_numbers``.  Returns one row
    per trip with those columns.
    """
    from roadprint.session import materialize
    keys = keys or KEYS
    wanted = sorted({n.rpartition("_")[0] for n in names})
    values = sorted({s.removesuffix("_pos").removesuffix("_neg") for s in wanted})
    rows = kin.select(*keys, *[F.col(c).cast("double").alias(c) for c in values],
                      *(["step_no"] if "step_no" in kin.columns else []))
    order = ["step_no"] if "step_no" in kin.columns else values  # ranges may divide a trip
    pairs = T.ArrayType(T.DoubleType())
    schema = T.StructType([*rows.select(*keys).schema.fields, T.StructField("_pct", pairs), T.StructField("_row", pairs)])
    done = materialize(rows.repartitionByRange(_tasks(kin, n), *keys, *order).sortWithinPartitions(*keys).drop("step_no")
                       .mapInArrow(_finished_runs(keys, values, wanted, PERCENT_LEVELS), schema), "trip-percentiles")
    at = {f"{s}_{p}": i * len(PERCENT_NAMES) + j for i, s in enumerate(wanted) for j, p in enumerate(PERCENT_NAMES)}
    finished = done.where("_pct is not null").select(*keys, *[F.get("_pct", F.lit(at[c])).alias(c) for c in names])
    open_ = done.where("_row is not null").select(*keys, *[F.get("_row", F.lit(j)).alias(c) for j, c in enumerate(values)])
    return finished.unionByName(_ranked_over_tasks(open_, names, wanted, keys))


def _ranked_over_tasks(kin: DataFrame, names: list[str], wanted: list[str], keys) -> DataFrame:
    """``ranked_percentiles`` from a distributed rank of the values: nothing of a trip is held by one task."""
    from roadprint.operators.features import series
    ser = series()
    pairs = F.array(*[F.struct(F.lit(s).alias("s"), ser[s].alias("val")) for s in wanted])
    long = (kin.select(*keys, F.explode(pairs).alias("e"))
               .select(*keys, F.col("e.s").alias("s"), F.col("e.val").alias("val"))
               .where(F.col("val").isNotNull()))
    counted, _, largest = cumulative_counts_largest(long.groupBy(*keys, "s", "val").agg(F.count(F.lit(1)).alias("_times")),
                                                    [*keys, "s", "val"], "_times", "_before")
    stats = counted.groupBy(*keys, "s").agg(F.min("_before").alias("_start"), F.sum("_times").alias("_n"))
    levels = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(n).alias("pn"))
                       for p, n in zip(PERCENT_LEVELS, PERCENT_NAMES)])
    lv = (stats.select(*keys, "s", "_start", "_n", F.explode(levels).alias("l"))
               .withColumn("_pos", (F.col("_n") - 1).cast("double") * F.col("l.p"))
               .withColumn("_lo", F.floor("_pos").cast("bigint"))
               .withColumn("_hi", F.ceil("_pos").cast("bigint"))
               .withColumn("_end", F.explode(F.array(F.struct(F.lit(False).alias("upper"), F.col("_lo").alias("r")),
                                                     F.struct(F.lit(True).alias("upper"), F.col("_hi").alias("r")))))
               .select(*keys, "s", F.col("l.pn").alias("pn"), "_pos", F.col("_end.upper").alias("_upper"),
                       (F.col("_start") + F.col("_end.r")).alias("_rank")))
    end = lambda upper: F.max(F.when(F.col("_upper") == upper, F.col("val")))
    j = (find_ranks(counted.select("val", "_before", "_times"), lv, "_rank", "_before", "_times", largest)
         .groupBy(*keys, "s", "pn", "_pos")
         .agg(end(False).alias("_vlo"), end(True).alias("_vhi")))
    pos, l_, h_ = F.col("_pos"), F.floor("_pos").cast("bigint"), F.ceil("_pos").cast("bigint")
    value = (F.when((h_ == l_) | (F.col("_vlo") == F.col("_vhi")), F.col("_vlo"))
              .otherwise((h_ - pos) * F.col("_vlo") + (pos - l_) * F.col("_vhi")))
    j = j.select(*keys, F.concat(F.col("s"), F.lit("_"), F.col("pn")).alias("_name"),
                 value.alias("_v"))
    return j.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == n, F.col("_v"))).alias(n)
                                  for n in names])
