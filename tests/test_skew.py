"""Hot trips, ties and sparse steps: nothing of a trip in one task, and the results of the plain form."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from roadprint.functions import columns
from roadprint.operators import assembly, features, kinematics, segments
from roadprint.sources import testdata

STEPS = "driver long, trip string, step double, x double, y double"


def windows(df):
    """(partition columns, order columns) of the windows of the executed plan."""
    df.write.format("noop").mode("overwrite").save()
    return re.findall(r"\bWindow \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def tied_values(spark, n=20_000):
    """Four of five values are equal, in one (driver, trip)."""
    value = F.when(F.col("id") % 5 != 0, F.lit(7.5)).otherwise((F.xxhash64("id") % 1000).cast("double"))
    return spark.range(n).select(F.lit(1).cast("bigint").alias("driver"), F.lit("t").alias("trip"), value.alias("val"))


def test_ties_do_not_gather_in_a_partition(spark):
    counted = tied_values(spark).groupBy("driver", "trip", "val").agg(F.count(F.lit(1)).alias("n"))
    ranged = columns._ranged(counted, ["driver", "trip", "val"], "test-ranged", 8)
    sizes = [r["count"] for r in ranged.groupBy("_pid").count().collect()]
    assert sum(sizes) > 1000 and max(sizes) <= 2 * sum(sizes) / 8


@pytest.mark.parametrize("chunk", [1, 7, 65_536])
def test_cumulative_counts_and_ranks(spark, monkeypatch, chunk):
    monkeypatch.setattr(columns, "CHUNK_ROWS", chunk)
    rng = random.Random(chunk)
    counts = [(v, rng.choice([1, 1, 2, 3, 70, 1500, 40_000])) for v in rng.sample(range(10_000), 300)]
    df = spark.createDataFrame(counts, "v long, n long")
    got, total = columns.cumulative_counts(df, ["v"], "n", "before", 6)
    before, want = 0, {}
    for v, n in sorted(counts):
        want[v], before = before, before + n
    assert total == before and {r.v: r.before for r in got.collect()} == want
    ranks = sorted({0, total - 1, *(rng.randrange(total) for _ in range(400))})
    asked = spark.createDataFrame([(r,) for r in ranks], "r long")
    found = {r.r: r.v for r in columns.find_ranks(got, asked, "r", "before", "n", total).collect()}
    ends = np.cumsum([n for _, n in sorted(counts)])
    assert found == {r: sorted(counts)[int(np.searchsorted(ends, r, side="right"))][0] for r in ranks}


def test_percentiles_of_tied_values_are_exact(spark):
    kin = tied_values(spark, 3000).withColumn("v", F.col("val")).withColumn("a", F.col("val") - 7.5)
    for c in ("ang_vel", "tan_acc", "jerk"):
        kin = kin.withColumn(c, F.when(F.col("val") != 7.5, F.col("val")))
    names = [f"{s}_{p}" for s in ("v", "a", "jerk") for p in columns.PERCENT_NAMES]
    got = segments.ranked_percentiles(kin, names).first()
    for s in ("v", "a", "jerk"):
        want = kin.select(F.percentile(s, F.array(*map(F.lit, columns.PERCENT_LEVELS)))).first()[0]
        assert [got[f"{s}_{p}"] for p in columns.PERCENT_NAMES] == want


def test_numbering_of_hot_trips_has_no_trip_window(spark):
    rows = [(1, "hot", i * 1000.5, i) for i in range(400)] + [(2, f"t{i % 9}", float(i), i) for i in range(60)]
    rows += [(None, "hot", float(i), i) for i in range(70)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "driver long, trip string, at double, payload long").repartition(5)
    plain = segments.number_rows(df, ["at", "payload"], hot_rows=None)
    split = segments.number_rows(df, ["at", "payload"], hot_rows=50)
    assert rows_of(split) == rows_of(plain)
    hot = segments.dense_numbers(df.where("trip = 'hot'"), ["at", "payload"])
    assert all("driver" not in part for part, _ in windows(hot))


def test_sparse_and_tied_steps_in_segments(spark):
    """Steps far apart, and steps that repeat, are cut into segments of rows all the same."""
    sparse = [(1, "s", i * 1e6, float(i % 17), float(i % 5)) for i in range(300)]
    df = spark.createDataFrame(sparse, STEPS)
    seg = segments.segmented_kinematics(df, segment_rows=40)
    assert rows_of(seg) == rows_of(kinematics.kinematics(df, hot_rows=None).select(seg.columns))
    assert all("_seg" in part or "driver" not in part for part, _ in windows(seg))
    tied = spark.createDataFrame([(1, "s", float(i // 4), float(i % 17), float(i % 5)) for i in range(300)], STEPS)
    numbers = [r.step_no for r in segments.number_steps(tied.repartition(7)).orderBy("step", "x", "y").collect()]
    assert numbers == list(range(1, 301))
    a, b = (rows_of(segments.segmented_kinematics(tied.repartition(n), segment_rows=40)) for n in (2, 9))
    assert a == b


@pytest.mark.parametrize("series", [
    lambda df, **how: kinematics.lag_zero(df, **how),
    lambda df, **how: kinematics.speed(df, **how),
    lambda df, **how: kinematics.moving_average(df, "x", **how),
    lambda df, **how: kinematics.moving_average(df, "y", order=3, out="y", **how)])
def test_series_of_hot_trips_equal_the_trip_window(spark, series):
    rng = random.Random(4)
    rows = [(1, "hot", i * 3.0, rng.random(), rng.random()) for i in range(230)]
    rows += [(2, f"t{i % 7}", float(i), rng.random(), rng.random()) for i in range(50)]
    df = spark.createDataFrame(rows, STEPS)
    got = series(df, hot_rows=20, segment_rows=25)
    assert rows_of(got) == rows_of(series(df, hot_rows=None))
    lone = windows(series(df.where("trip = 'hot'"), hot_rows=20, segment_rows=25))
    assert sum("_seg" in part for part, _ in lone) >= 1


def test_split_adapter_equals_the_plain_one(spark):
    a, b = (testdata.lineitem_steps(spark, SF_SMALL, hot_rows=n) for n in (None, 50))
    assert rows_of(a) == rows_of(b)


def test_split_features_with_ties(spark):
    """Half of the points stand still: most speeds are zero, in a hot trip."""
    rows = [(1, "hot", float(i), float(i if i % 10 == 0 else 0), 0.0) for i in range(400)]
    df = spark.createDataFrame(rows, STEPS)
    a = features.features_for_version(df, 4, hot_rows=None).collect()[0]
    b = features.features_for_version(df, 4, hot_rows=50, segment_rows=40).collect()[0]
    assert a.asDict().keys() == b.asDict().keys()
    assert all(x == y or abs(x - y) < 1e-9 for x, y in zip(a, b) if x is not None and not isinstance(x, str))


def test_chunks_hold_a_bounded_number_of_points(spark):
    point = lambda i: (1, "hot", float(i * i % 97), float(i % 7), i) if i % 11 else (2, None, None, 1.0, i)
    st = spark.createDataFrame([point(i) for i in range(1, 2000)],
                               "driver long, trip string, x double, y double, step long")
    back, ahead, size = 3, 9, 50
    chunks = assembly.trip_chunks(st, chunk_points=size, back=back, ahead=ahead, hot_rows=500)
    rows = chunks.collect()
    assert max(len(r["x"]) for r in rows) == back + size + ahead
    assert all(len(r["x"]) == len(r["y"]) == len(r["step"]) and r["lead"] == (back if r["chunk"] else 0) for r in rows)
    assert sum(r["n_core"] for r in rows) == 1999
    assert {r["first_pos"] for r in rows} == {r["chunk"] * size for r in rows}
    plain = assembly.explode_trips(assembly.trip_vectors(st))
    own = assembly.own_points(chunks, ["x", "y", "step"])
    assert rows_of(assembly.explode_chunks(own).select(plain.columns)) == rows_of(plain)


def test_chunks_of_an_empty_table_and_small_chunks(spark):
    st = spark.createDataFrame([], "driver long, trip string, step long, x double, y double, label double")
    assert assembly.trip_chunks(st).collect() == [] and assembly.signature_chunks(st).collect() == []
    assert "label" in assembly.trip_chunks(st).columns
    with pytest.raises(ValueError):
        assembly.trip_chunks(st, chunk_points=5, ahead=9)


def test_ranks_are_looked_up_only_where_rows_lie_and_never_broadcast(spark):
    """Counts of one put all rows in the finest buckets, however long the table; a large count opens coarser ones."""
    rows = spark.range(5000).select(F.col("id").alias("v"), F.lit(1).cast("bigint").alias("n"))
    counted, total, largest = columns.cumulative_counts_largest(rows, ["v"], "n", "before", 3)
    assert (total, largest) == (5000, 1)
    asked = spark.range(0, 5000, 7).select(F.col("id").alias("r"))
    found = columns.find_ranks(counted, asked, "r", "before", "n", largest)
    found.write.format("noop").mode("overwrite").save()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[_(level|bucket)", plan) and not re.search(r"Broadcast\w*Join \[_(level|bucket)", plan)
    assert {r.r: r.v for r in found.collect()} == {i: i for i in range(0, 5000, 7)}
    assert columns.cumulative_counts_largest(rows.withColumn("n", F.col("v")), ["v"], "n")[2] == 4999


def test_run_numbers_over_many_ranges(spark):
    """Keys that go on over several ranges, end in one, or are null: the numbers of a window by key."""
    rows = [(k, t, i) for k, t, n in ((None, "a", 90), (1, None, 5), (1, "a", 700), (1, "b", 1), (2, "a", 300), (3, "a", 40))
            for i in range(n)]
    rows += [(k, "c", i) for k in range(4, 60) for i in range(k % 5 + 1)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "driver long, trip string, at long").repartition(5)
    plain = df.withColumn("no", F.row_number().over(Window.partitionBy("driver", "trip").orderBy("at")).cast("bigint"))
    for n in (1, 4, 23):
        got = columns.run_numbers(df, ["driver", "trip"], ["at"], "no", n)
        assert got.columns == plain.columns and rows_of(got) == rows_of(plain)
        assert all("driver" not in part for part, _ in windows(got))


def test_many_hot_keys_are_not_joined(spark, monkeypatch):
    """More hot trips than are broadcast, with most of the rows: rows are numbered and cut without a join by key."""
    monkeypatch.setattr(segments, "BROADCAST_HOT_KEYS", 3)
    rows = [(d, "t", float(i), float(i % 7), float(i % 5)) for d in range(8) for i in range(30 + d)]
    rows += [(d, "u", float(i), 1.0, float(i)) for d in range(8) for i in range(4)]
    df = spark.createDataFrame(rows, STEPS).repartition(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for got, want in ((segments.number_rows(df, ["step"], "no", hot_rows=20), segments.number_rows(df, ["step"], "no", hot_rows=None)),
                          (kinematics.speed(df, hot_rows=20, segment_rows=10), kinematics.speed(df, hot_rows=None))):
            assert rows_of(got) == rows_of(want)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "LeftAnti" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_tables_are_dealt_to_tasks_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(columns, "TASK_ROWS", 20)
    df = spark.createDataFrame([(d, "t", float(i), 1.0, 2.0) for d in range(8) for i in range(40)], STEPS)
    got = kinematics.speed(df, hot_rows=30, segment_rows=10)
    assert rows_of(got) == rows_of(kinematics.speed(df, hot_rows=None))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(driver#\d+L, trip#\d+, _seg#\d+L, 16\), REPARTITION_BY_NUM", plan)


@pytest.mark.parametrize("smoothed", [False, True])
def test_wanted_series_alone_are_computed(spark, smoothed):
    """Series that are not asked for cost nothing; the others are as with all of them."""
    from roadprint.operators import arrays
    rng = random.Random(6)
    df = spark.createDataFrame([(1, f"t{i % 3}", float(i), rng.random(), rng.random()) for i in range(130)], STEPS)
    karr = arrays.kinematics_chunks(df, smoothed, chunk_points=16, hot_rows=20)
    got = arrays.explode_kinematics(karr, series=["v", "jerk"])
    assert rows_of(got) == rows_of(arrays.explode_kinematics(karr).select(got.columns))
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "sqrt" in plan and "atan2" not in plan


def test_only_trips_over_ranges_are_ranked_over_tasks(spark, monkeypatch):
    """Every value of every trip was a row of its own, counted, sorted, written and looked up over all tasks."""
    rng = random.Random(5)
    rows = [(d, f"t{t}" if t else None, float(s), round(rng.random() * 20, 1), float(rng.randrange(4)))
            for d in range(30) for t in range(3) for s in range(rng.choice([1, 3, 30, 60]))]
    rows += [(99, "long", float(s), float(s % 7), 0.0) for s in range(4000)]  # over several ranges
    st = spark.createDataFrame(rows, STEPS)
    ranked, real = [], segments._ranked_over_tasks

    def over_tasks(kin, *args):
        ranked.extend((r.driver, r.trip) for r in kin.select("driver", "trip").distinct().collect())
        return real(kin, *args)
    monkeypatch.setattr(segments, "_ranked_over_tasks", over_tasks)
    for version in (2, 4):
        ranked.clear()
        want = {(r.driver, r.trip): r for r in features.features_for_version(st, version, hot_rows=None).collect()}
        got = {(r.driver, r.trip): r for r in features.features_for_version(st, version, hot_rows=20, segment_rows=12).collect()}
        assert want.keys() == got.keys() and (99, "long") in ranked and len(ranked) <= 2 * 8
        for key, row in want.items():
            if key[1] is not None:  # trips without a name are not joined to their percentiles
                assert all(x == y or (x is not None and not isinstance(x, str) and abs(x - y) < 1e-9) for x, y in zip(row, got[key])), key


def test_percentiles_of_finished_trips_are_those_of_spark(spark):
    """Undefined values are left out, NaN is above all others; a series without values has none."""
    odd = [None, float("nan"), -0.0, 0.0, 1.5, -2.0, -2.0, 7.0]
    rng = random.Random(6)
    rows = [(d, "t", s + 1, *(rng.choice(odd if d % 4 else [None]) for _ in range(5))) for d in range(200) for s in range(rng.randrange(1, 12))]
    kin = spark.createDataFrame(rows, "driver long, trip string, step_no long, v double, a double, ang_vel double, tan_acc double, jerk double")
    names = features.PCT7
    got = {r.driver: r for r in segments.ranked_percentiles(kin, names).collect()}
    want = {r.driver: r for r in features.trip_features(kin, names).collect()}
    text = lambda r: [None if x is None else f"{x + 0.0:.9g}" for x in r[2:]]
    assert all(d in got and text(got[d]) == text(r) for d, r in want.items() if any(x is not None for x in r[2:]))
