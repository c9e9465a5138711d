"""Regression guards on physical plans (the properties PLANS.md describes)."""

import re

from conftest import SF_SMALL
from roadprint.operators import features, kinematics, sampling, segments
from roadprint.sources import testdata


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_from_scan_to_trip_features(spark):
    st = testdata.lineitem_steps(spark, SF_SMALL)
    for v in (1, 4):
        plan = executed(features.features_for_version(st, v, hot_rows=None))
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_hot_trip_windows_partition_by_segment(spark):
    rows = [(1, "hot", i + 1, float(i % 7), float(i % 5)) for i in range(300)]
    st = spark.createDataFrame(rows, "driver long, trip string, step long, x double, y double")
    plan = executed(segments.segmented_kinematics(st, smoothed=True, segment_rows=40))
    windows = re.findall(r"\bWindow \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", plan)
    assert windows
    for part, order in windows:
        # row windows run per segment; the only per-trip window orders the small
        # per-segment count table (offsets), never the rows of the trip
        assert "_seg" in part or "_vseg" in part or "_vseg" in order, (part, order)


def test_fleet_sampling_has_no_cartesian_product(spark):
    st = testdata.events_steps(spark, SF_SMALL)
    idx = sampling.fleet_index(st)
    for df in (sampling.fleet_labelled_trips(idx), sampling.fleet_sampled_trips(idx, k=5)):
        plan = executed(df)
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_kinematics_is_one_window_operator(spark):
    st = testdata.events_steps(spark, SF_SMALL)
    plan = executed(kinematics.kinematics(st, smoothed=True, hot_rows=None))
    # the adapter numbers steps in one window; the kinematics need exactly one more
    assert len(re.findall(r"\bWindow \[", plan)) == 2, plan


def test_draws_of_a_fleet_are_never_broadcast(spark):
    """An exploded table counts for the planner as long as the one it came from."""
    rows = [(d, f"t{t}") for d in range(300) for t in range(2)]
    idx = sampling.fleet_index(spark.createDataFrame(rows, "driver long, trip string"))
    plan = executed(sampling.sample_pairs(idx, k=200))
    assert "BroadcastExchange" in executed(idx.trips) and "Generate explode" in plan
    for name in re.findall(r"(?:Broadcast\w*Join) \[[^\]]*\]", plan):
        assert "pdpos" not in name and "gpos" not in name, plan
    assert len(re.findall(r"SortMergeJoin \[(?:pdpos|gpos)#", plan.split("== Initial Plan ==")[0])) == 2, plan


def test_no_set_built_from_draws_broadcasts_them(spark):
    """Splits, folds, halves and relabelled steps join the draws by merge as well."""
    rows = [(d, f"t{t}", s, float(s), 0.0) for d in range(300) for t in range(2) for s in range(1, 3)]
    st = spark.createDataFrame(rows, "driver long, trip string, step long, x double, y double")
    idx = sampling.fleet_index(st)
    labelled = sampling.fleet_labelled_trips(idx)
    by_row = ("target", "driver", "trip", "slot")
    sets = {"split": sampling.split_train_test(labelled, cols=by_row), "folds": sampling.kfold(labelled, cols=by_row),
            "steps": sampling.fleet_labelled_steps(st, idx=idx),
            "relabelled": sampling.relabel_steps(st, sampling.relabel_glossary(sampling.sample_pairs(idx)))}
    for name, df in sets.items():
        plan = executed(df).split("== Initial Plan ==")[0]
        assert len(re.findall(r"SortMergeJoin \[(?:pdpos|gpos)#", plan)) == 2, (name, plan)
        assert not re.search(r"Broadcast\w*Join \[[^\]]*(?:pdpos|gpos)", plan), (name, plan)
