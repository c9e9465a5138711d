"""Summarise the executed physical plans of the headline queries (after AQE).

usage: python scripts/plans.py [sf_dir]   -> markdown table on stdout
Counts shuffles (Exchange), window operators, sorts, join strategies and
aggregate kinds in the final adaptive plan of each query.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadprint.operators import evaluation, events, features, kinematics, sampling  # noqa: E402
from roadprint.session import get_session  # noqa: E402
from roadprint.sources import testdata  # noqa: E402

PATTERNS = {
    "Exchange": r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
    "BroadcastExchange": r"BroadcastExchange",
    "Window": r"\bWindow \[",
    "Sort": r"\bSort \[",
    "SortMergeJoin": r"SortMergeJoin",
    "BroadcastHashJoin": r"BroadcastHashJoin",
    "CartesianProduct": r"CartesianProduct|BroadcastNestedLoopJoin",
    "SortAggregate": r"SortAggregate\(",
    "HashAggregate": r"HashAggregate\(",
    "ObjectHashAggregate": r"ObjectHashAggregate\(",
    "Python": r"FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython",
}


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session()
    li = testdata.lineitem_steps(spark, sf_dir)
    idx = sampling.fleet_index(li)
    f1 = features.features_for_version(li, 1)
    lab = sampling.split_train_test(sampling.fleet_labelled_trips(idx).join(f1, ["driver", "trip"]),
                                    cols=("target", "driver", "trip", "slot"))
    plans = {
        "kinematics (raw)": kinematics.kinematics(li),
        "features v1": f1,
        "features v4 (smoothed, 133 percentiles)": features.features_for_version(li, 4),
        "accel events + event means": events.event_means(events.events_from_steps(li)),
        "fleet labelled trips (M8)": sampling.fleet_labelled_trips(idx),
        "fleet rule metrics (E1-E3)": evaluation.classification_metrics(
            evaluation.rule_predictions(lab), ["target"]),
        "half split (M11)": sampling.half_split(sampling.fleet_labelled_trips(idx)),
    }
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("| --- |" + " --- |" * len(PATTERNS))
    for name, df in plans.items():
        text = final_plan(df)
        counts = [str(len(re.findall(p, text))) for p in PATTERNS.values()]
        print(f"| {name} | " + " | ".join(counts) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
