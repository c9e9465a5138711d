"""Registered queries against their DuckDB SQL on the sf0.001 tables (events adapter)."""

import math
import os

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as E

NAMES = ["kinematics", "smoothed_kinematics", "moving_average", "features_v2", "features_v4",
         "features_90", "accel_events", "accel_event_mean", "speed_bands", "trip_vectors",
         "polar_signature", "sample_pairs_with_replacement", "sample_entities", "labelled_steps",
         "fleet_labelled_trips", "half_split", "kfold_assign", "metrics_record",
         "classification_metrics", "fleet_sample_entities", "fleet_sampled_trips",
         "fleet_labelled_steps", "fleet_relabel_trips", "angular_wrapped", "accel_events_positive"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return repr(v)
    return sorted("|".join(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _norm([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = _norm(res.fetchall(), cols)
    assert sorted(df.columns) == sorted(cols)
    assert got == want
