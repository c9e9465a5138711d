"""Registered queries: one per operator of the inventory, with its DuckDB oracle.

Every query reads the shared test tables through an adapter (whole tables,
no id subsets), runs the library operators, and rounds doubles half-up to 4
decimals with the same IEEE arithmetic as the oracle SQL.  Queries that fit a
model return its scored rows' counts, checked against SQL, and whether the fit
is sound.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadprint.functions.columns import q4
from roadprint.operators import (arrays, assembly, evaluation, events, features, fleet,
                                 kinematics, models, sampling)
from roadprint.plans import oracle as O
from roadprint.session import ensure_checkpoint_dir, materialize, shared_dir
from roadprint.sources import files, testdata

TARGET = 7          # the target driver of the single-target queries
K = sampling.K_TRIPS
K_ENTITIES = 101    # size of the shipped driver sample list
RULE_FEATURE, RULE_THRESHOLD = "max_v", 60.0

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def final(df: DataFrame) -> DataFrame:
    """Round every double column half-up to 4 decimals (engine-neutral)."""
    return df.select(*[q4(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def steps(spark, sf_dir, adapter="events"):
    ensure_checkpoint_dir(spark)
    return testdata.ADAPTERS[adapter](spark, sf_dir)


def kin(spark, sf_dir, smoothed=False, adapter="events"):
    return kinematics.kinematics(steps(spark, sf_dir, adapter), smoothed=smoothed)


SPLIT_HOT_ROWS, SPLIT_SEGMENT_ROWS = 60, 12  # small, so that the split path runs on the test tables

KIN_COLS = ["r", "theta", "v", "a", "cent_acc", "ang_vel", "tan_acc", "jerk"]
STEP_KEYS = "driver, trip, step"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


EV = O.steps_cte("events")

# ---------------------------------------------------------------- sources S1-S4


@query("scan_steps_csv", _with(EV) + "SELECT driver, trip, step, x, y FROM steps")
def scan_steps_csv(spark, sf_dir):
    path = shared_dir(spark, "steps-csv")
    files.write_steps_csv(steps(spark, sf_dir), path)
    raw = files.read_steps_csv(spark, path)
    return raw.select(F.col("driverID").cast("bigint").alias("driver"),
                      F.col("tripID").alias("trip"), F.col("step").cast("bigint").alias("step"), "x", "y")


@query("steps_cast", _with(EV) + "SELECT driver, trip, CAST(step AS DOUBLE) AS step, x, y, "
       "CAST(1.0 AS DOUBLE) AS label FROM steps")
def steps_cast(spark, sf_dir):
    path = shared_dir(spark, "steps-csv-raw")
    files.write_steps_csv(steps(spark, sf_dir), path)
    return files.csv_to_steps(files.read_steps_csv(spark, path, raw=True), label=1.0)


@query("scan_trips_json", _with(EV) + "SELECT driver, trip, "
       "CAST(row_number() OVER (PARTITION BY driver, trip ORDER BY step) - 1 AS BIGINT) AS pos, "
       "step, x, y FROM steps")
def scan_trips_json(spark, sf_dir):
    path = shared_dir(spark, "trips-json")
    files.write_trips_json(assembly.trip_vectors(steps(spark, sf_dir)), path)
    return assembly.explode_trips(files.read_trips_json(spark, path))


# One line in nine has a bad number, one in thirteen lacks its last field.
_LINES = ("SELECT driver, CASE WHEN step % 9 = 0 OR step % 13 = 0 THEN 1 ELSE 0 END AS bad FROM steps")


@query("scan_steps_rejects", _with(EV, f"l AS ({_LINES})") + "SELECT driver, count(*) AS n_lines, "
       "count(CASE WHEN bad = 0 THEN 1 END) AS n_steps, count(CASE WHEN bad = 1 THEN 1 END) AS n_rejects FROM l GROUP BY driver")
def scan_steps_rejects(spark, sf_dir):
    """Step lines with malformed ones among them: each is a step or a reject."""
    path = shared_dir(spark, "steps-dirty")
    x = F.when(F.col("step") % 9 == 0, F.lit("12,5x")).otherwise(F.col("x").cast("string"))
    full = F.concat_ws(",", x, "y", "driver", "trip")
    line = F.when(F.col("step") % 13 == 0, full).otherwise(F.concat_ws(",", full, "step"))
    steps(spark, sf_dir).select(line.alias("value")).write.text(path)
    got = files.read_steps_checked(spark, path)
    bad = F.when(F.col("line").startswith("12,5x,"), F.element_at(F.split("line", ","), 4)).otherwise(
        F.element_at(F.split("line", ","), 3))
    rows = got.rows.select(F.col("driverID").cast("bigint").alias("driver"), F.lit(0).alias("bad")).unionByName(
        got.rejects.select(bad.cast("bigint").alias("driver"), F.lit(1).alias("bad")))
    return rows.groupBy("driver").agg(F.count(F.lit(1)).alias("n_lines"),
                                      F.count(F.when(F.col("bad") == 0, 1)).alias("n_steps"),
                                      F.count(F.when(F.col("bad") == 1, 1)).alias("n_rejects"))


@query("entity_catalogue", "SELECT DISTINCT user_id AS driver FROM events")
def entity_catalogue(spark, sf_dir):
    return files.entity_catalogue(steps(spark, sf_dir))


@query("catalogue_from_files", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS driver FROM events")
def catalogue_from_files(spark, sf_dir):
    base = shared_dir(spark, "driver-names")
    files.write_files_by(steps(spark, sf_dir).select(F.concat(F.lit("driver_"), F.col("driver")).alias("file"),
                                                     F.col("trip").alias("value")), "file", base)
    return files.catalogue_from_files(spark, f"{base}/*/*", use_parent=True)


def metrics_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "metrics")
    files.write_metrics(_metrics_record(spark, sf_dir), path)
    return files.read_metrics(spark, path)


# ---------------------------------------------------------------- projections P1-P8, sets


def _pairs_sql_ctes(target=TARGET):
    return [EV, O.fleet_ctes(K, target)]


@query("trips_membership", _with(*_pairs_sql_ctes()) +
       "SELECT driver, trip, step, x, y FROM steps s WHERE EXISTS "
       "(SELECT 1 FROM pairs p WHERE p.driver = s.driver AND p.trip = s.trip)")
def trips_membership(spark, sf_dir):
    st = steps(spark, sf_dir)
    pairs = sampling.sample_pairs(sampling.fleet_index(st), K, targets=[TARGET])
    return sampling.trips_membership(st, pairs, bounded=True)


@query("pool_without_target", f"SELECT DISTINCT user_id AS driver FROM events WHERE user_id <> {TARGET}")
def pool_without_target(spark, sf_dir):
    return sampling.pool_without_target(files.entity_catalogue(steps(spark, sf_dir)), TARGET)


@query("label_by_id_rule", _with(EV, O.fleet_labelled_ctes(K, sampling.FIRST_FOREIGN_ID)) +
       "SELECT target, driver, trip, slot, trip_no, label, "
       f"CASE WHEN trip_no < {sampling.FIRST_FOREIGN_ID} THEN CAST(1.0 AS DOUBLE) "
       "ELSE CAST(0.0 AS DOUBLE) END AS rule_label FROM labelled")
def label_by_id_rule(spark, sf_dir):
    return final(sampling.label_by_id_rule(_fleet_labelled(spark, sf_dir)))


@query("distinct_trips", _with(EV) + "SELECT DISTINCT driver, trip FROM steps")
def distinct_trips(spark, sf_dir):
    return sampling.trip_catalogue(steps(spark, sf_dir))


_VECTOR_POS = " UNION ALL ".join(f"SELECT driver, trip, {i} AS pos, CAST({n} AS DOUBLE) AS v FROM f"
                                 for i, n in enumerate(features.V1))


@query("feature_vectors", "WITH " + O.features_ctes(list(features.V1)) + "\n" +
       f"SELECT driver, trip, pos, {O.q('v', 'value')} FROM ({_VECTOR_POS}) WHERE v IS NOT NULL")
def feature_vectors(spark, sf_dir):
    """The assembled ML vectors, one row per position that holds a value."""
    from pyspark.ml.functions import vector_to_array
    f = features.features_for_version(steps(spark, sf_dir), 1)
    v = features.assemble(f, features.V1).select("driver", "trip", vector_to_array("features").alias("features"))
    rows = v.select("driver", "trip", F.posexplode("features").alias("pos", "value"))
    return final(rows.where(~F.isnan("value")))


# ---------------------------------------------------------------- sampling M1-M11, J1, U1


@query("sample_pairs_with_replacement", _with(*_pairs_sql_ctes()) +
       "SELECT target, slot, driver, trip FROM pairs")
def sample_pairs_with_replacement(spark, sf_dir):
    idx = sampling.fleet_index(steps(spark, sf_dir))
    return sampling.sample_pairs(idx, K, targets=[TARGET])


_M2_SQL = (f"SELECT CAST({TARGET} AS BIGINT) AS target, driver FROM "
           f"(SELECT DISTINCT user_id AS driver FROM events WHERE user_id <> {TARGET}) "
           f"ORDER BY {O.h(repr(str(O.SEED)), repr(str(TARGET)), 'driver')}, driver LIMIT {{k}}")


@query("sample_entities", _M2_SQL.format(k=K_ENTITIES))
def sample_entities(spark, sf_dir):
    return sampling.sample_entities(files.entity_catalogue(steps(spark, sf_dir)), TARGET, K_ENTITIES)


@query("scan_driver_paths", _with(EV, f"sd AS ({_M2_SQL.format(k=K_ENTITIES)})") +
       "SELECT driver, trip, step, x, y FROM steps WHERE driver IN (SELECT driver FROM sd)")
def scan_driver_paths(spark, sf_dir):
    """Only the files of the drawn drivers are opened."""
    base, st = shared_dir(spark, "driver-files"), steps(spark, sf_dir)
    files.write_files_by(st.select("driver", F.format_string("%s,%s,%s,%s,%s", "x", "y", "driver", "trip", "step")
                                   .alias("value")), "driver", base)
    drawn = [r["driver"] for r in sampling.sample_entities(
        files.entity_catalogue(st), TARGET, K_ENTITIES).collect()]
    raw = files.read_steps_csv(spark, [f"{base}/driver={d}" for d in sorted(drawn)])  # K_ENTITIES at most
    return raw.select(F.col("driverID").cast("bigint").alias("driver"), F.col("tripID").alias("trip"),
                      F.col("step").cast("bigint").alias("step"), "x", "y")


@query("bernoulli_trips", _with(EV) + "SELECT DISTINCT driver, trip FROM steps WHERE "
       f"{O.h(repr(str(O.SEED)), 'driver', 'trip')} < {O.u32_threshold(sampling.TRIP_FRACTION)}")
def bernoulli_trips(spark, sf_dir):
    return sampling.bernoulli(sampling.trip_catalogue(steps(spark, sf_dir)))


@query("labelled_trips", _with(
    EV,
    "trips AS (SELECT DISTINCT driver, trip FROM steps)",
    f"sd AS ({_M2_SQL.format(k=sampling.K_DRIVERS)})") +
    "SELECT driver, trip, 1 AS label FROM trips WHERE driver = " + str(TARGET) +
    " UNION ALL SELECT driver, trip, 0 AS label FROM trips WHERE driver IN (SELECT driver FROM sd) "
    f"AND {O.h(repr(str(O.SEED)), 'driver', 'trip')} < {O.u32_threshold(sampling.TRIP_FRACTION)}")
def labelled_trips(spark, sf_dir):
    return sampling.labelled_trips(steps(spark, sf_dir), TARGET)


_GLOSSARY_CTE = (
    f"gl AS (SELECT target, driver, trip, CAST(row_number() OVER (PARTITION BY target ORDER BY "
    f"{O.h(repr(str(O.SEED)), 'target', 'driver', 'trip')}, driver, trip) + "
    f"{sampling.FIRST_FOREIGN_ID - 1} AS BIGINT) AS trip_no "
    f"FROM (SELECT DISTINCT target, driver, trip FROM pairs))")


@query("relabel_trips", _with(*_pairs_sql_ctes(), _GLOSSARY_CTE) +
       "SELECT gl.target AS driver, gl.trip_no, s.step, s.x, s.y FROM steps s JOIN gl "
       "ON s.driver = gl.driver AND s.trip = gl.trip")
def relabel_trips(spark, sf_dir):
    st = steps(spark, sf_dir)
    pairs = sampling.sample_pairs(sampling.fleet_index(st), K, targets=[TARGET])
    return sampling.relabel_steps(st, sampling.relabel_glossary(pairs), bounded=True)


@query("labelled_steps", _with(*_pairs_sql_ctes(), _GLOSSARY_CTE) +
       f"SELECT driver, trip, step, x, y, CAST(1.0 AS DOUBLE) AS label FROM steps WHERE driver = {TARGET} "
       "UNION ALL SELECT gl.target AS driver, CAST(gl.trip_no AS VARCHAR) AS trip, s.step, s.x, s.y, "
       "CAST(0.0 AS DOUBLE) AS label FROM steps s JOIN gl ON s.driver = gl.driver AND s.trip = gl.trip")
def labelled_steps(spark, sf_dir):
    return sampling.labelled_steps(steps(spark, sf_dir), TARGET, K)


@query("labelled_union", _with(*_pairs_sql_ctes()) +
       f"SELECT driver, trip, step, x, y, CAST(1.0 AS DOUBLE) AS label FROM steps WHERE driver = {TARGET} "
       "UNION ALL SELECT driver, trip, step, x, y, CAST(0.0 AS DOUBLE) AS label FROM steps s "
       "WHERE EXISTS (SELECT 1 FROM pairs p WHERE p.driver = s.driver AND p.trip = s.trip)")
def labelled_union(spark, sf_dir):
    st = steps(spark, sf_dir)
    pairs = sampling.sample_pairs(sampling.fleet_index(st), K, targets=[TARGET])
    pos = st.where(F.col("driver") == TARGET).withColumn("label", F.lit(1.0))
    neg = sampling.trips_membership(st, pairs, bounded=True).withColumn("label", F.lit(0.0))
    return sampling.union_labelled(pos, neg)


# ---- the same operators for every target at once (M1, P4, J1/M4, M6, U1 over the fleet)

_FLEET_PAIRS = [EV, O.fleet_ctes(K)]


@query("fleet_sample_pairs", _with(*_FLEET_PAIRS) + "SELECT target, slot, driver, trip FROM pairs")
def fleet_sample_pairs(spark, sf_dir):
    return sampling.sample_pairs(sampling.fleet_index(steps(spark, sf_dir)), K)


@query("fleet_trips_membership", _with(*_FLEET_PAIRS) +
       "SELECT driver, trip, step, x, y FROM steps s WHERE EXISTS "
       "(SELECT 1 FROM pairs p WHERE p.driver = s.driver AND p.trip = s.trip)")
def fleet_trips_membership(spark, sf_dir):
    st = steps(spark, sf_dir)
    return sampling.trips_membership(st, sampling.sample_pairs(sampling.fleet_index(st), K))


@query("fleet_relabel_trips", _with(*_FLEET_PAIRS, _GLOSSARY_CTE) +
       "SELECT gl.target AS driver, gl.trip_no, s.step, s.x, s.y FROM steps s JOIN gl "
       "ON s.driver = gl.driver AND s.trip = gl.trip")
def fleet_relabel_trips(spark, sf_dir):
    st = steps(spark, sf_dir)
    pairs = sampling.sample_pairs(sampling.fleet_index(st), K)
    return sampling.relabel_steps(st, sampling.relabel_glossary(pairs))


@query("fleet_labelled_steps", _with(*_FLEET_PAIRS, _GLOSSARY_CTE) +
       "SELECT driver, trip, step, x, y, CAST(1.0 AS DOUBLE) AS label FROM steps "
       "UNION ALL SELECT gl.target AS driver, CAST(gl.trip_no AS VARCHAR) AS trip, s.step, s.x, s.y, "
       "CAST(0.0 AS DOUBLE) AS label FROM steps s JOIN gl ON s.driver = gl.driver AND s.trip = gl.trip")
def fleet_labelled_steps(spark, sf_dir):
    return sampling.fleet_labelled_steps(steps(spark, sf_dir), K)


@query("fleet_labelled_union", _with(*_FLEET_PAIRS) +
       "SELECT driver AS target, driver, trip, step, x, y, CAST(1.0 AS DOUBLE) AS label FROM steps "
       "UNION ALL SELECT p.target, s.driver, s.trip, s.step, s.x, s.y, CAST(0.0 AS DOUBLE) AS label "
       "FROM steps s JOIN (SELECT DISTINCT target, driver, trip FROM pairs) p "
       "ON s.driver = p.driver AND s.trip = p.trip")
def fleet_labelled_union(spark, sf_dir):
    st = steps(spark, sf_dir)
    pairs = sampling.sample_pairs(sampling.fleet_index(st), K)
    keys = pairs.select("target", "driver", "trip").distinct()
    pos = st.withColumn("target", F.col("driver")).withColumn("label", F.lit(1.0))
    neg = st.join(keys, ["driver", "trip"]).withColumn("label", F.lit(0.0))
    return sampling.union_labelled(pos, neg).select("target", "driver", "trip", "step", "x", "y", "label")


# M2 / M5 for every target (draws without replacement, then a Bernoulli sample of trips)

_ENT_SQL = _with(EV, O.fleet_entities_ctes(K_ENTITIES, 40 * K_ENTITIES))


@query("fleet_sample_entities", _ENT_SQL + "SELECT target, driver FROM ents")
def fleet_sample_entities(spark, sf_dir):
    return sampling.sample_entities_fleet(sampling.fleet_index(steps(spark, sf_dir)), K_ENTITIES)


@query("fleet_sampled_trips", _with(EV, O.fleet_entities_ctes(sampling.K_DRIVERS, 40 * sampling.K_DRIVERS),
                                    O.skip_ctes(sampling.TRIP_FRACTION, sampling.SKIP_BLOCK)).replace(
                                        "WITH ", "WITH RECURSIVE ", 1) +
       "SELECT driver AS target, driver, trip, 1 AS label FROM tidx UNION ALL "
       "SELECT k.target, t.driver, t.trip, 0 AS label FROM kept k JOIN didx d ON d.driver = k.driver "
       "JOIN tidx t ON t.gpos = d.start + k.pos")
def fleet_sampled_trips(spark, sf_dir):
    return sampling.fleet_sampled_trips(sampling.fleet_index(steps(spark, sf_dir)))


def _fleet_labelled(spark, sf_dir):
    return sampling.fleet_labelled_trips(sampling.fleet_index(steps(spark, sf_dir)), K)


_FLEET = _with(EV, O.fleet_labelled_ctes(K, sampling.FIRST_FOREIGN_ID))


@query("fleet_labelled_trips", _FLEET + "SELECT target, driver, trip, slot, trip_no, label FROM labelled")
def fleet_labelled_trips(spark, sf_dir):
    return _fleet_labelled(spark, sf_dir)


_SPLIT_KEY = O.h(repr(str(O.SEED)), "target", "driver", "trip", "slot")


@query("split_70_30", _FLEET + "SELECT target, driver, trip, slot, label, CASE WHEN "
       f"{_SPLIT_KEY} < {O.u32_threshold(0.7)} THEN 'train' ELSE 'test' END AS split FROM labelled")
def split_70_30(spark, sf_dir):
    df = _fleet_labelled(spark, sf_dir).drop("trip_no")
    return sampling.split_train_test(df, cols=("target", "driver", "trip", "slot"))


@query("kfold_assign", _FLEET + f"SELECT target, driver, trip, slot, label, {_SPLIT_KEY} % 5 AS fold "
       "FROM labelled")
def kfold_assign(spark, sf_dir):
    df = _fleet_labelled(spark, sf_dir).drop("trip_no")
    return sampling.kfold(df, 5, cols=("target", "driver", "trip", "slot"))


@query("half_split", _FLEET + "SELECT target, driver, trip, slot, label, CAST(ntile(2) OVER ("
       "PARTITION BY target, label ORDER BY "
       f"{O.h(repr(str(O.SEED)), 'target', 'label', 'driver', 'trip', 'slot')}, driver, trip, slot) "
       "AS INTEGER) AS half FROM labelled")
def half_split(spark, sf_dir):
    return sampling.half_split(_fleet_labelled(spark, sf_dir).drop("trip_no"))


# ---------------------------------------------------------------- assembly G1-G3, arrays K13/F1


@query("trip_vectors", _with(EV) + "SELECT driver, trip, count(*) AS n_points, "
       "arg_min(x, step) AS x_first, arg_max(x, step) AS x_last, arg_min(y, step) AS y_first, "
       "arg_max(y, step) AS y_last, min(step) AS step_first, max(step) AS step_last "
       "FROM steps GROUP BY driver, trip")
def trip_vectors(spark, sf_dir):
    v = assembly.trip_chunks(steps(spark, sf_dir))
    end = lambda pick, col, at: pick(F.element_at(col, at), "chunk").alias(
        f"{col}_{'first' if at == 1 else 'last'}")
    return v.groupBy("driver", "trip").agg(
        F.sum("n_core").alias("n_points"), *[end(pick, col, at) for col in ("x", "y", "step")
                                             for pick, at in ((F.min_by, 1), (F.max_by, -1))])


@query("trip_signature", _with(EV) + "SELECT driver, trip, count(*) AS n_points, "
       + O.q("sum(x)", "sum_x") + ", " + O.q("sum(y)", "sum_y") + ", CAST(sum(step) AS BIGINT) AS sum_steps "
       "FROM steps GROUP BY driver, trip")
def trip_signature(spark, sf_dir):
    sig = assembly.signature_chunks(steps(spark, sf_dir))
    add = lambda acc, e: acc + e  # noqa: E731  (F4: a fold over the list)
    return final(sig.groupBy("driver", "trip").agg(
        F.sum(F.size("signature.x")).alias("n_points"),
        F.sum(F.aggregate("signature.x", F.lit(0.0), add)).alias("sum_x"),
        F.sum(F.aggregate("signature.y", F.lit(0.0), add)).alias("sum_y"),
        F.sum(F.aggregate("signature.steps", F.lit(0).cast("bigint"), add)).alias("sum_steps")))


@query("explode_trips", SQL["scan_trips_json"])
def explode_trips(spark, sf_dir):
    return assembly.explode_chunks(assembly.trip_chunks(steps(spark, sf_dir)))


def _kin_sql(cols, smoothed=False, where="", adapter="events"):
    sel = ", ".join(O.q(c) for c in cols)
    return _with(O.steps_cte(adapter), O.kin_ctes(smoothed)) + f"SELECT {STEP_KEYS}, {sel} FROM kin {where}"


@query("kinematics_arrays", _kin_sql(["x", "y"] + KIN_COLS))
def kinematics_arrays(spark, sf_dir):
    karr = arrays.kinematics_chunks(steps(spark, sf_dir))
    return final(arrays.explode_kinematics(karr))


@query("kinematics_arrays_smoothed", _kin_sql(["v", "a", "cent_acc", "jerk"], smoothed=True,
                                             where="WHERE v IS NOT NULL"))
def kinematics_arrays_smoothed(spark, sf_dir):
    karr = arrays.kinematics_chunks(steps(spark, sf_dir), smoothed=True)
    out = arrays.explode_kinematics(karr, series=["v", "a", "cent_acc", "jerk"])
    return final(out.where(F.col("v").isNotNull()))


@query("polar_signature", _with(EV, O.kin_ctes()) +
       "SELECT driver, trip, step_no - 1 AS pos, " + O.q("r") + ", " + O.q("theta") + " FROM kin")
def polar_signature(spark, sf_dir):
    p = arrays.polar_chunks(steps(spark, sf_dir))
    out = p.select("driver", "trip", "first_pos", "r", "theta", F.posexplode("r").alias("pos", "_r"))
    return final(out.select("driver", "trip", (F.col("first_pos") + F.col("pos")).alias("pos"),
                            F.col("_r").alias("r"), F.get("theta", F.col("pos")).alias("theta")))


CHUNK = {"chunk_points": 16, "hot_rows": 40}  # small, so that trips of about 100 steps are cut


@query("trip_chunks_lineitem", _with(O.steps_cte("lineitem"), "numbered AS (SELECT *, row_number() OVER "
       "(PARTITION BY driver, trip ORDER BY step) - 1 AS pos FROM steps)") +
       f"SELECT driver, trip, pos // {CHUNK['chunk_points']} AS chunk, min(pos) AS first_pos, count(*) AS n_core, "
       "arg_min(x, pos) AS x_first, arg_max(x, pos) AS x_last, arg_min(y, pos) AS y_first, arg_max(y, pos) AS y_last, "
       "min(step) AS step_first, max(step) AS step_last FROM numbered GROUP BY ALL")
def trip_chunks_lineitem(spark, sf_dir):
    c = assembly.trip_chunks(steps(spark, sf_dir, "lineitem"), **CHUNK, back=3, ahead=9)
    c = assembly.own_points(c, ["x", "y", "step"])
    return c.select("driver", "trip", "chunk", "first_pos", F.col("n_core").cast("bigint").alias("n_core"),
                    *[F.element_at(col, at).alias(f"{col}_{name}") for col in ("x", "y", "step")
                      for at, name in ((1, "first"), (-1, "last"))])


@query("kinematics_arrays_split_lineitem", _kin_sql(["x", "y"] + KIN_COLS, adapter="lineitem"))
def kinematics_arrays_split_lineitem(spark, sf_dir):
    return final(arrays.explode_kinematics(arrays.kinematics_chunks(steps(spark, sf_dir, "lineitem"), **CHUNK)))


@query("kinematics_arrays_smoothed_split_lineitem", _kin_sql(
    ["v", "a", "cent_acc", "jerk"], smoothed=True, where="WHERE v IS NOT NULL", adapter="lineitem"))
def kinematics_arrays_smoothed_split_lineitem(spark, sf_dir):
    karr = arrays.kinematics_chunks(steps(spark, sf_dir, "lineitem"), smoothed=True, **CHUNK)
    out = arrays.explode_kinematics(karr, series=["v", "a", "cent_acc", "jerk"])
    return final(out.where(F.col("v").isNotNull()))


# ---------------------------------------------------------------- kinematics K1-K12


@query("polar", _kin_sql(["r", "theta"]))
def polar(spark, sf_dir):
    return final(kinematics.polar(steps(spark, sf_dir)).select("driver", "trip", "step", "r", "theta"))


@query("lag_zero", _with(EV) + "SELECT driver, trip, step, lag(x, 1, 0.0) OVER w AS prev_x, "
       f"lag(y, 1, 0.0) OVER w AS prev_y FROM steps {O.W}")
def lag_zero(spark, sf_dir):
    return kinematics.lag_zero(steps(spark, sf_dir)).select("driver", "trip", "step", "prev_x", "prev_y")


def _kin_query(name, cols, smoothed=False):
    def fn(spark, sf_dir):
        return final(kin(spark, sf_dir, smoothed).select("driver", "trip", "step", *cols))
    query(name, _kin_sql(cols, smoothed))(fn)


@query("angular_wrapped", _with(EV, O.kin_ctes(wrap=True)) +
       f"SELECT {STEP_KEYS}, {O.q('ang_vel')}, {O.q('tan_acc')} FROM kin")
def angular_wrapped(spark, sf_dir):
    k = kinematics.kinematics(steps(spark, sf_dir), wrap=True)
    return final(k.select("driver", "trip", "step", "ang_vel", "tan_acc"))


_kin_query("speed", ["v"])
_kin_query("acceleration", ["a"])
_kin_query("centripetal", ["cent_acc"])
_kin_query("angular", ["ang_vel", "tan_acc"])
_kin_query("jerk", ["jerk"])
_kin_query("kinematics", ["x", "y"] + KIN_COLS)
_kin_query("smoothed_kinematics", ["v", "a", "cent_acc", "ang_vel", "tan_acc", "jerk"], smoothed=True)


@query("moving_average", _with(EV, O.kin_ctes(smoothed=True)) +
       f"SELECT {STEP_KEYS}, {O.q('v', 'v_ma')} FROM kin WHERE v IS NOT NULL")
def moving_average(spark, sf_dir):
    sp = kinematics.speed(steps(spark, sf_dir))
    ma = kinematics.moving_average(sp, "v", out="v_ma").where(F.col("v_ma").isNotNull())
    return final(ma.select("driver", "trip", "step", "v_ma"))


@query("steps_split_lineitem", _with(O.steps_cte("lineitem")) + "SELECT driver, trip, step, x, y FROM steps")
def steps_split_lineitem(spark, sf_dir):
    """Steps numbered by dense positions wherever a trip has more than a few rows."""
    return testdata.lineitem_steps(spark, sf_dir, hot_rows=SPLIT_HOT_ROWS)


@query("lag_zero_split_lineitem", _with(O.steps_cte("lineitem")) + f"SELECT {STEP_KEYS}, lag(x, 1, 0.0) OVER w "
       f"AS prev_x, lag(y, 1, 0.0) OVER w AS prev_y FROM steps {O.W}")
def lag_zero_split_lineitem(spark, sf_dir):
    return kinematics.lag_zero(steps(spark, sf_dir, "lineitem"), hot_rows=SPLIT_HOT_ROWS,
                               segment_rows=SPLIT_SEGMENT_ROWS).select("driver", "trip", "step", "prev_x", "prev_y")


@query("moving_average_split_lineitem", _with(O.steps_cte("lineitem"), O.kin_ctes(smoothed=True)) +
       f"SELECT {STEP_KEYS}, {O.q('v', 'v_ma')} FROM kin WHERE v IS NOT NULL")
def moving_average_split_lineitem(spark, sf_dir):
    split = {"hot_rows": SPLIT_HOT_ROWS, "segment_rows": SPLIT_SEGMENT_ROWS}
    sp = kinematics.speed(steps(spark, sf_dir, "lineitem"), **split)
    ma = kinematics.moving_average(sp, "v", out="v_ma", **split).where(F.col("v_ma").isNotNull())
    return final(ma.select("driver", "trip", "step", "v_ma"))


@query("kinematics_lineitem", _with(O.steps_cte("lineitem"), O.kin_ctes()) +
       f"SELECT {STEP_KEYS}, " + ", ".join(O.q(c) for c in KIN_COLS) + " FROM kin")
def kinematics_lineitem(spark, sf_dir):
    return final(kin(spark, sf_dir, adapter="lineitem").select("driver", "trip", "step", *KIN_COLS))


# ---------------------------------------------------------------- trip features A1-A21


def _feat_query(name, names, smoothed=False, adapter="events"):
    def fn(spark, sf_dir):
        return final(features.features_from_steps(steps(spark, sf_dir, adapter), names, smoothed))
    query(name, O.features_query(names, smoothed, adapter))(fn)


_feat_query("trip_features_basic", ["min_v", "max_v", "min_a", "max_a", "trip_length", "mean_v",
                                    "std_v", "mean_a", "std_a", "time_stop"])
_feat_query("trip_distance", ["distance"])
_feat_query("trip_signed_accel", ["mean_pos_a", "std_pos_a", "mean_neg_a", "std_neg_a"])
_feat_query("trip_angular_jerk", ["mean_ang_vel", "std_ang_vel", "mean_tan_acc", "std_tan_acc",
                                  "mean_jerk", "std_jerk"])
_feat_query("stop_time", ["time_stop"])
_feat_query("trip_percentiles", features.PCT7)
_feat_query("features_v1", features.V1)
_feat_query("features_v2", features.V2)
_feat_query("features_v3", features.V1, smoothed=True)
_feat_query("features_v4", features.V2, smoothed=True)
_feat_query("features_minimal", features.MINIMAL)
_feat_query("features_11", features.F11)
_feat_query("features_48", features.F48)
_feat_query("features_90", features.F90)
_feat_query("accel_first_second", ["a_first", "a_second"])
_feat_query("features_v4_lineitem", features.V2, smoothed=True, adapter="lineitem")

# The hot-trip path (segments with halos, ranked percentiles) with thresholds low
# enough that part of the test trips take it; its oracle is the one-window SQL.


def _split_query(name, names, smoothed, adapter):
    def fn(spark, sf_dir):
        st = steps(spark, sf_dir, adapter)
        return final(features.features_from_steps(st, names, smoothed, hot_rows=SPLIT_HOT_ROWS,
                                                  segment_rows=SPLIT_SEGMENT_ROWS))
    query(name, O.features_query(names, smoothed, adapter))(fn)


_split_query("features_v2_split_lineitem", features.V2, False, "lineitem")
_split_query("features_v4_split_lineitem", features.V2, True, "lineitem")


@query("kinematics_split_lineitem", _with(O.steps_cte("lineitem"), O.kin_ctes(True)) +
       f"SELECT {STEP_KEYS}, " + ", ".join(O.q(c) for c in KIN_COLS) + " FROM kin")
def kinematics_split_lineitem(spark, sf_dir):
    k = kinematics.kinematics(steps(spark, sf_dir, "lineitem"), smoothed=True,
                              hot_rows=SPLIT_HOT_ROWS, segment_rows=SPLIT_SEGMENT_ROWS)
    return final(k.select("driver", "trip", "step", *KIN_COLS))


# ---------------------------------------------------------------- events V1-V8


def _events_sql(select, adapter="events"):
    return _with(O.steps_cte(adapter), O.kin_ctes(), O.events_ctes()) + select


@query("accel_events", _events_sql(f"SELECT {O.EVENT_COLS} FROM events"))
def accel_events(spark, sf_dir):
    return final(events.events_from_steps(steps(spark, sf_dir)))


@query("accel_events_positive", _events_sql(f"SELECT {O.EVENT_COLS} FROM events WHERE sign = 1"))
def accel_events_positive(spark, sf_dir):
    return final(events.positive_events(events.events_from_steps(steps(spark, sf_dir))))


@query("accel_events_negative", _events_sql(f"SELECT {O.EVENT_COLS} FROM events WHERE sign = -1"))
def accel_events_negative(spark, sf_dir):
    return final(events.negative_events(events.events_from_steps(steps(spark, sf_dir))))


@query("accel_event_mean", _events_sql(
    "SELECT driver, trip, count(CASE WHEN sign = 1 THEN 1 END) AS n_pos_events, "
    + O.q("avg(CASE WHEN sign = 1 THEN mean_a END)", "mean_pos_events") + ", "
    "count(CASE WHEN sign = -1 THEN 1 END) AS n_neg_events, "
    + O.q("avg(CASE WHEN sign = -1 THEN mean_a END)", "mean_neg_events") + ", "
    "count(*) AS n_events, " + O.q("avg(mean_a)", "mean_all_events") +
    " FROM events GROUP BY driver, trip"))
def accel_event_mean(spark, sf_dir):
    return final(events.event_means(events.events_from_steps(steps(spark, sf_dir))))


@query("event_end_speed", _events_sql("SELECT driver, trip, event_no, " + O.q("end_speed") +
                                      " FROM events"))
def event_end_speed(spark, sf_dir):
    ev = events.events_from_steps(steps(spark, sf_dir))
    return final(ev.select("driver", "trip", "event_no", "end_speed"))


@query("speed_bands", _with(EV, O.kin_ctes()) + O.speed_bands_sql())
def speed_bands(spark, sf_dir):
    return final(events.speed_bands(kin(spark, sf_dir)))


@query("accel_events_split_lineitem", _events_sql(f"SELECT {O.EVENT_COLS} FROM events", "lineitem"))
def accel_events_split_lineitem(spark, sf_dir):
    st = steps(spark, sf_dir, "lineitem")
    return final(events.events_from_steps(st, hot_rows=SPLIT_HOT_ROWS,
                                          segment_rows=SPLIT_SEGMENT_ROWS))


@query("accel_events_lineitem", _events_sql(f"SELECT {O.EVENT_COLS} FROM events", "lineitem"))
def accel_events_lineitem(spark, sf_dir):
    return final(events.events_from_steps(steps(spark, sf_dir, "lineitem")))


# ---------------------------------------------------------------- evaluation E1-E5


def _rule_scored(spark, sf_dir):
    """Fleet labelled trips + version-1 features + 70/30 split + the rule classifier."""
    st = steps(spark, sf_dir)
    f = features.features_for_version(st, 1)
    lab = sampling.fleet_labelled_trips(sampling.fleet_index(st), K)
    df = lab.join(f, ["driver", "trip"])
    df = sampling.split_train_test(df, cols=("target", "driver", "trip", "slot"))
    return evaluation.rule_predictions(df, RULE_FEATURE, RULE_THRESHOLD)


def _rule_scored_sql():
    return (f"WITH {O.features_ctes([RULE_FEATURE])},\n{O.fleet_labelled_ctes(K, sampling.FIRST_FOREIGN_ID)},\n"
            f"scored AS (SELECT l.*, CASE WHEN {_SPLIT_KEY} < {O.u32_threshold(0.7)} THEN 'train' "
            f"ELSE 'test' END AS split, CASE WHEN f.{RULE_FEATURE} > {RULE_THRESHOLD} "
            f"THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction "
            f"FROM labelled l JOIN f USING (driver, trip))\n")


def _r2(num, den):
    return (f"CASE WHEN ({den}) > 0 THEN CAST((200 * ({num}) + ({den})) // (2 * ({den})) AS DOUBLE) "
            f"/ 100.0 END")


def _cnt(cond):
    return f"count(CASE WHEN {cond} THEN 1 END)"


def _metric_sql(prefix="", cond="TRUE"):
    c = lambda e: _cnt(f"({cond}) AND ({e})")
    n, correct = c("TRUE"), c("label = prediction")
    pos, neg = c("label = 1"), c("label = 0")
    tp, fp, fn = c("label = 1 AND prediction = 1"), c("label = 0 AND prediction = 1"), \
        c("label = 1 AND prediction = 0")
    p = prefix
    return (f"{_r2(correct, n)} AS {p}accuracy, {_r2(tp, f'{tp} + {fp}')} AS {p}precision, "
            f"{_r2(tp, pos)} AS {p}recall, {pos} AS {p}positive_count, {neg} AS {p}negative_count, "
            f"{fp} AS {p}fp_count, {fn} AS {p}fn_count")


@query("classification_metrics", _rule_scored_sql() +
       f"SELECT target, {_metric_sql()} FROM scored GROUP BY target")
def classification_metrics(spark, sf_dir):
    return evaluation.classification_metrics(_rule_scored(spark, sf_dir), ["target"])


@query("error_rate", _rule_scored_sql() +
       "SELECT target, split, CAST(count(CASE WHEN label <> prediction THEN 1 END) AS DOUBLE) / "
       "CAST(count(*) AS DOUBLE) AS error_rate, count(*) AS n FROM scored GROUP BY target, split")
def error_rate(spark, sf_dir):
    return evaluation.error_rate(_rule_scored(spark, sf_dir), ["target", "split"])


@query("metrics_record", _rule_scored_sql() +
       "SELECT target AS driver, CAST(1.0 AS DOUBLE) AS version, 0 AS num_trees, 0 AS heldout_set, "
       f"{_metric_sql('test_', "split = 'test'")}, {_metric_sql('train_', "split = 'train'")} "
       "FROM scored GROUP BY target")
def metrics_record(spark, sf_dir):
    df = (_rule_scored(spark, sf_dir)
          .drop("driver").withColumnRenamed("target", "driver")
          .withColumn("version", F.lit(1.0)).withColumn("num_trees", F.lit(0))
          .withColumn("heldout_set", F.lit(0)))
    return evaluation.metrics_record(df)


_metrics_record = metrics_record  # S4 writes the same records


query("metrics_roundtrip", SQL["metrics_record"])(metrics_roundtrip)


# ---------------------------------------------------------------- models L1-L10

MODEL_ADAPTER = "monthly"   # many trips per driver, so both halves hold both classes


def _target_trips(st):
    """The target's labelled trips, written once."""
    return materialize(sampling.fleet_labelled_trips(sampling.fleet_index(st), K)
                       .where(F.col("target") == TARGET), "target-trips")


def _target_set(spark, sf_dir, version):
    st = steps(spark, sf_dir, MODEL_ADAPTER)
    return _with_features(st, _target_trips(st), version)


def _with_features(st, labelled, version):
    """One target's labelled trips with the version's features, split 70/30.

    Only the steps of the target's own and drawn trips go into the features.
    """
    f = features.features_for_version(st.join(labelled.select("driver", "trip").distinct(), ["driver", "trip"],
                                              "left_semi"), version)
    data = labelled.join(f, ["driver", "trip"])
    return (sampling.split_train_test(data, cols=("target", "driver", "trip", "slot")),
            features.VERSIONS[version][1])


def _counted(scored: DataFrame, by: list[str], *more) -> DataFrame:
    return scored.groupBy(*by, "split", F.col("label").cast("double").alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("prediction").isNull() | ~F.col("prediction").isin(0.0, 1.0), 1)).alias("n_outside"), *more)


def _summary(scored: DataFrame, by: list[str]) -> DataFrame:
    """Per split and label: rows, predictions outside {0, 1}, and whether the fit is at least as
    right on its training rows as always naming the larger class."""
    got = _counted(scored, by, F.count(F.when(F.col("prediction") == F.col("label"), 1)).alias("_right"))
    fit = got.where("split = 'train'").groupBy(*by).agg((F.sum("_right") >= F.max("n")).alias("train_ok"))
    return got.drop("_right").join(fit, by)


def _summary_sql(by=("target",), grid="", where=""):
    keys = ", ".join(by)
    return (_with(O.steps_cte(MODEL_ADAPTER), O.fleet_labelled_ctes(K, sampling.FIRST_FOREIGN_ID),
                  f"sp AS (SELECT target, CAST(label AS DOUBLE) AS label, CASE WHEN {_SPLIT_KEY} < "
                  f"{O.u32_threshold(0.7)} THEN 'train' ELSE 'test' END AS split FROM labelled{where})")
            + f"SELECT {keys}, split, label, count(*) AS n, CAST(0 AS BIGINT) AS n_outside, TRUE AS train_ok "
            f"FROM sp{grid} GROUP BY {keys}, split, label")


_ONE = f" WHERE target = {TARGET}"
_GRID = (", (SELECT unnest([1, 2, 3, 4]) AS version) v, (SELECT unnest([5, 25, 45, 65, 85]) AS num_trees) t")


@query("label_index", _with(EV, "trips AS (SELECT DISTINCT driver, trip FROM steps)",
                            f"sd AS ({_M2_SQL.format(k=sampling.K_DRIVERS)})") +
       f"SELECT driver, trip, label, CAST(label AS DOUBLE) AS indexedLabel FROM ("
       f"SELECT driver, trip, 1 AS label FROM trips WHERE driver = {TARGET} UNION ALL "
       "SELECT driver, trip, 0 AS label FROM trips WHERE driver IN (SELECT driver FROM sd) AND "
       f"{O.h(repr(str(O.SEED)), 'driver', 'trip')} < {O.u32_threshold(sampling.TRIP_FRACTION)})")
def label_index(spark, sf_dir):
    return models.label_index(sampling.labelled_trips(steps(spark, sf_dir), TARGET))


@query("gbt_minimal", _summary_sql(where=_ONE))
def gbt_minimal(spark, sf_dir):
    data, _ = _target_set(spark, sf_dir, 1)
    return _summary(models.gbt_minimal(data, keep=("target", "driver", "trip", "slot")), ["target"])


@query("gbt_fit_score", _summary_sql(where=_ONE))
def gbt_fit_score(spark, sf_dir):
    data, names = _target_set(spark, sf_dir, 2)
    return _summary(models.fit_score(data, names, models.gbt_pipeline(25),
                                     keep=("target", "driver", "trip", "slot")), ["target"])


@query("logistic_fit_score", _summary_sql(where=_ONE))
def logistic_fit_score(spark, sf_dir):
    data, names = _target_set(spark, sf_dir, 1)
    return _summary(models.fit_score(data, names, models.logistic_pipeline(),
                                     keep=("target", "driver", "trip", "slot")), ["target"])


@query("fleet_logistic", _summary_sql().replace("TRUE AS train_ok", "TRUE AS optimal"))
def fleet_logistic(spark, sf_dir):
    """The logistic model of every driver.  ``optimal``: hardly any slope of the (convex) training loss is
    left, so no other coefficients have a clearly smaller loss on the target's training rows."""
    split = lambda df: sampling.split_train_test(df, cols=("target", "driver", "trip", "slot"))
    data, names, labelled = _fleet_set(spark, sf_dir, 1, written=lambda df: materialize(split(df), "fleet-trips"))
    got = models.fleet_logistic(data, names, max_iter=300, tol=1e-9, labelled=labelled)
    # the counts and the sums of the slopes in one pass: the scored rows with their features are not written
    sums = materialize(_counted(got.scored, ["target"], *models.slope_sums(len(names))), "logistic-sums")
    flags = models.slopes(sums.where("split = 'train'"), ["target"]).select(
        "target", (F.col("slope") < OPTIMAL_SLOPE).alias("optimal"))
    return sums.select("target", "split", "label", "n", "n_outside").join(flags, "target")


OPTIMAL_SLOPE = 0.02  # of the mean loss, in units of the feature's mean size: what 300 rounds reach and more


def gbt_sweep_scores(spark, sf_dir, versions=(1, 2, 3, 4), trees=tuple(models.GBT_TREES),
                     parallel: int = 8) -> DataFrame:
    """Versions x tree counts for one driver with Spark ML.  The labelled trips are drawn and their steps read
    from the table once; each version's training set is built and written once; the fits of the grid run
    concurrently from a thread pool."""
    st = steps(spark, sf_dir, MODEL_ADAPTER)
    labelled = _target_trips(st)
    st = materialize(st.join(labelled.select("driver", "trip").distinct(), ["driver", "trip"], "left_semi"), "sweep-steps")
    sets = {}
    for v in versions:
        data, names = _with_features(st, labelled, v)
        sets[v] = (materialize(data, f"sweep-v{v}"), names)

    def one(args):
        v, n = args
        data, names = sets[v]
        scored = models.fit_score(data, names, models.gbt_pipeline(n),
                                  keep=("target", "driver", "trip", "slot"))
        return materialize(scored.withColumn("version", F.lit(v)).withColumn("num_trees", F.lit(n)), "sweep-scores")
    grid = [(v, n) for v in versions for n in trees]
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        parts = list(pool.map(one, grid))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("gbt_sweep", _summary_sql(("target", "version", "num_trees"), _GRID, _ONE))
def gbt_sweep(spark, sf_dir):
    return _summary(gbt_sweep_scores(spark, sf_dir), ["target", "version", "num_trees"])


def _fleet_set(spark, sf_dir, version, k=K, sampler="pairs", written=materialize):
    """Every target's labelled trips with the version's features; their names; the labelled trips, ``written`` once."""
    st = steps(spark, sf_dir, MODEL_ADAPTER)
    labelled = written(fleet.labelled_trips(sampling.fleet_index(st), k, sampler=sampler))
    data, names = fleet.fleet_training_set(st, version, k, labelled=labelled)
    return data, names, labelled


def _fleet_scores(spark, sf_dir, version, *of, **options):
    data, names, labelled = _fleet_set(spark, sf_dir, version, *of)
    data = sampling.split_train_test(data, cols=("target", "driver", "trip", "slot"))
    return fleet.fit_predict_fleet(data, names, labelled=labelled, **options)


@query("fleet_fit_score", _summary_sql())
def fleet_fit_score(spark, sf_dir):
    return _summary(_fleet_scores(spark, sf_dir, 1, n_trees=25), ["target"])


@query("fleet_fit_entities", "WITH x AS (SELECT 1), " + _with(
    O.steps_cte(MODEL_ADAPTER), O.fleet_entities_ctes(K_ENTITIES, 40 * K_ENTITIES)).removeprefix("WITH ") +
       "SELECT driver AS target, count(DISTINCT trip) AS n_own, CAST(0 AS BIGINT) AS n_outside FROM steps GROUP BY driver")
def fleet_fit_entities(spark, sf_dir):
    """The main sampler (drivers without replacement, then a share of their trips) with a fit on it."""
    scored = _fleet_scores(spark, sf_dir, 1, K_ENTITIES, "entities", n_trees=25)
    return scored.groupBy("target").agg(
        F.count(F.when(F.col("label") == 1, 1)).alias("n_own"),
        F.count(F.when(F.col("prediction").isNull() | ~F.col("prediction").isin(0.0, 1.0), 1)).alias("n_outside"))


_SWEEP_COUNTS = ", ".join(f"{_cnt(f'split = {s!r} AND label = {y}')} AS {s}_{n}_count"
                          for s in ("test", "train") for y, n in ((1, "positive"), (0, "negative")))


@query("fleet_sweep", _summary_sql(where="").split("SELECT target, split, label, count(*)")[0] +
       "SELECT target AS driver, version, num_trees, 0 AS heldout_set, " + _SWEEP_COUNTS +
       f", TRUE AS train_ok, TRUE AS metrics_ok FROM sp{_GRID} GROUP BY target, version, num_trees")
def fleet_sweep(spark, sf_dir):
    """Versions x tree counts for every driver, appended to the CSV metrics sink: 20 records each.

    Trips are labelled once for all versions.  A version's input is written once and fitted once; smaller tree
    counts are prefixes.  The versions run concurrently; their records are appended one after the other.  Checked of
    each record read back: every model is at least as right on its training rows as always naming the larger
    class, and the accuracies are those of the false positives and negatives.
    """
    path = shared_dir(spark, "fleet-sweep")
    st = steps(spark, sf_dir, MODEL_ADAPTER)
    labelled = materialize(sampling.fleet_labelled_trips(sampling.fleet_index(st), K), "sweep-trips")

    def one(v):
        data, names = fleet.fleet_training_set(st, v, K, labelled=labelled)
        data = sampling.split_train_test(data, cols=("target", "driver", "trip", "slot"))
        scored = fleet.fit_predict_fleet(data, names, counts=tuple(models.GBT_TREES), labelled=labelled)
        rec = (scored.drop("driver").withColumnRenamed("target", "driver")
               .withColumn("version", F.lit(float(v))).withColumn("heldout_set", F.lit(0)))
        return materialize(evaluation.metrics_record(rec), "sweep-records")

    versions = (2, 4, 1, 3)  # the wide ones first
    with ThreadPoolExecutor(max_workers=len(versions)) as pool:
        for records in pool.map(one, versions):
            files.write_metrics(records, path, fmt="csv")
    back = files.read_metrics(spark, path, fmt="csv")
    return back.select(F.col("driver").cast("bigint").alias("driver"), F.col("version").cast("int").alias("version"),
                       F.col("num_trees").cast("int").alias("num_trees"),
                       F.col("heldout_set").cast("int").alias("heldout_set"),
                       *[F.col(f"{s}_{n}_count").cast("bigint").alias(f"{s}_{n}_count")
                         for s in ("test", "train") for n in ("positive", "negative")],
                       _train_ok().alias("train_ok"), (_accuracy_ok("test") & _accuracy_ok("train")).alias("metrics_ok"))


def _train_ok():
    """Whether a record's training accuracy (two decimals) is at least the share of the larger class."""
    larger = F.greatest("train_positive_count", "train_negative_count") / (
        F.col("train_positive_count") + F.col("train_negative_count"))
    return F.col("train_accuracy") >= larger - 0.005


def _accuracy_ok(split):
    """Whether a record's accuracy (two decimals; null without rows) follows from its wrong predictions."""
    rows = F.col(f"{split}_positive_count") + F.col(f"{split}_negative_count")
    right = 1 - (F.col(f"{split}_fp_count") + F.col(f"{split}_fn_count")) / F.nullif(rows, F.lit(0))
    return F.when(rows > 0, F.abs(F.col(f"{split}_accuracy") - right) < 0.0051).otherwise(
        F.col(f"{split}_accuracy").isNull())


_FOLD_KEY = O.h(repr(str(O.SEED)), "target", "driver", "trip", "slot")


@query("fleet_kfold", _with(O.steps_cte(MODEL_ADAPTER), O.fleet_labelled_ctes(K, sampling.FIRST_FOREIGN_ID),
                            f"folded AS (SELECT target, label, {_FOLD_KEY} % 5 AS fold FROM labelled)",
                            "sp AS (SELECT target, label, CAST(h AS INTEGER) AS heldout_set, CASE WHEN fold = h THEN 'test' "
                            "ELSE 'train' END AS split FROM folded, (SELECT unnest(range(0, 5)) AS h))") +
       f"SELECT target AS driver, CAST(1.0 AS DOUBLE) AS version, 25 AS num_trees, heldout_set, {_SWEEP_COUNTS}, "
       "TRUE AS train_ok FROM sp GROUP BY target, heldout_set")
def fleet_kfold(spark, sf_dir):
    """Five models per driver, each held-out row scored by the one that did not see it; a metrics record of each."""
    data, names, labelled = _fleet_set(spark, sf_dir, 1)
    scored = (fleet.fit_predict_folds(data, names, labelled=labelled).drop("driver").withColumnRenamed("target", "driver")
              .withColumn("version", F.lit(1.0)).withColumn("num_trees", F.lit(25)))
    record = evaluation.metrics_record(scored)
    return record.select("driver", "version", "num_trees", "heldout_set",
                         *[f"{s}_{n}_count" for s in ("test", "train") for n in ("positive", "negative")],
                         _train_ok().alias("train_ok"))


@query("foreign_trips", _with(O.steps_cte(MODEL_ADAPTER)) +
       "SELECT driver AS target, half, CAST(CASE WHEN half = 1 THEN (n + 1) // 2 ELSE n // 2 END AS BIGINT) AS n, "
       "CAST(0 AS BIGINT) AS n_outside, CAST(0 AS BIGINT) AS n_mismatch FROM "
       "(SELECT driver, count(DISTINCT trip) AS n FROM steps GROUP BY driver), "
       "(SELECT unnest([1, 2]) AS half) WHERE half = 1 OR n > 1")
def foreign_trips(spark, sf_dir):
    data, names, labelled = _fleet_set(spark, sf_dir, 1, written=fleet.halves)
    got = fleet.foreign_trips(data, names, n_trees=25, labelled=labelled)
    return got.groupBy("target", "half").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("prediction").isNull() | ~F.col("prediction").isin(0.0, 1.0), 1)).alias("n_outside"),
        F.count(F.when(F.col("flagged") != (F.col("prediction") == 0.0), 1)).alias("n_mismatch"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
