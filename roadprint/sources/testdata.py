"""Adapters from the shared test tables onto the ``steps`` model.

``events``   : driver = user_id, trip = event_type, order = (ts, event_id),
               x = value, y = props.k
``lineitem`` : driver = l_suppkey, trip = returnflag || linestatus,
               order = (l_shipdate, l_orderkey, l_partkey, l_linenumber),
               x = l_extendedprice / 1000, y = l_quantity

The keys are renamed to ``driver``/``trip`` before ``step`` is numbered, so
the numbering window and every later trip window share one partitioning and
Spark plans a single Exchange from the scan to the trip aggregates.  Trips above
``HOT_TRIP_ROWS`` rows are numbered by dense positions instead of a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadprint.functions.columns import HOT_TRIP_ROWS
from roadprint.operators.segments import number_rows

LINE_ORDER = ["l_shipdate", "l_orderkey", "l_partkey", "l_linenumber"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("driver"),
        F.col("event_type").alias("trip"),
        "ts", "event_id",
        F.col("value").alias("x"),
        F.get_json_object("props", "$.k").cast("double").alias("y"),
    )
    return number_rows(ev, ["ts", "event_id"]).select("driver", "trip", "step", "x", "y")


def lineitem_steps(spark: SparkSession, sf_dir: str, hot_rows: int | None = HOT_TRIP_ROWS) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("driver"),
        F.concat("l_returnflag", "l_linestatus").alias("trip"),
        "l_shipdate", "l_orderkey", "l_partkey", "l_linenumber",
        (F.col("l_extendedprice") / 1000.0).alias("x"),
        F.col("l_quantity").alias("y"),
    )
    return number_rows(li, LINE_ORDER, hot_rows=hot_rows).select("driver", "trip", "step", "x", "y")


def monthly_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many trips per driver: a supplier's line items of one ship month are a trip."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("driver"), F.date_format("l_shipdate", "yyyy-MM").alias("trip"),
        "l_shipdate", "l_orderkey", "l_partkey", "l_linenumber",
        (F.col("l_extendedprice") / 1000.0).alias("x"), F.col("l_quantity").alias("y"))
    return number_rows(li, LINE_ORDER).select("driver", "trip", "step", "x", "y")


ADAPTERS = {"events": events_steps, "lineitem": lineitem_steps, "monthly": monthly_steps}

# Same adapters as SQL text, for the DuckDB oracle.
EVENTS_STEPS_SQL = """
SELECT user_id AS driver, event_type AS trip,
       CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS BIGINT) AS step,
       value AS x,
       CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS DOUBLE) AS y
FROM events"""

LINEITEM_STEPS_SQL = """
SELECT l_suppkey AS driver, l_returnflag || l_linestatus AS trip,
       CAST(row_number() OVER (PARTITION BY l_suppkey, l_returnflag || l_linestatus
            ORDER BY l_shipdate, l_orderkey, l_partkey, l_linenumber) AS BIGINT) AS step,
       l_extendedprice / 1000.0 AS x,
       l_quantity AS y
FROM lineitem"""

MONTHLY_STEPS_SQL = LINEITEM_STEPS_SQL.replace("l_returnflag || l_linestatus", "strftime(l_shipdate, '%Y-%m')")

ADAPTERS_SQL = {"events": EVENTS_STEPS_SQL, "lineitem": LINEITEM_STEPS_SQL, "monthly": MONTHLY_STEPS_SQL}
