"""Column expressions shared by the operators.

All of these are built-in Spark expressions (JVM side, inside whole-stage
codegen); none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["driver", "trip"]

# The percentile levels of the trip features, 5, 10, ..., 95 percent.
PERCENT_LEVELS = [k / 20 for k in range(1, 20)]
PERCENT_NAMES = [f"p{round(p * 100):02d}" for p in PERCENT_LEVELS]

# Order of the moving average, stop-speed threshold (m/s),
# metres-per-second to miles-per-hour factor and the speed band width (mph).
MA_ORDER = 10
STOP_SPEED = 0.5
MPS_TO_MPH = 2.23694
BAND_MPH = 15.0

U32 = 4294967296  # 2**32

# Trips with more rows than this are processed in row segments (operators.segments).
HOT_TRIP_ROWS = 2_000_000


def trip_window(keys=None, order: str = "step"):
    return Window.partitionBy(*(keys or KEYS)).orderBy(order)


def lag0(c, w, n: int = 1) -> Column:
    """Value ``n`` rows back in the trip, 0.0 before the first row."""
    return F.lag(c, n, 0.0).over(w)


def u32(*parts) -> Column:
    """Deterministic uniform integer in [0, 2**32) from the md5 of the parts.

    The same number comes out of any SQL engine with ``md5`` (the first 8 hex
    digits read as an integer), which is what lets the sampling operators be
    reproduced outside Spark.
    """
    cols = [F.col(p) if isinstance(p, str) else p if isinstance(p, Column) else F.lit(p)
            for p in parts]  # strings name columns; wrap literal text in F.lit
    text = F.concat_ws("|", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def q4(c) -> Column:
    """Half-up rounding to 4 decimals with plain IEEE arithmetic (engine-neutral)."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.floor(c * 10000.0 + 0.5) / 10000.0).cast("double")


def ratio2(num, den) -> Column:
    """``num / den`` rounded half-up to 2 decimals, exactly, from integer counts."""
    num = (F.col(num) if isinstance(num, str) else num).cast("bigint")
    den = (F.col(den) if isinstance(den, str) else den).cast("bigint")
    top, bottom = num * 200 + den, den * 2
    whole = (top - F.pmod(top, bottom)) / bottom  # exact: top - pmod is a multiple
    return F.when(den > 0, whole / 100.0).cast("double")


def safe_div(num, den) -> Column:
    return F.when(den != 0, num / den)


def dense_index(df: DataFrame, order_cols: list[str], out: str = "pos",
                num_partitions: int | None = None) -> DataFrame:
    return dense_index_total(df, order_cols, out, num_partitions)[0]


def _ranged(df: DataFrame, order_cols: list, name: str, num_partitions: int | None) -> DataFrame:
    """``df`` written in the order of ``order_cols``: partition ``_pid``, place ``_loc`` in it.

    The range bounds are splitters sampled from the order columns.  Written once, so that every
    later pass sees the same bounds and a lost executor recomputes nothing upstream.
    """
    from roadprint.session import shared_dir
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark, name)
    (df.repartitionByRange(n, *order_cols)
       .sortWithinPartitions(*order_cols)
       .withColumn("_pid", F.spark_partition_id())
       .withColumn("_loc", F.monotonically_increasing_id()
                   - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
       .write.parquet(path))
    return spark.read.parquet(path)


def dense_index_total(df: DataFrame, order_cols: list[str], out: str = "pos",
                      num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """0-based position of every row in the total order of ``order_cols``.

    Built without a single-task sort: the rows are range-partitioned, sorted
    inside each partition, numbered locally, and shifted by the sizes of the
    earlier partitions, a joined table of one row per partition.  Rows that agree in all
    ``order_cols`` stay together in a partition: name columns that tell rows apart, or
    count equal rows first and use ``cumulative_counts``.  Returns the indexed rows and the
    total row count.
    """
    ranged = _ranged(df, order_cols, "dense-index", num_partitions)
    # one row per partition: numbered by a running sum, then joined back
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out_rows = (ranged.join(F.broadcast(offsets), "_pid")  # at most n rows
                .withColumn(out, (F.col("_off") + F.col("_loc")).cast("bigint")).drop("_pid", "_loc", "_off"))
    return out_rows, ranged.count()


TASK_ROWS = 250_000  # rows of a large table that one task sorts


def task_count(rows: int) -> int:
    """Tasks for so many rows: the memory of one stays the same as a table grows."""
    return max(1, -(-rows // TASK_ROWS))


def spread(df: DataFrame, rows: int, *cols: str) -> DataFrame:
    """``df`` of ``rows`` rows dealt by ``cols``, if it is large: Spark would gather tasks up to 64 MB of compressed rows."""
    return df if rows <= 8 * TASK_ROWS else df.repartition(task_count(rows), *cols)


def key_changes():
    """For Arrow in tasks, which may lack this package: whether the values of two arrays differ, row by row; null and NaN are
    values like others."""
    def changes(before, after):
        import pyarrow as pa
        import pyarrow.compute as pc
        differ = pc.fill_null(pc.not_equal(before, after), False)
        if pa.types.is_floating(before.type):  # NaN is one value
            differ = pc.and_(differ, pc.invert(pc.fill_null(pc.and_(pc.is_nan(before), pc.is_nan(after)), False)))
        return pc.or_(differ, pc.xor(pc.is_null(before), pc.is_null(after))).to_numpy(zero_copy_only=False)
    return changes


def _number_runs(keys: list[str]):
    """For ``mapInArrow`` on sorted partitions: ``_run``, the rows of its keys before a row, in its partition; ``_open``,
    whether its keys are the first of the partition; ``_edge``, whether it is the partition's first or last row."""
    changes = key_changes()

    def number(batches):
        import numpy as np
        import pyarrow as pa
        last, run, open_, held = None, 0, True, None  # last: the keys of the row before, as arrays of one value

        def out(batch, *more):
            return pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, more)],
                                              [*batch.schema.names, "_run", "_open", "_edge"])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            new, edge = np.zeros(n, bool), np.zeros(n, bool)
            for j, k in enumerate(key):
                new[1:] |= changes(k.slice(0, n - 1), k.slice(1))
                if last is not None:
                    new[:1] |= changes(last[j], k.slice(0, 1))
            edge[0] = last is None
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))  # of the run; -1: it began in an earlier batch
            runs, first = np.where(start >= 0, at - start, at + run), (start < 0) & open_
            last, run, open_ = [k.slice(n - 1) for k in key], int(runs[-1]) + 1, bool(first[-1])
            if held:
                yield out(*held)
            held = batch, runs, first, edge
        if held:
            edge[-1] = True
            yield out(*held)
    return number


def run_numbers(df: DataFrame, keys: list[str], order: list[str], out: str, num_partitions: int | None = None) -> DataFrame:
    """1-based number ``out`` of every row among those of its ``keys``, in the order given.

    Rows are sorted over ranges of keys and order, and a pass over each range numbers the rows of every key from
    where it begins there.  Only the first keys of a range can begin in an earlier one; the rows they have there come
    from a table of one row per range.  So keys of any size are spread over tasks, and nothing is joined by key.
    """
    from roadprint.session import shared_dir
    spark = df.sparkSession
    path = shared_dir(spark, "run-numbers")
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*df.schema.fields, T.StructField("_run", T.LongType()), T.StructField("_open", T.BooleanType()),
                           T.StructField("_edge", T.BooleanType())])
    (df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
       .mapInArrow(_number_runs(keys), schema).withColumn("_pid", F.spark_partition_id()).write.parquet(path))
    ranged = spark.read.parquet(path)
    key = F.struct(*keys)
    ends = ranged.where("_edge").groupBy("_pid").agg(
        F.min_by(key, F.struct(~F.col("_open"), "_run")).alias("_first"),
        F.max_by(F.struct(key.alias("key"), (F.col("_run") + 1).alias("n")), F.struct(~F.col("_open"), "_run")).alias("_last"))
    parts = Window.orderBy("_pid")  # a row per range
    # ranges with the same last keys follow each other: their rows of it are a running sum from where they begin
    begins = ~F.col("_last.key").eqNullSafe(F.lag("_last.key").over(parts))
    ends = ends.withColumn("_cum", F.sum("_last.n").over(parts)).withColumn("_begins", begins)
    ends = ends.withColumn("_sum", F.col("_cum") - F.max(F.when(F.col("_begins"), F.col("_cum") - F.col("_last.n"))).over(parts))
    offsets = ends.select("_pid", F.when(F.lag("_last.key").over(parts).eqNullSafe(F.col("_first")),
                                         F.lag("_sum").over(parts)).alias("_off")).where("_off is not null")
    return (ranged.join(F.broadcast(offsets), "_pid", "left")
            .withColumn(out, F.col("_run") + 1 + F.when(F.col("_open"), F.coalesce("_off", F.lit(0))).otherwise(0))
            .drop("_pid", "_run", "_open", "_edge", "_off"))


CHUNK_ROWS = 65_536  # rows of a range partition whose counts are summed up together


def cumulative_counts(df: DataFrame, order_cols: list[str], count: str, out: str = "before",
                      num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """``out``: the sum of ``count`` over all earlier rows in the order of ``order_cols``; and the total.

    For tables with one row per distinct value and its number of occurrences: equal values are one
    row, so ranges of any table split evenly, however often a value occurs.  Running sums are local to
    chunks of a range partition; chunk and partition totals are summed up over small tables.
    """
    return cumulative_counts_largest(df, order_cols, count, out, num_partitions)[:2]


def cumulative_counts_largest(df: DataFrame, order_cols: list[str], count: str, out: str = "before",
                              num_partitions: int | None = None) -> tuple[DataFrame, int, int]:
    """``cumulative_counts`` with the largest ``count`` of a row besides."""
    chunked = _ranged(df, order_cols, "cumulative-counts", num_partitions).withColumn(
        "_chunk", F.floor(F.col("_loc") / CHUNK_ROWS))
    past = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunks = chunked.groupBy("_pid", "_chunk").agg(F.sum(count).alias("_n"), F.max(count).alias("_max"))
    parts = chunks.groupBy("_pid").agg(F.sum("_n").alias("_n"), F.max("_max").alias("_max"))
    starts = parts.select("_pid", past(Window.orderBy("_pid")).alias("_part_off"))  # a row per partition
    offsets = (chunks.withColumn("_chunk_off", past(Window.partitionBy("_pid").orderBy("_chunk")))
               .join(F.broadcast(starts), "_pid")
               .select("_pid", "_chunk", (F.col("_part_off") + F.col("_chunk_off")).alias("_off")))
    inside = F.sum(count).over(Window.partitionBy("_pid", "_chunk").orderBy("_loc")
                               .rowsBetween(Window.unboundedPreceding, -1))
    rows = (chunked.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(offsets, ["_pid", "_chunk"])
            .withColumn(out, (F.col("_off") + F.col("_inside")).cast("bigint"))
            .drop("_pid", "_chunk", "_loc", "_off", "_inside"))
    total, largest = parts.agg(F.sum("_n"), F.max("_max")).first()
    return rows, total or 0, largest or 0


BUCKET = 64  # ranks of the finest bucket of find_ranks
COARSER = 16  # each coarser level of buckets is so many times as wide


def find_ranks(counted: DataFrame, wanted: DataFrame, rank: str, before: str, count: str,
               largest: int) -> DataFrame:
    """``wanted`` joined to the row of ``counted`` that covers its ``rank``: before <= rank < before + count.

    An equi-join: a row lies in the buckets that it touches on the level whose buckets are at least as
    wide as its count, two at most; a rank looks on every level up to that of the ``largest`` count (or any number
    above it), which is the finest one alone where no value occurs often.  A bucket holds ``BUCKET`` rows at most,
    so a value that makes up most of a table is one row in two buckets.
    """
    widths = [BUCKET]
    while widths[-1] < largest:
        widths.append(widths[-1] * COARSER)
    level = F.lit(len(widths) - 1)
    for k in range(len(widths) - 2, -1, -1):
        level = F.when(F.col(count) <= widths[k], F.lit(k)).otherwise(level)
    width = F.element_at(F.array(*map(F.lit, widths)), F.col("_level") + 1).cast("bigint")
    at = lambda c: F.floor(c / width).cast("bigint")
    rows = counted.withColumn("_level", level).withColumn("_bucket", F.explode(F.array_distinct(F.array(
        at(F.col(before)), at(F.col(before) + F.col(count) - 1)))))
    asked = wanted.withColumn("_level", F.explode(F.array(*map(F.lit, range(len(widths)))))).withColumn(
        "_bucket", at(F.col(rank)))
    # both are exploded, which the planner does not count: it would broadcast one of them
    return (asked.hint("merge").join(rows, ["_level", "_bucket"])
            .where((F.col(rank) >= F.col(before)) & (F.col(rank) < F.col(before) + F.col(count)))
            .drop("_level", "_bucket"))


def bounded(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Broadcast hint for a narrow table that is counted first; a longer one is joined plainly."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
