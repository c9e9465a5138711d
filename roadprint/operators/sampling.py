"""Sampling foreign trips and labelling trip sets.

Randomness is an md5 of (seed, keys) read as a 32-bit integer, so every draw
is reproducible, independent of partitioning, and the same in any SQL engine.

Drawing "a random driver, then a random trip of it" is two equi-joins on
dense positions (0..D-1 over drivers, 0..T-1 over trips sorted by driver and
trip); no cross join of targets with trips is ever formed, and a driver with
a third of all trips is spread over many tasks because trips are looked up by
their own position, not grouped by driver.

The planner sizes an exploded table as if it still had the rows it was exploded from, and would
broadcast all draws of a fleet through the driver: joins of draws carry a merge hint.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadprint.functions.columns import U32, dense_index, dense_index_total, u32

DEFAULT_SEED = 42
K_TRIPS = 200            # Fixed value: foreign trips drawn per target.
K_DRIVERS = 200          # Fixed value: drivers drawn without replacement per target.
TRIP_FRACTION = 0.0055   # Fixed value: Bernoulli fraction of the sampled drivers' trips.
FIRST_FOREIGN_ID = 201   # Fixed value: own trips are numbered below this id.


@dataclass
class FleetIndex:
    trips: DataFrame    # driver, trip, gpos
    drivers: DataFrame  # driver, start, n_trips, dpos
    n_drivers: int


def trip_catalogue(df: DataFrame) -> DataFrame:
    """Distinct (driver, trip) keys."""
    return df.select("driver", "trip").distinct()


def fleet_index(df: DataFrame) -> FleetIndex:
    """Dense positions of trips (by driver, trip) and of drivers (by driver)."""
    trips = dense_index(trip_catalogue(df), ["driver", "trip"], "gpos")
    drivers = trips.groupBy("driver").agg(F.min("gpos").alias("start"),
                                          F.count(F.lit(1)).alias("n_trips"))
    drivers, n = dense_index_total(drivers, ["driver"], "dpos")
    return FleetIndex(trips, drivers, n)


def sample_pairs(idx: FleetIndex, k: int = K_TRIPS, seed: int = DEFAULT_SEED,
                 targets=None) -> DataFrame:
    """M1 / M8: ``k`` (driver, trip) draws with replacement for every target.

    The partner is uniform over the other drivers and is never the target:
    ``(target_pos + 1 + h % (D - 1)) % D``; the trip is uniform over the
    partner's trips.  Returns target, slot, driver, trip.
    """
    return _drawn_pairs(idx, k, seed, targets).drop("n_own")


def _drawn_pairs(idx: FleetIndex, k: int, seed: int, targets=None) -> DataFrame:
    """``sample_pairs`` with ``n_own``, the number of the target's own trips."""
    d = idx.n_drivers
    tg = idx.drivers.select(F.col("driver").alias("target"), F.col("dpos").alias("tpos"), F.col("n_trips").alias("n_own"))
    if targets is not None:
        tg = tg.where(F.col("target").isin(list(targets)))
    if d < 2:
        return tg.select("target", F.lit(0).cast("bigint").alias("slot"), F.col("target").alias("driver"),
                         F.lit(None).cast("string").alias("trip"), "n_own").limit(0)
    slots = tg.select("target", "tpos", "n_own",
                      F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint")))
                      .alias("slot"))
    slots = slots.withColumn(
        "pdpos", (F.col("tpos") + 1 + u32(seed, "target", "slot", F.lit("d")) % (d - 1)) % d)
    partners = idx.drivers.select(F.col("dpos").alias("pdpos"), "start", "n_trips")
    picked = (slots.hint("merge").join(partners, "pdpos")
                   .withColumn("gpos", F.col("start") + u32(seed, "target", "slot", F.lit("t")) % F.col("n_trips")))
    return (picked.hint("merge").join(idx.trips, "gpos")
                  .select("target", "slot", "driver", "trip", "n_own"))


def sample_entities(catalogue: DataFrame, target, k: int = K_DRIVERS,
                    seed: int = DEFAULT_SEED) -> DataFrame:
    """M2 / M7: ``k`` drivers other than ``target`` without replacement (a top-k by hash)."""
    pool = pool_without_target(catalogue, target)
    h = u32(seed, F.lit(str(target)), "driver")
    return (pool.withColumn("_h", h).orderBy("_h", "driver").limit(k)
                .select(F.lit(target).cast("bigint").alias("target"), "driver"))


def sample_entities_fleet(idx: FleetIndex, k: int = K_DRIVERS, seed: int = DEFAULT_SEED,
                          draws_per_round: int | None = None) -> DataFrame:
    """M2 for every target: ``k`` distinct other drivers, uniform over k-subsets.

    Draws partners with replacement in rounds of slots and keeps each target's
    first ``k`` distinct partners by first slot (sequential sampling with
    rejection of repeats).  Another round is drawn only while some target has
    fewer than ``min(k, D - 1)`` distinct partners, so the result is exact;
    the kept set does not depend on how many extra slots were drawn.  Each
    target's window holds only its own draws.  Returns target, driver.
    """
    d = idx.n_drivers
    k_eff = min(k, d - 1)
    if k_eff <= 0:
        return idx.drivers.select(F.col("driver").alias("target"), "driver").limit(0)
    m = draws_per_round or 2 * k_eff
    tg = idx.drivers.select(F.col("driver").alias("target"), F.col("dpos").alias("tpos"))
    partners = idx.drivers.select(F.col("dpos").alias("pdpos"), "driver")
    firsts, rounds = None, 0
    while True:
        lo, hi = rounds * m, (rounds + 1) * m - 1
        slots = tg.select("target", "tpos",
                          F.explode(F.sequence(F.lit(lo).cast("bigint"), F.lit(hi).cast("bigint")))
                          .alias("slot"))
        cand = (slots.withColumn("pdpos", (F.col("tpos") + 1 + u32(seed, "target", "slot", F.lit("e"))
                                           % (d - 1)) % d)
                     .hint("merge").join(partners, "pdpos").select("target", "driver", "slot"))
        if firsts is not None:
            cand = cand.unionByName(firsts)
        from roadprint.session import materialize
        firsts = materialize(cand.groupBy("target", "driver").agg(F.min("slot").alias("slot")),
                             "entity-draws")
        rounds += 1
        short = firsts.groupBy("target").count().where(F.col("count") < k_eff)
        if short.limit(1).count() == 0:
            break
    w = Window.partitionBy("target").orderBy("slot")
    return (firsts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k_eff)
                  .select("target", "driver"))


SKIP_BLOCK = 1024  # positions that one chain of skips covers


def bernoulli_positions(sets: DataFrame, n: str, fraction: float, seed: int, *keys: str) -> DataFrame:
    """``sets`` with ``pos``: each of the positions 0..n-1 of a set, kept with probability ``fraction``.

    Geometric skips: between kept positions lie floor(ln u / ln(1 - fraction)) others, so the work follows the
    kept positions.  A chain covers ``SKIP_BLOCK`` positions and starts afresh in the next block (skips have no
    memory, so the law is the same), and is followed as an array for a few links more than expected; the
    chains that go on after those are followed to the end of their block.
    """
    if not 0.0 < fraction < 1.0:
        full = sets.withColumn("pos", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))).where(F.col(n) > 0)
        return full if fraction >= 1.0 else full.limit(0)
    blocks = (sets.where(F.col(n) > 0)
              .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(n) - 1) / SKIP_BLOCK))))
              .withColumn("_size", F.least(F.lit(SKIP_BLOCK).cast("bigint"), F.col(n) - F.col("_block") * SKIP_BLOCK)))
    scale = F.lit(math.log1p(-fraction))

    def skip(i):
        u = (u32(seed, *keys, "_block", i, F.lit("g")) + F.lit(0.5)) / F.lit(float(U32))
        return F.floor(F.log(u) / scale).cast("bigint")

    def chain(acc, i):
        more = acc["at"] < F.col("_size")
        link = lambda at: F.struct(at.alias("at"), F.when(at < F.col("_size"), F.concat(acc["kept"], F.array(at)))
                                   .otherwise(acc["kept"]).alias("kept"))
        # an array of one value: the skip is computed once, then used in several places
        return F.when(more, F.get(F.transform(F.array(acc["at"] + 1 + skip(i)), link), F.lit(0))).otherwise(acc)

    # most blocks of a small fraction hold nothing: their first skip leads past their end
    blocks = blocks.withColumn("_first", skip(F.lit(1))).where(F.col("_first") < F.col("_size"))
    start = F.struct(F.col("_first").alias("at"), F.array("_first").alias("kept"))
    links = (F.floor(F.col("_size") * fraction * 2) + 4).cast("int")
    follow = lambda n_links: F.aggregate(F.sequence(F.lit(2), n_links), start, chain)
    short = blocks.withColumn("_chain", follow(links))
    open_ = F.col("_chain.at") < F.col("_size")
    kept = short.withColumn("_chain", F.when(open_, follow(F.col("_size").cast("int") + 1)).otherwise(F.col("_chain")))
    # outer: every chain has a position; for a plain explode Spark would compute the chains in a filter before it as well
    return (kept.withColumn("_at", F.explode_outer("_chain.kept"))
            .withColumn("pos", F.col("_block") * SKIP_BLOCK + F.col("_at")).drop("_block", "_size", "_first", "_chain", "_at"))


def fleet_sampled_trips(idx: FleetIndex, k: int = K_DRIVERS, fraction: float = TRIP_FRACTION,
                        seed: int = DEFAULT_SEED) -> DataFrame:
    """M5 for every target: own trips (label 1) + a Bernoulli sample of the trips of
    ``k`` drivers drawn without replacement (label 0), drawn independently per target.

    The kept positions of each drawn driver's trips come from geometric skips over its dense
    trip index, and an equi-join on positions fetches those trips only: no target meets
    all trips of its drivers, and a driver with many trips is no hot key.
    Columns: target, driver, trip, label.
    """
    drawn = sample_entities_fleet(idx, k, seed).join(idx.drivers.select("driver", "start", "n_trips"), "driver")
    picked = bernoulli_positions(drawn, "n_trips", fraction, seed, "target", "driver")
    neg = (picked.select("target", (F.col("start") + F.col("pos")).alias("gpos")).hint("merge").join(idx.trips, "gpos")
           .select("target", "driver", "trip", F.lit(0).alias("label")))
    own = idx.trips.select(F.col("driver").alias("target"), "driver", "trip", F.lit(1).alias("label"))
    return own.unionByName(neg)


def bernoulli(df: DataFrame, fraction: float = TRIP_FRACTION, seed: int = DEFAULT_SEED,
              cols=("driver", "trip")) -> DataFrame:
    """M3: keep each row with probability ``fraction`` (reproducible md5 draw)."""
    return df.where(u32(seed, *cols) < int(fraction * U32))


def pool_without_target(catalogue: DataFrame, target) -> DataFrame:
    """P5: every driver but the target."""
    return catalogue.select("driver").distinct().where(F.col("driver") != F.lit(target))


def trips_membership(steps: DataFrame, pairs: DataFrame, bounded: bool = False) -> DataFrame:
    """Steps whose (driver, trip) is in ``pairs`` (a left semi join).

    ``bounded=True`` marks a pair set whose size is fixed by construction
    (``k`` draws for one target) and broadcasts it; otherwise the planner
    chooses from runtime sizes.
    """
    keys = pairs.select("driver", "trip").distinct()
    return steps.join(F.broadcast(keys) if bounded else keys, ["driver", "trip"], "left_semi")


def label_by_id_rule(df: DataFrame, col: str = "trip_no",
                     first_foreign: int = FIRST_FOREIGN_ID) -> DataFrame:
    """Label 1.0 for ids below ``first_foreign``, else 0.0."""
    return df.withColumn("rule_label",
                         F.when(F.col(col) < first_foreign, F.lit(1.0)).otherwise(F.lit(0.0)))


def relabel_glossary(pairs: DataFrame, offset: int = FIRST_FOREIGN_ID - 1,
                     seed: int = DEFAULT_SEED) -> DataFrame:
    """M4: new trip ids ``offset + 1, offset + 2, ...`` for the distinct sampled keys of a target.

    The numbering window is per target over at most ``k`` keys (bounded by
    construction).  Returns target, driver, trip, trip_no.
    """
    keys = pairs.select("target", "driver", "trip").distinct()
    w = Window.partitionBy("target").orderBy(u32(seed, "target", "driver", "trip"), "driver", "trip")
    return keys.withColumn("trip_no", (F.row_number().over(w) + offset).cast("bigint"))


def relabel_steps(steps: DataFrame, glossary: DataFrame, bounded: bool = False) -> DataFrame:
    """Steps of the sampled trips under the target's id and their new trip id."""
    g = F.broadcast(glossary) if bounded else glossary
    return (steps.join(g, ["driver", "trip"])
                 .select(F.col("target").alias("driver"), "trip_no", "step", "x", "y"))


def labelled_steps(steps: DataFrame, target, k: int = K_TRIPS, seed: int = DEFAULT_SEED,
                   offset: int = FIRST_FOREIGN_ID - 1, idx: FleetIndex | None = None) -> DataFrame:
    """M6: own steps (label 1.0, own trip id) + re-identified sampled steps (label 0.0).

    Output: driver (= target), trip (string id), step, x, y, label.
    """
    idx = idx or fleet_index(steps)
    pairs = sample_pairs(idx, k, seed, targets=[target])
    gl = relabel_glossary(pairs, offset, seed)
    neg = (relabel_steps(steps, gl, bounded=True)
           .select("driver", F.col("trip_no").cast("string").alias("trip"), "step", "x", "y")
           .withColumn("label", F.lit(0.0)))
    pos = (steps.where(F.col("driver") == F.lit(target))
                .select("driver", "trip", "step", "x", "y").withColumn("label", F.lit(1.0)))
    return pos.unionByName(neg)


def fleet_labelled_steps(steps: DataFrame, k: int = K_TRIPS, seed: int = DEFAULT_SEED,
                         offset: int = FIRST_FOREIGN_ID - 1,
                         idx: FleetIndex | None = None) -> DataFrame:
    """M6 for every target: own steps (label 1.0) + each target's re-identified draws (0.0).

    A draw picks a driver first and then one of its trips, so a trip of a driver with n
    trips is drawn about ``k / n`` times over all targets: the labelled steps are the steps
    table once more, and ``k`` drawn trips per driver.  Where drivers have fewer than ``k`` trips
    that is several times the table.  Output: driver (= target), trip, step, x, y, label.
    """
    idx = idx or fleet_index(steps)
    gl = relabel_glossary(sample_pairs(idx, k, seed), offset, seed)
    neg = (relabel_steps(steps, gl)
           .select("driver", F.col("trip_no").cast("string").alias("trip"), "step", "x", "y")
           .withColumn("label", F.lit(0.0)))
    pos = steps.select("driver", "trip", "step", "x", "y").withColumn("label", F.lit(1.0))
    return pos.unionByName(neg)


def union_labelled(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    """Union all of labelled sets, matched by column name."""
    return positives.unionByName(negatives)


def labelled_trips(df: DataFrame, target, k: int = K_DRIVERS, fraction: float = TRIP_FRACTION,
                   seed: int = DEFAULT_SEED) -> DataFrame:
    """M5: own trips (label 1) + a Bernoulli sample of the trips of ``k`` drivers (label 0)."""
    trips = trip_catalogue(df)
    drivers = sample_entities(trips, target, k, seed).select("driver")
    sampled = bernoulli(trips.join(F.broadcast(drivers), "driver", "left_semi"), fraction, seed)
    own = trips.where(F.col("driver") == F.lit(target))
    return union_labelled(own.withColumn("label", F.lit(1)),
                          sampled.withColumn("label", F.lit(0)))


def fleet_labelled_trips(idx: FleetIndex, k: int = K_TRIPS, seed: int = DEFAULT_SEED,
                         first_foreign: int = FIRST_FOREIGN_ID) -> DataFrame:
    """M8: the labelled trip set of every target at once.

    Own trips: label 1, ``trip_no`` 1..n by trip id, ``slot`` null.  Foreign
    draws (with replacement, slot kept): label 0, ``trip_no`` from
    max(n + 1, first_foreign) up, so ids never collide with own trips.
    Columns: target, driver, trip, slot, trip_no, label.
    """
    own = (idx.trips.join(idx.drivers.select("driver", "start"), "driver")
              .select(F.col("driver").alias("target"), "driver", "trip",
                      F.lit(None).cast("bigint").alias("slot"),
                      (F.col("gpos") - F.col("start") + 1).alias("trip_no"),
                      F.lit(1).alias("label")))
    neg = (_drawn_pairs(idx, k, seed).where(F.col("target").isNotNull())
           .select("target", "driver", "trip", "slot",
                   (F.greatest(F.col("n_own") + 1, F.lit(first_foreign)) + F.col("slot"))
                   .alias("trip_no"),
                   F.lit(0).alias("label")))
    return own.unionByName(neg)


def split_train_test(df: DataFrame, train_fraction: float = 0.7, seed: int = DEFAULT_SEED,
                     cols=("driver", "trip")) -> DataFrame:
    """M9: ``split`` = 'train' with probability ``train_fraction``, else 'test'."""
    return df.withColumn("split", F.when(u32(seed, *cols) < int(train_fraction * U32),
                                         F.lit("train")).otherwise(F.lit("test")))


def kfold(df: DataFrame, k: int = 5, seed: int = DEFAULT_SEED, cols=("driver", "trip")) -> DataFrame:
    """``fold`` in 0..k-1; fold i is held out, the others train."""
    return df.withColumn("fold", (u32(seed, *cols) % k).cast("bigint"))


def half_split(df: DataFrame, group_cols=("target", "label"),
               order_cols=("driver", "trip", "slot"), seed: int = DEFAULT_SEED) -> DataFrame:
    """Exact halves of every (target, label) group: ``half`` 1 gets ceil(n/2) rows.

    Ranks come from one global dense index (range partitioned), so a target
    with a third of all rows is still numbered by many tasks.
    """
    g, o = list(group_cols), list(order_cols)
    keyed = df.withColumn("_h", u32(seed, *g, *o))
    ranked = dense_index(keyed, g + ["_h"] + o, "_pos")
    starts = ranked.groupBy(*g).agg(F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("_n"))
    out = ranked.join(starts, g)
    first_half = (F.col("_pos") - F.col("_start")) < F.ceil(F.col("_n") / 2.0)
    return (out.withColumn("half", F.when(first_half, F.lit(1)).otherwise(F.lit(2)))
               .drop("_h", "_pos", "_start", "_n"))
