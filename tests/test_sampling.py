"""Properties of the sampling and labelling operators on the sf0.001 / sf0.01 tables."""

from pyspark.sql import functions as F

from conftest import SF, SF_SMALL
from roadprint.functions.columns import dense_index_total
from roadprint.operators import sampling
from roadprint.sources import testdata


def test_dense_index_is_a_permutation_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    idx, n = dense_index_total(df, ["k"], "pos", num_partitions=7)
    rows = sorted((r["k"], r["pos"]) for r in idx.collect())
    assert n == 5000
    assert [p for _, p in rows] == list(range(5000))


def test_fleet_pairs_never_self_and_k_per_target(spark):
    st = testdata.events_steps(spark, SF_SMALL)
    idx = sampling.fleet_index(st)
    pairs = sampling.sample_pairs(idx, k=50)
    assert pairs.where(F.col("target") == F.col("driver")).count() == 0
    per = {r["target"]: r["count"] for r in pairs.groupBy("target").count().collect()}
    assert set(per.values()) == {50} and len(per) == idx.n_drivers
    # every drawn trip exists
    assert pairs.join(sampling.trip_catalogue(st), ["driver", "trip"], "left_anti").count() == 0


def test_fleet_labelled_ids_and_labels(spark):
    st = testdata.events_steps(spark, SF_SMALL)
    lab = sampling.fleet_labelled_trips(sampling.fleet_index(st), k=20)
    own = lab.where("label = 1")
    assert own.where("target <> driver").count() == 0
    assert own.count() == sampling.trip_catalogue(st).count()
    neg = lab.where("label = 0")
    assert neg.where(F.col("trip_no") < sampling.FIRST_FOREIGN_ID).count() == 0
    # no id collision inside a target
    assert lab.groupBy("target", "trip_no").count().where("count > 1").count() == 0


def test_splits_partition_rows(spark):
    st = testdata.events_steps(spark, SF)
    trips = sampling.trip_catalogue(st)
    n = trips.count()
    sp = sampling.split_train_test(trips)
    counts = {r["split"]: r["count"] for r in sp.groupBy("split").count().collect()}
    assert sum(counts.values()) == n and 0.6 < counts["train"] / n < 0.8
    kf = sampling.kfold(trips, 5)
    assert sorted(r["fold"] for r in kf.select("fold").distinct().collect()) == [0, 1, 2, 3, 4]
    assert kf.count() == n


def test_half_split_exact_halves(spark):
    st = testdata.events_steps(spark, SF_SMALL)
    lab = sampling.fleet_labelled_trips(sampling.fleet_index(st), k=21)
    halves = sampling.half_split(lab)
    g = halves.groupBy("target", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("half") == 1, 1).otherwise(0)).alias("h1"))
    for r in g.collect():
        assert r["h1"] == (r["n"] + 1) // 2


def test_bernoulli_reproducible(spark):
    trips = sampling.trip_catalogue(testdata.events_steps(spark, SF))
    a = sorted(map(tuple, sampling.bernoulli(trips, 0.3).collect()))
    b = sorted(map(tuple, sampling.bernoulli(trips.repartition(3), 0.3).collect()))
    assert a == b and 0.2 < len(a) / trips.count() < 0.4


def test_labelled_steps_single_target(spark):
    st = testdata.events_steps(spark, SF_SMALL)
    ls = sampling.labelled_steps(st, 3, k=30)
    assert ls.where("driver <> 3").count() == 0
    pos = ls.where("label = 1.0").count()
    assert pos == st.where("driver = 3").count()
    neg_ids = [int(r["trip"]) for r in ls.where("label = 0.0").select("trip").distinct().collect()]
    assert min(neg_ids) == sampling.FIRST_FOREIGN_ID and len(neg_ids) <= 30


def test_sample_entities_excludes_target(spark):
    cat = testdata.events_steps(spark, SF).select("driver").distinct()
    s = sampling.sample_entities(cat, 5, k=40)
    ids = [r["driver"] for r in s.collect()]
    assert len(ids) == len(set(ids)) == 40 and 5 not in ids


def test_fleet_entities_exact_and_round_independent(spark):
    st = testdata.events_steps(spark, SF_SMALL)
    idx = sampling.fleet_index(st)
    k = 9
    a = sampling.sample_entities_fleet(idx, k=k, draws_per_round=3)     # many rounds
    b = sampling.sample_entities_fleet(idx, k=k, draws_per_round=200)   # one round
    ra = sorted(map(tuple, a.collect()))
    assert ra == sorted(map(tuple, b.collect()))
    per = {}
    for t, d in ra:
        assert t != d
        per.setdefault(t, set()).add(d)
    assert len(per) == idx.n_drivers and all(len(v) == k for v in per.values())
    # asking for more than the pool gives the whole pool
    c = sampling.sample_entities_fleet(idx, k=1000)
    assert c.count() == idx.n_drivers * (idx.n_drivers - 1)


def test_positions_by_geometric_skips_follow_the_bernoulli_law(spark):
    """Counts and places of kept positions over many sets, small ones and ones of many blocks."""
    sizes = [0, 1, 3, 60, 1024, 1025, 5000]
    sets = spark.range(2100).select(F.col("id").alias("target"), F.element_at(F.array(*map(F.lit, sizes)), (
        F.col("id") % len(sizes) + 1).cast("int")).cast("bigint").alias("n"))
    p = 0.02
    got = sampling.bernoulli_positions(sets, "n", p, 42, "target").collect()
    at = {}
    for r in got:
        at.setdefault(r.target, []).append(r.pos)
        assert 0 <= r.pos < r.n
    assert all(len(v) == len(set(v)) for v in at.values())
    for k, n in enumerate(sizes):
        counts = [len(at.get(t, [])) for t in range(k, 2100, len(sizes))]
        mean, sd = n * p, (n * p * (1 - p)) ** 0.5
        assert abs(sum(counts) / len(counts) - mean) <= 4 * sd / len(counts) ** 0.5 + 1e-9
        if n == 5000:
            var = sum((c - mean) ** 2 for c in counts) / len(counts)
            assert 0.75 * sd ** 2 < var < 1.3 * sd ** 2
    places = [x for t in range(6, 2100, 7) for x in at.get(t, [])]
    assert abs(sum(places) / len(places) - 2499.5) < 4 * 5000 / 12 ** 0.5 / len(places) ** 0.5
    dense = sampling.bernoulli_positions(sets.where("n <= 60"), "n", 0.9, 1, "target").count()
    assert abs(dense - 300 * 64 * 0.9) < 4 * (300 * 64 * 0.09) ** 0.5
    assert sampling.bernoulli_positions(sets, "n", 1.0, 1, "target").count() == 300 * sum(sizes)
    assert sampling.bernoulli_positions(sets, "n", 0.0, 1, "target").count() == 0


def test_a_target_without_a_name_draws_no_labelled_trips(spark):
    rows = [(d, f"t{t}") for d in (None, 1, 2, 3) for t in range(2)]
    lab = sampling.fleet_labelled_trips(sampling.fleet_index(spark.createDataFrame(rows, "driver long, trip string")), k=5)
    assert lab.where("target is null").isEmpty() and lab.where("label = 0").count() >= 3
    assert lab.where("label = 1").count() == 6


def test_skips_are_those_of_the_plain_chain_and_computed_once(spark):
    import hashlib
    import math
    p, sizes = 0.02, [1, 30, 84, 1024, 1025, 3000]

    def chain(target, n):
        for block in range(-(-n // sampling.SKIP_BLOCK)):
            size, at, i = min(sampling.SKIP_BLOCK, n - block * sampling.SKIP_BLOCK), -1, 0
            while at < size:
                i += 1
                u = (int(hashlib.md5(f"42|{target}|{block}|{i}|g".encode()).hexdigest()[:8], 16) + 0.5) / 2 ** 32
                at += 1 + math.floor(math.log(u) / math.log1p(-p))
                if at < size:
                    yield target, block * sampling.SKIP_BLOCK + at

    sets = [(t, sizes[t % len(sizes)]) for t in range(60)]
    df = sampling.bernoulli_positions(spark.createDataFrame(sets, "target long, n long"), "n", p, 42, "target")
    got = sorted((r.target, r.pos) for r in df.collect())
    assert got == sorted(x for t, n in sets for x in chain(t, n))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" in plan and not [x for x in plan.splitlines() if "Filter " in x and "aggregate(" in x]
