"""Malformed input, file catalogues and lifetimes of written tables."""

import os
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from roadprint.session import ensure_checkpoint_dir, materialize, scratch
from roadprint.sources import files


def folder(spark):
    return sorted(os.listdir(urlparse(ensure_checkpoint_dir(spark)).path))


def test_malformed_step_lines_are_rejects(spark, tmp_path):
    good = ["1.5,2,7,12,0", "-1e3,0.25,7,12,1.5", "0,0,8,a b,2"]
    bad = ["abc,2,7,12,0", "1,2,7,12", "1,2,7,12,0,9", "1,,7,12,0", "1,2,7,12,", "NaNx,1,1,1,1"]
    (tmp_path / "a.csv").write_text("\n".join(good[:2] + bad[:3]) + "\n\n")
    (tmp_path / "b.csv").write_text("\n".join(bad[3:] + good[2:]))
    (tmp_path / "c.csv").write_text("")
    with scratch(spark):
        got = files.read_steps_checked(spark, str(tmp_path))
        assert sorted(map(tuple, got.rows.collect())) == [(-1000.0, 0.25, "7", "12", 1.5), (0.0, 0.0, "8", "a b", 2.0),
                                                          (1.5, 2.0, "7", "12", 0.0)]
        lines = got.rejects.collect()
        assert len(lines) == len(bad) and {r.line for r in lines} >= set(bad[:3]) | {bad[5]}
        assert {os.path.basename(r.file) for r in lines} == {"a.csv", "b.csv"}
        assert got.rows.select("x").where("x is null").isEmpty() and got.rejects.count() == len(bad)
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_steps_csv(spark, str(tmp_path)).collect()


def test_malformed_trips_are_rejects(spark, tmp_path):
    lines = ['{"driver":1,"trip":"a","x":[1,2],"y":[3,4],"step":[0,1]}', '{"driver":1,"trip":"b","x":[1,2],"y":[3],"step":[0,1]}',
             '{"driver":1,"trip":"c","x":["q"],"y":[3],"step":[0]}', "not json", '{"driver":2,"trip":"d"}',
             '{"driver":2,"trip":"e","x":[],"y":[],"step":[]}']
    (tmp_path / "t.json").write_text("\n".join(lines))
    with scratch(spark):
        got = files.read_trips_checked(spark, str(tmp_path))
        assert sorted(r.trip for r in got.rows.collect()) == ["a", "e"]
        assert got.rejects.count() == 4


def test_catalogue_counts_empty_files_and_reads_no_content(spark, tmp_path):
    for n in (3, 14, 159):
        (tmp_path / f"driver_{n}.csv").write_text("" if n == 14 else "x" * n)
    (tmp_path / "readme.txt").write_text("no digits")
    got = files.catalogue_from_files(spark, str(tmp_path))
    assert sorted(r.driver for r in got.collect()) == ["14", "159", "3"]
    assert "LocalTableScan" not in got._jdf.queryExecution().executedPlan().toString()
    nested = tmp_path / "set" / "driver_77.csv"
    nested.mkdir(parents=True)
    (nested / "part-0.csv").write_text("")
    (nested / "part-1.csv").write_text("1,2")
    deep = files.catalogue_from_files(spark, str(tmp_path / "set" / "*"), use_parent=True)
    assert [r.driver for r in deep.collect()] == ["77"]


def test_tables_live_as_long_as_their_scope(spark):
    before = folder(spark)
    with scratch(spark) as outer:
        held = outer.persist(spark.range(10))
        kept = materialize(spark.range(5), "outer")
        with scratch(spark):
            for name in ("fleet_labelled_trips", "features_v2_split_lineitem", "metrics_roundtrip", "scan_steps_rejects"):
                E.queries()[name](spark, SF_SMALL).write.format("noop").mode("overwrite").save()
            assert len(folder(spark)) > len(before) + 1
        assert len(folder(spark)) == len(before) + 1 and kept.count() == 5 and held.is_cached
    assert folder(spark) == before and not held.is_cached


def test_scope_ends_after_an_error(spark):
    before = folder(spark)
    with pytest.raises(ZeroDivisionError):
        with scratch(spark):
            materialize(spark.range(5).withColumn("x", F.lit(1)), "failed")
            1 / 0
    assert folder(spark) == before


def test_one_file_a_name_and_names_listed_by_many_tasks(spark, tmp_path):
    rows = spark.range(400).select(F.concat(F.lit("driver_"), F.col("id") % 40).alias("file"),
                                   F.col("id").cast("string").alias("value")).repartition(8)
    files.write_files_by(rows, "file", str(tmp_path / "set"))
    assert len(list((tmp_path / "set").glob("*/part-*"))) == 40 and spark.read.text(str(tmp_path / "set")).count() == 400
    got = files.catalogue_from_files(spark, str(tmp_path / "set" / "*" / "*"), use_parent=True)
    assert sorted(int(r.driver) for r in got.collect()) == list(range(40))
    conf = spark._jsparkSession.sparkContext().conf()  # the setting is as before
    assert conf.get("spark.files.openCostInBytes", "4194304") == "4194304"
    tasks = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    got.collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    widest = max(tasks.getStageInfo(s).numTasks for j in tasks.getJobIdsForGroup("listing")
                 for s in tasks.getJobInfo(j).stageIds if tasks.getStageInfo(s))
    assert widest >= 4  # one task before


def test_listing_many_files_packs_few_settings_and_leaves_no_checksum_files(spark, tmp_path):
    """For every file that a task was dealt it packed all settings of Hadoop; each file written had a second one beside it."""
    rows = spark.createDataFrame([(f"driver_{i}", "x") for i in range(40)], "file string, value string")
    files.write_files_by(rows, "file", f"{tmp_path}/names")
    written = [f for _, _, names in os.walk(f"{tmp_path}/names") for f in names if "part-" in f]
    assert len(written) == 40 and not any(f.endswith(".crc") for f in written)
    everything = spark.sparkContext._jsc.hadoopConfiguration()
    try:
        everything.set("fs.test.secret.key", "kept")
        settings = files._store_settings(spark, f"{tmp_path}/names/{{*_1,*_2}}/*,{tmp_path}/names/*_3/*")
    finally:
        everything.unset("fs.test.secret.key")
    assert settings.size() < everything.size() / 2 and settings.get("fs.test.secret.key") == "kept"
    assert settings.get("fs.defaultFS") == everything.get("fs.defaultFS")
    got = files.catalogue_from_files(spark, f"{tmp_path}/names/{{*_1,*_2}}/*,{tmp_path}/names/*_3/*", use_parent=True)
    assert sorted(r.driver for r in got.collect()) == ["1", "2", "3"]
