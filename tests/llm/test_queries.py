"""Registered queries of the subpackage: results against SQL where there is one, and the pipeline."""

import os
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from roadprint.llm import decontam, pii, simhash, toxicity
from roadprint.llm.common import table

SF = "/root/testdata/sf0.001"
NAMES = [f"op{n}_" for n in range(1, 14)]


def test_every_operator_is_registered():
    names = list(entry.queries())
    assert all(sum(n.startswith(p) for n in names) == 1 for p in NAMES) and "pipeline" in names


@pytest.mark.parametrize("name", ["op2_substrings", "op5_mixing", "op7_warc", "op11_lexical"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, df.select(cols).collect()), key=key) == sorted(res.fetchall(), key=key)


def test_pipeline_stages(spark):
    """Each stage against what its operator reports on that stage's own input."""
    docs = table(spark, SF, "documents")
    labels, bench = table(spark, SF, "labels"), table(spark, SF, "benchmark")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash", "decontamination", "pii", "mixing"]
    stage = dict(corpus_pipeline.STAGES)
    at = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    clean = stage["toxicity"](spark, docs, SF)
    bad = at(toxicity.score(docs, labels).where("predicted = 1"))
    assert at(clean) == at(docs) - bad and clean.columns == docs.columns
    one = stage["simhash"](spark, clean, SF)
    assert at(one) == at(simhash.near_duplicates(clean).where("doc_id = component_id")) and one.columns == docs.columns
    free = stage["decontamination"](spark, one, SF)
    assert at(free) == at(one) - at(decontam.report(one, bench).where("contaminated"))
    masked = stage["pii"](spark, free, SF)
    assert at(masked) == at(free) and masked.columns == docs.columns
    assert pii.scan(masked).agg(F.sum("n_email") + F.sum("n_ip")).first()[0] == 0
    mixed = stage["mixing"](spark, masked, SF)
    assert at(mixed) == at(masked)
    assert mixed.select(docs.columns).exceptAll(masked).isEmpty() and {"taken", "epochs"} < set(mixed.columns)
    assert at(corpus_pipeline.run(spark, SF)) == at(masked)


def test_held_out_rule(spark):
    got = spark.range(50).select(F.col("id").alias("doc_id")).withColumn("h", toxicity.is_held_out()).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
