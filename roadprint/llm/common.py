"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadprint.session import shared_dir

# Fixed value: a word is a run of bytes other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor recomputes nothing upstream, and later
    jobs reuse the rows.  ``forget`` removes the table again.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table written by ``keep`` that no later plan reads."""
    spark = df.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Broadcast hint for a narrow table that is counted first; a longer one is joined plainly."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def words_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _signature(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected link table: (node, component).

    ``component`` is the smallest id reachable; nodes without a link, null ends
    and self links give no row.  Alternates large-star and small-star rounds
    (edges are re-hung on the smallest neighbour until every component is a
    star), so it needs few rounds on long chains and never gathers a component
    in one task: the minimum is a partial aggregate and the re-hanging an
    equi-join that AQE can split.  Each round is a written table.
    """
    edges = keep(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                 .where("a > b").distinct(), "links")
    before = _signature(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct())
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low2.select("a", F.col("m").alias("b"))).distinct())
        new = keep(small, "links")
        forget(edges)
        edges, after = new, _signature(new)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = after
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")
