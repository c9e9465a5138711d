"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Main path: DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadprint.llm.common import keep, small, words_count

SEED = 42


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Targets of ``sources(source_key, source_size, weight)`` summing to the total size.

    A source is clamped at ``max_epochs`` times its size; what it cannot take goes
    to the others by weight, until none is above its cap.  Sources are taken by
    rising cap per unit of weight: the clamped ones are exactly the first of this
    order, so one running sum replaces the rounds.  Sums are exact (integers as
    decimals); one division gives the target.  One row per source: the window
    runs over the aggregated source table, never over documents.
    """
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "source_key")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    dec = lambda c: c.cast("decimal(38,0)")
    s = (sources
         .withColumn("cap", F.col("source_size") * max_epochs)
         .withColumn("total", F.sum("source_size").over(every))
         .withColumn("all_weight", F.sum("weight").over(every))
         .withColumn("rest", F.col("total") - F.coalesce(F.sum("cap").over(past), F.lit(0)))
         .withColumn("rest_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(past), F.lit(0)))
         .withColumn("clamped", dec(F.col("cap")) * F.col("rest_weight") <= dec(F.col("rest")) * F.col("weight")))
    free = F.when(~F.col("clamped"), F.struct("cap_order", "rest", "rest_weight"))
    s = s.withColumn("cap_order", F.row_number().over(order))
    level = F.min(free).over(every)
    return (s.withColumn("level", level)
            .withColumn("target", F.when(F.col("clamped"), F.col("cap").cast("double"))
                        .otherwise(F.col("level.rest").cast("double") * F.col("weight")
                                   / F.col("level.rest_weight")))
            .select("source_key", "source_size", "weight", "target"))


def _draw(sized: DataFrame, need: DataFrame) -> DataFrame:
    """Where the last, partial repetition ends: (source_key, prefix, open).

    ``need(source_key, remainder)``: words each source still lacks.  The documents of a source are put in a seeded random order
    and taken whole until the source's remainder is met; the one that crosses it
    gives the words still missing.  The order is followed by radix: sizes summed
    per 3 hex digits of the draw find the crossing prefix, twice, so only the few
    documents that share 6 digits with the crossing one are ever sorted together (``_taken``):
    ``open`` words are still to be taken from those.
    """
    run = lambda *by: Window.partitionBy("source_key").orderBy(*by).rowsBetween(
        Window.unboundedPreceding, -1)
    level = need.withColumn("open", F.col("remainder")).withColumn("prefix", F.lit(""))
    for digits in (3, 6):
        sums = (sized.join(small(level.select("source_key", "prefix")), "source_key")
                .where(F.col("draw").startswith(F.col("prefix")))
                .groupBy("source_key", F.substring("draw", 1, digits).alias("p"))
                .agg(F.sum("size").alias("in_p")))
        cum = (sums.withColumn("before", F.coalesce(F.sum("in_p").over(run("p")), F.lit(0)))
               .join(level.select("source_key", "open"), "source_key")
               .where((F.col("before") < F.col("open")) & (F.col("before") + F.col("in_p") >= F.col("open"))))
        level = keep(level.drop("prefix", "open").join(
            cum.select("source_key", F.col("p").alias("prefix"), (F.col("open") - F.col("before")).alias("open")),
            "source_key"), "mix-level")
    return level.select("source_key", "prefix", "open")


def _sized(documents: DataFrame, seed: int) -> DataFrame:
    """Every document as a struct ``doc``, with its size, the key of its source and its draw."""
    text_id = F.coalesce(F.md5("text"), F.lit("null"))
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text_id))
    # A source as a key that is never null and sorts nulls last.
    key = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source"))
    return documents.select(F.struct(*documents.columns).alias("doc"), key.alias("source_key"),
                            words_count(F.col("text")).alias("size"), draw.alias("draw"))


def _plan(sized: DataFrame, max_epochs: int, weights: tuple[int, ...]) -> DataFrame:
    """Per source: target, whole repetitions, and where the last, partial one ends in draw order."""
    n = len(weights)
    at = Window.orderBy("source_key")
    sources = (sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
               .withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]),
                                                  (F.row_number().over(at) - 1) % n + 1)))
    filled = water_fill(sources, max_epochs)
    words = F.floor(F.col("target") + 0.5).cast("bigint")  # whole words of the source
    plan = keep(filled.withColumn("words", words)
                .withColumn("epochs", F.when(F.col("source_size") > 0,
                                             (F.col("words") - F.col("words") % F.col("source_size"))
                                             / F.col("source_size")).otherwise(0).cast("bigint"))
                .withColumn("remainder", F.col("words") - F.col("epochs") * F.col("source_size")),
                "mix-plan")
    ends = _draw(sized, plan.where("remainder > 0").select("source_key", "remainder"))
    return plan.select("source_key", "source_size", "target", "epochs").join(ends, "source_key", "left")


def _taken(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` with source_size, target, epochs and taken words; only rows at the edge of a draw are ordered."""
    rows = sized.join(small(plan), "source_key")
    at_edge = F.coalesce(F.col("draw").startswith(F.col("prefix")), F.lit(False))
    whole = F.coalesce(F.substring("draw", 1, 6) < F.col("prefix"), F.lit(False))
    order = Window.partitionBy("source_key").orderBy("draw", F.xxhash64("doc")).rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where(at_edge).withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0))).withColumn(
        "part", F.greatest(F.lit(0), F.least("size", F.col("open") - F.col("before")))).drop("before")
    plain = rows.where(~at_edge).withColumn("part", F.when(whole, F.col("size")).otherwise(F.lit(0)))
    return plain.unionByName(edge).withColumn(
        "taken", (F.col("size") * F.col("epochs") + F.col("part")).cast("bigint"))


def mix(documents: DataFrame, max_epochs: int = 3, weights: tuple[int, ...] = (1, 2, 3),
        seed: int = SEED) -> DataFrame:
    """Mix documents so that each source takes its share of all words.

    Returns (doc_id, size, source_size, target, taken, epochs): ``size`` in words (null
    text: 0), ``taken`` the words the mix takes from the document: ``epochs`` whole
    repetitions plus, for the documents drawn, one more (the last drawn one gives only
    the words that its source still lacks).  Sources in code-point order, null last,
    weigh ``weights`` in turn.  A source's taken words equal its target rounded to a
    word.  Reruns agree, in any layout: draws are md5 of seed, doc_id and text.

    Empty texts take 0 words; repeated rows are separate documents; an empty table
    gives no rows; a null doc_id draws by its text.  Long texts count whole.  Other columns are ignored.
    """
    sized = keep(_sized(documents.select("doc_id", "text", "source"), seed)
                 .withColumn("doc", F.struct("doc.doc_id")), "mix-sizes")
    return _taken(sized, _plan(sized, max_epochs, weights)).select(
        "doc.doc_id", "size", "source_size", "target", "taken", "epochs")


def mix_documents(documents: DataFrame, max_epochs: int = 3, weights: tuple[int, ...] = (1, 2, 3),
                  seed: int = SEED) -> DataFrame:
    """The documents, columns unchanged, with what ``mix`` says of each: size, source_size, target, taken, epochs.

    Texts are read in two passes and never shuffled.  Columns of the documents with one of these five
    names are replaced; nulls, repeated rows and empty tables as in ``mix``.
    """
    sized = _sized(documents, seed)
    plan = _plan(keep(sized.drop("doc"), "mix-sizes"), max_epochs, weights)
    new = ["size", "source_size", "target", "taken", "epochs"]
    return _taken(sized, plan).select(*[F.col(f"doc.`{c}`") for c in documents.columns if c not in new], *new)
