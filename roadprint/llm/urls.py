"""URL filter: fixed rules, and a path-template tree per host judged by labelled purity.

Main path: DataFrame expressions only.
"""

from __future__ import annotations

import itertools
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadprint.llm.common import forget, keep

# Host, path and verdict of the rules of the registered query.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
MIN_LABELS = 5  # labelled pages that a branch needs to stand apart from its siblings
MIN_BRANCHES = 5  # labelled branches merged at a node that an unlabelled one needs to be judged like them
Z_SCORE = 2.58  # of the two-share test below which branches are merged
SMOOTHING = 8.0  # labelled pages that the overall share of bad pages counts for
REJECT_AT = 0.5  # smoothed share of bad pages from which a template is rejected


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*+)", 1), string.ascii_uppercase,
                                  string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*+([^?#]*+)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict: both null where none does."""
    texts, verdicts = [], []
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        texts.append(F.when(fits, F.lit(h + p)))
        verdicts.append(F.when(fits, F.lit(verdict)))
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return F.coalesce(*texts), F.coalesce(*verdicts)


def segments(path: Column) -> Column:
    """The path's segments with runs of digits and long hex ids as typed wildcards."""
    plain = F.regexp_replace(F.regexp_replace(path, r"[0-9A-Fa-f]{8,}(?:-[0-9A-Fa-f]{4,})*", "{h}"),
                             r"[0-9]+", "{n}")
    parts = F.split(plain, "/")
    return F.slice(parts, F.lit(2), F.size(parts))


def prior_of(shapes: DataFrame) -> float:
    """Share of bad pages among all labelled ones, 0 without labels."""
    overall = shapes.agg(F.sum("bad").alias("bad"), F.sum("lab").alias("lab")).first()
    return (overall["bad"] or 0) / overall["lab"] if overall["lab"] else 0.0


def templates(shapes: DataFrame) -> DataFrame:
    """``shapes(host, segs, n, lab, bad)`` with the template that each falls under.

    Level by level, down to the last segment of the longest path, the branches of a node (host and template so far) are compared with
    their siblings taken together (two-share z test), or with the overall share of bad pages
    where the siblings have too few labels: those with clearly more bad pages are merged into
    ``*+``, those with clearly fewer into ``*-`` and all others into ``*``.  Unlabelled branches
    join ``*`` only where it holds enough labelled branches to show that branches of this node
    are alike, or none; else they are ``*?``, which has no labels and so the overall share.
    A branch alone in its class stays literal.
    """
    level = keep(shapes.withColumn("template", F.lit("")), "url-shapes")
    prior = prior_of(level)
    for depth in itertools.count():
        here = level.withColumn("seg", F.get("segs", F.lit(depth)))
        deeper = here.where("seg is not null")
        if deeper.isEmpty():
            break
        branch = deeper.groupBy("host", "template", "seg").agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad"))
        node = branch.groupBy("host", "template").agg(
            F.sum("lab").alias("all_lab"), F.sum("bad").alias("all_bad"))
        rest, share = F.col("all_lab") - F.col("lab"), F.try_divide("all_bad", "all_lab")
        own, few = F.try_divide("bad", "lab"), rest < MIN_LABELS
        gap = own - F.when(few, F.lit(prior)).otherwise(F.try_divide(F.col("all_bad") - F.col("bad"), rest))
        one = F.try_divide(F.lit(1), F.col("lab"))
        spread = F.when(few, F.sqrt(F.lit(prior * (1 - prior)) * one)).otherwise(
            F.sqrt(share * (1 - share) * (one + F.try_divide(F.lit(1), rest))))
        apart = F.coalesce((F.col("lab") >= MIN_LABELS) & (F.abs(gap) >= spread * Z_SCORE) & (gap != 0), F.lit(False))
        kind = F.when(apart, F.when(gap > 0, "*+").otherwise("*-")).otherwise("*")
        tested = branch.join(node, ["host", "template"]).select("host", "template", "seg", "lab", kind.alias("kind"))
        alike = tested.groupBy("host", "template").agg(
            F.count(F.when((F.col("kind") == "*") & (F.col("lab") > 0), 1)).alias("alike"))
        unlike = (F.col("lab") == 0) & F.col("alike").between(1, MIN_BRANCHES - 1)
        sided = tested.join(alike, ["host", "template"]).select(
            "host", "template", "seg", F.when(unlike, "*?").otherwise(F.col("kind")).alias("name"))
        alone = sided.groupBy("host", "template", "name").agg(
            F.count(F.lit(1)).alias("members"), F.min("seg").alias("only"))
        named = sided.join(alone, ["host", "template", "name"]).select(
            "host", "template", "seg", F.when(F.col("members") == 1, F.col("only")).otherwise(F.col("name"))
            .alias("name"))
        step = here.join(named, ["host", "template", "seg"], "left").select(
            "host", "segs", "n", "lab", "bad", F.when(F.col("seg").isNull(), F.col("template")).otherwise(
                F.concat("template", F.lit("/"), "name")).alias("template"))
        new = keep(step, "url-shapes")
        forget(level)
        level = new
    return level


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every page.

    ``labelled(page_id, bad)``: known pages, bad 0 or 1.  Where no rule fits, a page is
    blocked if its template's smoothed share of bad labelled pages reaches REJECT_AT:
    (bad + SMOOTHING x overall share) / (labelled + SMOOTHING); ``purity`` is one minus it.

    Null urls and urls without ``://`` have empty host and path and are judged under one
    template; repeated pages are judged alike; several labels of a page count as bad if any
    is; labels with a null id or value are left out; without labels nothing but rules
    blocks; an empty table gives no rows; other columns are ignored.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parsed = parsed.withColumn("segs", segments(F.col("path")))
    marks = (labelled.where("page_id is not null and bad is not null").groupBy("page_id")
             .agg(F.max("bad").cast("bigint").alias("bad")))
    shapes = (parsed.select("page_id", "host", "segs").join(marks, "page_id", "left").groupBy("host", "segs")
              .agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("lab"),
                   F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("bad")))
    tree = templates(shapes)
    prior = prior_of(tree)
    bad_share = (F.col("t_bad") + SMOOTHING * prior) / (F.col("t_lab") + SMOOTHING)
    judged = (tree.groupBy("host", "template").agg(F.sum("bad").alias("t_bad"), F.sum("lab").alias("t_lab"))
              .withColumn("bad_share", bad_share).select("host", "template", "bad_share"))
    shaped = tree.select("host", "segs", "template").join(judged, ["host", "template"])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return (parsed.join(shaped, ["host", "segs"])
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("bad_share") >= REJECT_AT, "block").otherwise("allow"))
                    .alias("verdict"), "template", (1 - F.col("bad_share")).alias("purity")))
