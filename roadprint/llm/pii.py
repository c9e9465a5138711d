"""Personal data: fixed shapes as seeds, and bootstrapped contextual extraction around them.

Main path: DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadprint.llm.common import forget, keep

KINDS = ["email", "ip", "card", "phone"]
CANDIDATE = len(KINDS)  # kind number of identifier-like words that no fixed shape holds
RUN = CANDIDATE + 1  # of runs of digit groups, over several words

# The seed shapes, in Java's syntax.  Possessive repeats give the same
# matches (no repeat could give back a character and still match), without deep recursion
# on long runs.  A run is tried from its first character only (or where the last match
# ended), which are the only places where a leftmost match can begin.
SHAPES = [
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@\[(]*+(?:(?:\[(?!at\])|\((?!at\)))[^\x20\x09-\x0D0-9@\[(]*+)*+"
    r"(?:[0-9@]|\[at\]|\(at\))[^\x20\x09-\x0D]*+",
    r"(?<![\p{L}\p{N}])(?:\+\(?|\()?+[0-9](?:\)?+[\x20./-]?+\(?+[0-9]){8,}+",
]
# A text without this holds no valid match of the shape.
NEEDS = [r"@", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"[0-9](?:[\x20-]?+[0-9]){12}", r"\+[0-9]", r"[0-9@]|\[at\]|\(at\)",
         r"[0-9](?:\)?+[\x20./-]?+\(?+[0-9]){8}"]

# What an unseen identifier of a kind may look like, once punctuation around it is dropped.
LOOSE = [
    r"^[A-Za-z0-9._%+-]+(?:@|\[at\]|\(at\))[A-Za-z0-9-]+(?:(?:\.|\[dot\]|\(dot\))[A-Za-z0-9-]+)*$",
    r"^(?:[0-9]{1,3}[._:-]){3}[0-9]{1,3}$|^(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}$",
    r"^(?:[0-9][\x20._/-]?){12,18}[0-9]$",
    r"^\(?[0-9](?:[().0-9/-]?[0-9]){8,14}$|^\+?\(?[0-9](?:\)?[\x20./-]?\(?[0-9]){8,14}$",
]
AROUND = 64  # characters kept on either side of a match to take its context words from
MIN_SEEDS = 3  # distinct known identifiers that a pattern needs
PATTERN_SCORE = 0.75  # score from which a pattern counts
INSTANCE_SCORE = 0.75  # score from which an unseen identifier is taken
SETTLED = 3  # decimals of the summed scores that a round must leave as they are to be the last


def _hits(text: Column, kind: int) -> Column:
    """Array of (kind, gap before, match, text left, text right) of one shape, in order."""
    found = F.regexp_extract_all(text, F.lit(SHAPES[kind]), F.lit(0))
    pieces = F.split(text, SHAPES[kind], -1)
    left = F.zip_with(pieces, found, lambda p, m: F.struct(
        F.lit(kind).alias("kind"), F.length(p).alias("gap"), m.alias("m"), F.right(p, F.lit(AROUND)).alias("l")))
    # 2^31 - 1 as a length overflows where slice is interpreted, as inside zip_with, and gives an empty array.
    both = F.zip_with(left, F.slice(pieces, F.lit(2), F.size(pieces)), lambda a, p: F.struct(
        a["kind"].alias("kind"), a["gap"].alias("gap"), a["m"].alias("m"), a["l"].alias("l"),
        F.left(p, F.lit(AROUND)).alias("r")))
    return F.when(text.rlike(NEEDS[kind]), F.filter(both, lambda x: x["m"].isNotNull()))


def _luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid Luhn sum."""
    total = F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("i"), F.lit(0).alias("s")),
                        lambda acc, d: F.struct(
                            (acc["i"] + 1).alias("i"),
                            (acc["s"] + F.when(acc["i"] % 2 == 0, d.cast("int")).otherwise(
                                d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))).alias("s")))
    return total["s"] % 10 == 0


def _valid(kind: Column, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    parts = F.split(m, r"\.")
    small = F.forall(parts, lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
        parts, lambda p: F.right(p, F.lit(3)).cast("int") <= 255)
    return (F.when(kind == 0, F.lit(True)).when(kind == 1, small)
            .when(kind == 2, F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False))
            .when(kind == 3, F.length(digits).between(9, 15)).otherwise(False))


def _core(m: Column) -> Column:
    """A word without the punctuation around it."""
    return F.regexp_replace(m, r"^[^\p{L}\p{N}+(]++|[^\p{L}\p{N}]++$", "")


def _loose(value: Column) -> Column:
    """The kind that an unseen identifier looks like, or null."""
    return F.coalesce(*[F.when(value.rlike(s), F.lit(k)) for k, s in enumerate(LOOSE)])


def _whole(m: Column, right: Column) -> Column:
    """Whether a run of digit groups is a candidate: several words, none an identifier alone, none cut."""
    words = F.split(m, " ")
    return (F.size(words) > 1) & ~F.coalesce(right, F.lit("")).rlike(r"^[\p{L}\p{N}]") & ~F.exists(
        words, lambda w: _loose(_core(w)).isNotNull())


def matches(documents: DataFrame, carry: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Written rows (row, carried columns), and every match of every shape with its position.

    Matches: (row, kind, m, start, stop, l, r, part, valid); ``start`` and ``stop`` in code
    points; ``part`` marks single words of a run that is a candidate.
    Regular expressions give the matches and the text between them; running sums of the
    lengths give positions, per row and shape.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    hits = F.concat(*[F.coalesce(_hits(F.col("_text"), k), F.array().cast(
        "array<struct<kind:int,gap:int,m:string,l:string,r:string>>")) for k in range(len(SHAPES))])
    rows = keep(documents.select(*carry, text.alias("_text")).select(
        F.monotonically_increasing_id().alias("row"), *[c for c in _names(documents, carry)],
        hits.alias("hits")), "pii-hits")
    one = rows.select("row", F.posexplode("hits").alias("at", "h")).select("row", "at", "h.*").repartition("row")
    w = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("gap") + F.length("m")).over(w)
    placed = one.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("m"))
    placed = placed.where((F.col("kind") != RUN) | _whole(F.col("m"), F.col("r")))
    is_run = F.col("kind") == RUN
    reach = F.max(F.when(is_run, F.col("stop"))).over(
        Window.partitionBy("row").orderBy(F.when(is_run, F.col("start")).otherwise(F.col("stop")), "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("part", (F.col("kind") == CANDIDATE) & F.coalesce(reach > F.col("start"), F.lit(False)))
    return rows.drop("hits"), placed.withColumn("valid", _valid(F.col("kind"), F.col("m"))).drop("gap", "at")


def _names(documents: DataFrame, carry: list[Column]) -> list[str]:
    return documents.select(*carry).columns


def _word(text: Column, pattern: str, group: int = 1) -> Column:
    return F.lower(F.regexp_extract(text, pattern, group))


def _patterns(found: DataFrame) -> DataFrame:
    """One row per match and lexical pattern: two words before, one before and one after."""
    edge = r"[^\p{L}\p{N}]*+"
    one, two = _word("l", rf"(\p{{L}}[\p{{L}}\p{{N}}]*+){edge}$"), _word(
        "l", rf"(\p{{L}}[\p{{L}}\p{{N}}]*+{edge}\p{{L}}[\p{{L}}\p{{N}}]*+){edge}$")
    after = _word("r", rf"^{edge}(\p{{L}}[\p{{L}}\p{{N}}]*+)")
    return found.select("*", F.explode(F.filter(F.array(
        F.when(two != "", F.concat(F.lit("2:"), two)),
        F.when((one != "") & (after != ""), F.concat(F.lit("m:"), one, F.lit("_"), after)),
        F.when(one != "", F.concat(F.lit("1:"), one))), lambda p: p.isNotNull())).alias("pattern"))


def learn(found: DataFrame) -> DataFrame:
    """Unseen identifiers (kind, value) that high-confidence patterns vouch for.

    The graph joins lexical patterns and the identifier-like values seen in them.  Valid
    matches of the fixed shapes are seeds of score 1; a pattern's score for a kind is the
    summed score of its values of that kind over one more than its number of distinct
    values; an unseen value's score is 1 - product(1 - score) over the patterns that count
    (score and distinct known values high enough).  Found values are known in the next
    round; scores only rise, and rounds end once no value is new and the scores stay.  The
    single words of a run of digit groups are judged as part of the run only.  Counts are partial
    aggregates, so a frequent pattern is no hot group.
    """
    value = F.when(F.col("kind") >= CANDIDATE, _core(F.col("m"))).otherwise(F.col("m"))
    graph = keep(_patterns(found.where((F.col("kind") >= CANDIDATE) | F.col("valid"))
                           .withColumn("value", value)
                           .withColumn("of", F.when(F.col("kind") < CANDIDATE, F.col("kind")).otherwise(
                               _loose(F.col("value"))))
                           .where(F.col("of").isNotNull() | ~F.col("part")))
                 .groupBy("pattern", "of", "value").agg(F.max(F.col("kind") < CANDIDATE).alias("seed")), "pii-graph")
    spread = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("n_values"))
    seeds = graph.where("seed").select("of", "value").distinct()
    known, before = keep(seeds.withColumn("score", F.lit(1.0)), "pii-known"), None
    while (now := tuple(known.agg(F.count(F.lit(1)), F.round(F.sum("score"), SETTLED)).first())) != before:
        sums = (graph.where("of is not null").join(known, ["of", "value"]).groupBy("pattern", "of")
                .agg(F.sum("score").alias("mass"), F.count(F.lit(1)).alias("n_known"))
                .where(F.col("n_known") >= MIN_SEEDS))
        rules = (sums.join(spread, "pattern").withColumn("trust", F.col("mass") / (F.col("n_values") + 1))
                 .where(F.col("trust") >= PATTERN_SCORE).select("pattern", "of", "trust"))
        new = (graph.where("not seed and of is not null").join(rules, ["pattern", "of"])
               .groupBy("of", "value").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("score"))
               .where(F.col("score") >= INSTANCE_SCORE))
        after = keep(seeds.withColumn("score", F.lit(1.0)).unionByName(new.join(seeds, ["of", "value"], "left_anti")
                                                                       .select("of", "value", "score")), "pii-known")
        forget(known)
        known, before = after, now
    return known.where("score < 1").select(F.col("of").alias("kind"), "value")


def find(documents: DataFrame, carry: list[Column]) -> DataFrame:
    """(row, carried columns, base, spans): arrays of (kind number, start, stop), by kind and start."""
    rows, found = matches(documents, carry)
    found = keep(found, "pii-found")
    lead = F.length(F.regexp_extract("m", r"^[^\p{L}\p{N}+(]++", 0))
    candidates = found.where(F.col("kind") >= CANDIDATE).withColumn("value", _core(F.col("m"))).select(
        "row", (F.col("start") + lead).alias("start"), "value")
    base = found.where("valid").select("row", "kind", "start", "stop")
    more = (candidates.join(learn(found).withColumnRenamed("kind", "k"), "value")
            .select("row", F.col("k").alias("kind"), "start", (F.col("start") + F.length("value")).alias("stop")))
    taken = base.select("row", F.col("start").alias("s"), F.col("stop").alias("e"))
    clash = (more["row"] == taken["row"]) & (more["start"] < F.col("e")) & (more["stop"] > F.col("s"))
    more = more.join(taken, clash, "left_anti")
    span = F.struct("kind", "start", "stop")
    per_row = (base.withColumn("own", F.lit(True)).unionByName(more.withColumn("own", F.lit(False)))
               .groupBy("row").agg(F.sort_array(F.collect_list(F.when(F.col("own"), span))).alias("base"),
                                   F.sort_array(F.collect_list(span)).alias("spans")))
    none = F.array().cast("array<struct<kind:int,start:bigint,stop:bigint>>")
    return (rows.join(per_row, "row", "left")
            .withColumn("base", F.coalesce("base", none)).withColumn("spans", F.coalesce("spans", none)))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document.

    ``base_sha256`` digests the seed spans, ``spans`` lists all of them, and the counts are
    those of ``spans``.  Null and empty texts have no span (the digest of the empty string);
    repeated rows give repeated rows; other columns are ignored.
    """
    found = find(documents, [F.col("doc_id")])
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
                        as_text(F.col("spans")).alias("spans"))


def redact(documents: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; other columns unchanged.

    Spans depend on the text alone, so they are joined by its digest.  Overlapping spans
    become one, named after the first.  ``n_chars``, where there is one, is the new length.
    """
    digest = F.sha2(F.col("text"), 256)
    spans = (find(documents.where("text is not null").select("text"), [digest.alias("digest")])
             .where(F.size("spans") > 0).groupBy("digest").agg(F.first("spans").alias("spans")))
    by_start = F.sort_array(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    built = F.aggregate(by_start, zero, lambda acc, s: F.when(
        s["start"] < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["stop"]).alias("at"))
    ).otherwise(F.struct(
        F.concat(acc["out"], F.substring(F.col("doc.text"), (acc["at"] + 1).cast("int"),
                                         (s["start"] - acc["at"]).cast("int")),
                 F.element_at(names, s["kind"] + 1)).alias("out"), s["stop"].alias("at"))))
    done = F.concat(built["out"], F.substring(F.col("doc.text"), (built["at"] + 1).cast("int"), F.lit(2147483647)))
    # The document goes as one struct, so none of its columns can clash with these.
    out = (documents.select(F.struct(*documents.columns).alias("doc"), digest.alias("digest")).join(spans, "digest", "left")
           .withColumn("new", F.when(F.col("spans").isNull(), F.col("doc.text")).otherwise(done)))
    return out.select(*[
        F.col("new").alias(c) if c == "text" else
        F.when(F.col("spans").isNull(), F.col(f"doc.`{c}`")).otherwise(F.length("new")).cast("bigint").alias(c)
        if c == "n_chars" else F.col(f"doc.`{c}`") for c in documents.columns])
