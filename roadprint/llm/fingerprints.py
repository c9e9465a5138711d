"""Document fingerprints by consistent weighted sampling.

A document is a bag of words, each weighted by its number of occurrences s.  For every sample a
word has Gamma(2, 1) variates r and c and a uniform b; it is taken at t = floor(ln s / r + b) with
a = c exp(-r (t - b + 1)), and the word with the smallest a is the sample.  Two documents draw the
same (word, t) with a probability equal to their generalised Jaccard similarity, sum(min) / sum(max).

The variates come from hashes of word and sample number.  With E1, E2 exponential and u uniform,

    c = E1 + E2,   v = E1 / c,   r = -ln(v u),   b = ln u / ln(v u)

are independent and so distributed, and a = E1 exp(-r t).  A word that occurs once has t = 0 and
a = E1, which falls with its hash: those words need a maximum of hashes and no logarithm.  The
smallest a differs between any two (word, t), so it stands for the sample, and a sample is a
partial aggregate: no order, no ties.

All of it is built-in expressions.  Texts are dealt once by key (half of each once more, to the
document before); word counts and samples reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadprint.functions.columns import dense_index_total
from roadprint.llm.common import keep

SAMPLES = 64
TOGETHER = 8  # samples drawn per row; a row is repeated for the rest
DIGITS = 4  # hexadecimal digits of a sample in the fingerprint
SPACE = r"[\x20\x09-\x0D]+"


def _unit(h: Column) -> Column:
    """A number strictly between 0 and 1 from the upper 53 bits of a hash."""
    return (F.shiftrightunsigned(h, 11) + F.lit(0.5)) * F.lit(2.0 ** -53)


def _exponential(h: Column) -> Column:
    return -F.log(_unit(h))


def heavy_sample(h: Column, weight: Column) -> Column:
    """a of a word (hash ``h`` of word and sample number) that weighs more than one."""
    second = F.xxhash64(h)
    e1, e2, u = _exponential(h), _exponential(second), _unit(F.xxhash64(second))
    r = -F.log(e1 / (e1 + e2) * u)
    t = F.floor((F.log(weight.cast("double")) - F.log(u)) / r)
    return e1 * F.exp(-r * t)


def bags(texts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, word, side, weight) of every row's words; ``word`` is a 64-bit hash.

    ``columns`` are one or two text columns.  side 0 and 1 are the words of one of them, side 2 words
    that both hold equally often, so a word that two versions share is sampled once.
    """
    on = lambda i, j: F.lit(1 if i == j else 0)
    versions = F.explode(F.array(*[F.struct(F.col(c).alias("t"), on(i, 0).alias("n0"), on(i, 1).alias("n1"))
                                   for i, c in enumerate(columns)])).alias("v")
    words = (texts.select(*keys, versions)
             .select(*keys, F.explode(F.split("v.t", SPACE)).alias("w"), "v.n0", "v.n1").where("w != ''")
             .groupBy(*keys, F.xxhash64("w").alias("word"))
             .agg(F.sum("n0").cast("int").alias("n0"), F.sum("n1").cast("int").alias("n1")))
    side = lambda i, n: F.struct(F.lit(i).alias("side"), F.col(n).alias("weight"))
    sides = F.when(F.col("n0") == F.col("n1"), F.array(side(2, "n0"))).otherwise(
        F.array(side(0, "n0"), side(1, "n1")))
    return words.select(*keys, "word", F.explode(sides).alias("s")).select(
        *keys, "word", "s.side", "s.weight").where("weight > 0")


def signatures(bag: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """(keys, side, fingerprint) for sides 0 and 1 of ``bags``: ``samples`` pieces of four hexadecimal digits.

    Rows without words have no signature; see ``NO_WORDS``.
    """
    steps = range(min(TOGETHER, samples))
    rows = bag.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(samples // len(steps) - 1))))
    h = [F.xxhash64("word", "step", F.lit(i)) for i in steps]
    drawn = rows.groupBy(*keys, "side", "step").agg(
        *[F.max(F.when(F.col("weight") == 1, F.shiftrightunsigned(h[i], 11))).alias(f"top{i}") for i in steps],
        *[F.min(F.when(F.col("weight") > 1, heavy_sample(h[i], F.col("weight")))).alias(f"low{i}") for i in steps])
    one = lambda i: F.least(-F.log((F.col(f"top{i}") + F.lit(0.5)) * F.lit(2.0 ** -53)), f"low{i}")
    both = F.explode(F.when(F.col("side") == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array("side"))).alias("of")
    merged = (drawn.select(*keys, both, "step", *[one(i).alias(f"a{i}") for i in steps])
              .groupBy(*keys, "of", "step").agg(*[F.min(f"a{i}").alias(f"a{i}") for i in steps]))
    # Sixteen bits of a sample in single precision, so that the last bit of a logarithm does not
    # matter; never 0000, which stands for no words.
    piece = lambda i: F.lpad(F.lower(F.hex(F.pmod(F.xxhash64(F.col(f"a{i}").cast("float")), F.lit(16 ** DIGITS - 1)) + 1)), DIGITS, "0")
    pieces = merged.select(*keys, "of", F.struct("step", F.concat(*[piece(i) for i in steps]).alias("p")).alias("s"))
    return pieces.groupBy(*keys, F.col("of").alias("side")).agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list("s")), lambda s: s["p"])).alias("fingerprint"))


def no_words(samples: int = SAMPLES) -> Column:
    """The fingerprint of a text without words."""
    return F.lit("0" * (DIGITS * samples))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints: an estimate of the generalised Jaccard similarity."""
    at = lambda x, i: F.substring(x, i * F.lit(DIGITS) + F.lit(1), F.lit(DIGITS))
    equal = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: at(a, i) == at(b, i))
    return F.size(equal) / F.lit(float(samples))


def _keyed(documents: DataFrame) -> DataFrame:
    """(doc_id, text, key): ``key`` is the digest of id and text, null texts empty."""
    text = F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), text)))
    return documents.select("doc_id", text.alias("text"), key.alias("key"))


def edited_pairs(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every distinct document with its edited text, and the order of documents.

    The first has (key, text, edited): the last half of the characters (rounded down) is replaced by as many
    first characters of the next document.  The second has (key, doc_id, n_chars, copies, next_key).
    """
    docs = _keyed(documents)
    narrow = docs.groupBy("doc_id", "key", F.char_length("text").cast("bigint").alias("n_chars")).agg(
        F.count(F.lit(1)).alias("copies"))
    placed, total = dense_index_total(narrow, [F.col("doc_id").desc_nulls_last(), F.col("key")])
    after = placed.select(F.pmod(F.col("pos") - 1, F.lit(max(total, 1))).alias("pos"), F.col("key").alias("next_key"))
    order = keep(placed.join(after, "pos").select("key", "doc_id", "n_chars", "copies", "next_key"), "fingerprint-order")
    texts = docs.groupBy("key").agg(F.first("text").alias("text"))  # equal keys have equal texts
    sent = (texts.join(order.select(F.col("next_key").alias("key"), F.col("key").alias("to"), "n_chars"), "key")
            .select("to", F.substring("text", F.lit(1), F.floor(F.col("n_chars") / 2).cast("int")).alias("front")))
    n = F.char_length("text")
    kept = F.substring("text", F.lit(1), n - F.floor(n / 2).cast("int"))
    pairs = texts.join(sent, texts["key"] == sent["to"]).select("key", "text", F.concat(kept, "front").alias("edited"))
    return pairs, order


def fingerprint_edits(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Documents are ordered by descending doc_id, the next of the last is the first.  The edited text keeps the
    first half of the code points (the longer one) and goes on with as many of the next document as it lost,
    or all it has.  ``near_edited`` and ``near_next`` are the share of equal samples with the fingerprint of the
    edited text and of the next document, an estimate of their generalised Jaccard similarity over
    word counts; words are runs of anything but space and \\t \\n \\v \\f \\r.

    Null texts are empty; a text without words has a fingerprint of zeros, like any other such text and unlike
    all else; documents that share a doc_id are ordered by a digest of their text; repeated rows have one place in
    the order and give repeated rows; rows without doc_id come last; a single document is its own next; an
    empty table gives no rows; other columns are ignored.  Long texts count whole.
    """
    if samples % min(TOGETHER, samples):
        raise ValueError(f"samples must be a multiple of {TOGETHER}")
    pairs, order = edited_pairs(documents)
    drawn = signatures(bags(pairs, ["key"], ["text", "edited"]), ["key"], samples)
    of = lambda i: F.max(F.when(F.col("side") == i, F.col("fingerprint")))
    both = drawn.groupBy("key").agg(of(0).alias("own"), of(1).alias("edited"))
    edits = pairs.select("key", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    found = keep(edits.join(both, "key", "left").select(
        "key", "edited_sha256", F.coalesce("own", no_words(samples)).alias("fingerprint"),
        F.coalesce("edited", no_words(samples)).alias("edited_fingerprint")), "fingerprints")
    next_ = found.select(F.col("key").alias("next_key"), F.col("fingerprint").alias("next_fingerprint"))
    rows = order.join(found, "key").join(next_, "next_key").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"))
