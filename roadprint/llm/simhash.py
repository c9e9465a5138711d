"""SimHash near-dedup by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadprint.llm.common import components, keep

SHINGLE_WORDS, MAX_BITS = 4, 4
SEED = 42  # of XXH64
CHUNK = 1 << 16  # shingles hashed at a time
WIDE_RUN = 64  # runs of one key above this are walked instead of paired


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a whole text: a bit is 1 if set in over half the shingle hashes."""
    import xxhash
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z change, ASCII white space splits
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = [xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle_words]), SEED)
                for i in range(at, min(n, at + CHUNK))]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprints(documents: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, row, fp) of every document; ``row`` is a digest of id and text, a null text counts as empty."""
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle_words) for t in texts], dtype="int64")
    return documents.select("doc_id", row_digest().alias("row"), of("text").alias("fp"))


def row_digest() -> Column:
    """The same for rows that repeat both doc_id and text."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                             F.coalesce(F.md5("text"), F.lit(""))))


def covering_masks(max_bits: int, bits: int = 64) -> list[int]:
    """2^(max_bits+1) - 1 masks such that any ``max_bits`` positions lie outside one of them.

    Each position carries a vector of max_bits + 1 bits; mask v holds the positions
    whose vector has an odd product with v.  The max_bits vectors of the differing
    positions never span the whole space, so some v is orthogonal to all of them.
    """
    vectors = [i % (2 ** (max_bits + 1) - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)
            for v in range(1, 2 ** (max_bits + 1))]


def _walk(x: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """Spanning links of one key's fingerprints: each is reached once, none is paired with all."""
    left, right = [], []
    todo = np.arange(len(x))
    while len(todo):
        edge, todo = [todo[0]], todo[1:]
        while edge and len(todo):
            at = edge.pop()
            near = np.bitwise_count(x[todo] ^ x[at]) <= max_bits
            found, todo = todo[near], todo[~near]
            left += [at] * len(found)
            right += found.tolist()
            edge += found.tolist()
    return left, right


def links_of_runs(keys: np.ndarray, x: np.ndarray, ids: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Links (a, b) between rows of one key (sorted together) within ``max_bits``."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    a, b = [], []
    for s, m in zip(starts[sizes > WIDE_RUN], sizes[sizes > WIDE_RUN]):
        left, right = _walk(x[s:s + m], max_bits)
        a.append(ids[s + np.array(left, np.int64)])
        b.append(ids[s + np.array(right, np.int64)])
    wide = np.repeat(sizes > WIDE_RUN, sizes)
    keys, x, ids = keys[~wide], x[~wide], ids[~wide]
    for d in range(1, min(WIDE_RUN, int(sizes[sizes <= WIDE_RUN].max(initial=1)))):
        near = (keys[d:] == keys[:-d]) & (np.bitwise_count(x[d:] ^ x[:-d]) <= max_bits)
        a.append(ids[d:][near])
        b.append(ids[:-d][near])
    cat = lambda z: np.concatenate(z) if z else np.zeros(0, np.int64)
    return pa.RecordBatch.from_pydict({"a": cat(a).astype(np.int64), "b": cat(b).astype(np.int64)})


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between ids of ``prints(id, fp)`` (distinct fp) at most ``max_bits`` apart.

    Every fingerprint goes into one table per covering mask, so every pair within the
    radius meets in some table; pairs that meet are checked on all 64 bits.  Inside one
    key only a spanning set of links leaves the task.
    """
    masks = covering_masks(max_bits)
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    dealt = prints.select("id", "fp", F.explode(F.array(*[
        F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m).cast("bigint"))) for k, m in enumerate(signed)
    ])).alias("key")).repartition("key").sortWithinPartitions("key")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of the last key, which may go on in the next batch
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in ("key", "fp", "id")]
            held = rows if held is None else [np.concatenate(z) for z in zip(held, rows)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if cut:
                yield links_of_runs(held[0][:cut], held[1][:cut].view(np.uint64), held[2][:cut], max_bits)
                held = [z[cut:] for z in held]
        if held is not None and len(held[0]):
            yield links_of_runs(held[0], held[1].view(np.uint64), held[2], max_bits)

    return dealt.mapInArrow(meet, "a bigint, b bigint")


def _groups(documents: DataFrame, shingle_words: int, max_bits: int) -> DataFrame:
    """(doc_id, row, fp, node, component_id): ``node`` is the smallest fingerprint reachable.

    Fingerprints are the nodes, so those that only rows without doc_id hold link like any other.
    """
    prints = keep(fingerprints(documents, shingle_words), "simhash")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("id"))
    comp = components(near_links(nodes.select(F.col("fp").alias("id"), "fp"), max_bits))
    of = nodes.join(comp, nodes["fp"] == comp["node"], "left").select(
        "fp", "id", F.coalesce("component", "fp").alias("node"))
    lowest = of.groupBy("node").agg(F.min("id").alias("component_id"))
    return prints.join(of.select("fp", "node").join(lowest, "node"), "fp")


def near_duplicates(documents: DataFrame, shingle_words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    ``component_id`` is the smallest doc_id reachable by links of at most ``max_bits``
    differing bits (itself included).  Texts with one fingerprint are first merged
    (a partial aggregate), so a large group of copies is one node.

    Null and empty texts have fingerprint zero and link like any other; repeated rows
    share a component; rows without doc_id link like any other and never name a component
    (null if no row of it has an id); an empty table gives no rows; long texts count whole;
    other columns are ignored.
    """
    return _groups(documents, shingle_words, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, shingle_words: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate group, columns unchanged: that with the smallest doc_id.

    If several rows of the group have that doc_id, or no row has one, the row with the smallest
    digest of id and text stays; of rows that repeat both, the smallest by the other columns.
    Null and empty texts are near-duplicates of each other; an empty table stays empty; columns
    may have any names.
    """
    found = _groups(documents, shingle_words, max_bits)
    chosen = keep(found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                  .groupBy("node", "row").agg(F.count(F.lit(1)).alias("n"))
                  .groupBy("node").agg(F.min(F.struct("row", "n")).alias("r")).select("r.row", "r.n"), "simhash-kept")
    rows = documents.select(F.struct(*documents.columns).alias("doc"), row_digest().alias("row"))
    once = rows.join(chosen.where("n = 1").select("row"), "row", "left_semi").select("doc.*")
    if chosen.where("n > 1").isEmpty():
        return once
    again = rows.join(chosen.where("n > 1").select("row"), "row", "left_semi")
    return once.unionByName(again.groupBy("row").agg(F.min("doc").alias("doc")).select("doc.*"))
