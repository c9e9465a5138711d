"""Ranked lexical search over an index with geometric blocks in every posting list.

1. ``postings``: one pass over the documents gives their length and the occurrences of every
   index term, a written table; statistics (N, L, document frequencies) are aggregates of it.
2. ``build_shards``: runs of documents become shards, one written row each.  In a shard the
   posting list of every term is clustered by the similarity of its documents (sketches of their
   whole weighted vectors); a block is a cluster, and its summary is the largest gain of any member
   in every coordinate that some item has together with the list's term.
3. ``search``: a task opens one shard at a time.  For an item it sums the summaries of each block
   of its terms' lists, an exact upper bound of every member's score, skips a block only if that
   bound is below the item's threshold, and scores the members of the others from whole vectors.
   The threshold is the k-th best score so far; a first pass over a fixed share of the shards
   gives every task the same start.

A gain is (10^9 tf) div (1000 tf + 20 m), an integer up to 10^6; a score sums weight * gain.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadprint.llm.common import keep

ITEM_TERMS = 500_000  # terms of the items that go to every task at once; more items are done in blocks
SHARD_POSTINGS = 1 << 19
SHARD_DOCUMENTS = 1 << 14
BLOCK_DOCUMENTS = 256  # mean size of a block of a posting list
SKETCH = 16  # dimensions in which documents are clustered
SEED_SHARE = 16  # one shard in so many gives the first thresholds
NO_ID = np.iinfo(np.int64).max  # place of a missing doc_id in ties; missing ids are marked beside it

# Bytes of terms: A-Z are lower-cased, 0-9, a-z and all bytes of non-ASCII characters stay, the rest parts terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(data: bytes) -> list[bytes]:
    """Terms of a text in UTF-8: maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return data.translate(_FOLD).split()


@dataclass
class Items:
    """Items of a block: distinct terms per item, as numbers into ``vocabulary``."""
    ids: list
    vocabulary: dict[bytes, int]
    terms: list[list[int]]

    def partners(self) -> list[np.ndarray]:
        """Per term: the terms that some item has together with it, itself included."""
        out: list[set[int]] = [set() for _ in self.vocabulary]
        for terms in self.terms:
            for t in terms:
                out[t].update(terms)
        return [np.array(sorted(s), np.int32) for s in out]


def item_blocks(items: DataFrame, item_terms: int = ITEM_TERMS) -> Iterator[Items]:
    """The items in blocks of about ``item_terms`` terms; every row is an item of its own."""
    text = F.coalesce("text", F.lit(""))
    rows = items.select("item_id", text.alias("text"))
    n = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (6 * item_terms)))
    for b in range(n):
        vocabulary: dict[bytes, int] = {}
        ids, terms = [], []
        block = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        for r in block.orderBy("item_id", "text").collect():
            ids.append(r["item_id"])
            terms.append([vocabulary.setdefault(t, len(vocabulary))
                          for t in sorted(set(terms_of(r["text"].encode("utf-8"))))])
        yield Items(ids, vocabulary, terms)


def _lists(values: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.cumsum([0] + [len(v) for v in values])
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(kind)))


def postings(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with at least one term, written once.

    ``n`` counts all its terms, ``terms`` and ``counts`` those of ``vocabulary``, which the caller bounds.
    """
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            ids, sizes, terms, counts = [], [], [], []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = terms_of(data.as_buffer().to_pybytes())
                if not words:
                    continue
                found = Counter(words)
                hits = sorted((known[w], found[w]) for w in found.keys() & known.keys())
                ids.append(doc_id)
                sizes.append(len(words))
                pairs = np.array(hits, np.int64).reshape(-1, 2)
                terms.append(pairs[:, 0])
                counts.append(pairs[:, 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), _lists(terms, np.int32), _lists(counts, np.int32)],
                ["doc_id", "n", "terms", "counts"])

    return keep(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                 F.coalesce("text", F.lit("")).cast("binary").alias("text"))
                .mapInArrow(of, "doc_id bigint, n bigint, terms array<int>, counts array<int>"), "lexical-postings")


@dataclass
class Statistics:
    documents: int  # N
    terms: int  # L
    weights: np.ndarray  # per term of the vocabulary


def statistics(table: DataFrame, n_terms: int) -> Statistics:
    """Corpus-wide numbers; one row per vocabulary term reaches the driver."""
    n, total = table.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(n_terms, np.int64)
    for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()]
    return Statistics(n, total or 0, np.array(weights, np.int64))


def gains(counts: np.ndarray, n: np.ndarray, stats: Statistics) -> np.ndarray:
    """Gain of a term's occurrences in a document of ``n`` terms."""
    tf = counts.astype(np.int64)
    m = 100 - 50 + (50 * n.astype(np.int64) * stats.documents) // stats.terms
    return ((1_000_000_000 * tf) // (1000 * tf + 20 * m)).astype(np.int32)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the elements of rows, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def cluster(points: np.ndarray, block_documents: int) -> np.ndarray:
    """Cluster number of every point: two rounds of nearest centre, from members at even steps."""
    n = -(-len(points) // block_documents)
    if n <= 1:
        return np.zeros(len(points), np.int64)
    centres = points[np.linspace(0, len(points) - 1, n).astype(np.int64)]
    for _ in range(2):
        nearest = np.argmax(points @ centres.T - 0.5 * (centres * centres).sum(1), axis=1)
        size = np.bincount(nearest, minlength=n)
        sums = np.stack([np.bincount(nearest, points[:, k], n) for k in range(points.shape[1])], 1)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres).astype(np.float32)
    return nearest


# Arrays of a shard, with their types.
FIELDS = {"ids": "<i8", "nameless": "?", "row_ends": "<i8", "row_terms": "<i4", "row_gains": "<i4",
          "list_terms": "<i4", "list_blocks": "<i8", "block_ends": "<i8", "members": "<i4",
          "summary_ends": "<i8", "summaries": "<i4"}


def make_shard(ids: np.ndarray, nameless: np.ndarray, sizes: np.ndarray, terms: np.ndarray, gain: np.ndarray,
               weights: np.ndarray, partners: list[np.ndarray], directions: np.ndarray, block_documents: int) -> dict:
    """Arrays of FIELDS for documents in the order of ties: vectors, blocks of every list, summaries."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
    value = (weights[terms] * gain.astype(np.float32)).astype(np.float32)
    norm = np.sqrt(np.bincount(doc, value * value, len(ids)))
    value /= np.maximum(norm, 1e-9)[doc].astype(np.float32)
    points = np.stack([np.bincount(doc, value * directions[terms, k], len(ids))
                       for k in range(directions.shape[1])], 1).astype(np.float32)
    order = np.argsort(terms, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(terms[order]) != 0]) if len(order) else np.zeros(0, np.int64)
    list_terms, list_blocks, block_ends, members, summaries = [], [], [], [], []
    where = np.full(len(weights), -1, np.int64)
    done = 0
    for s, e in zip(cuts, np.r_[cuts[1:], len(order)]):
        term = int(terms[order[s]])
        rows = doc[order[s:e]]
        block = cluster(points[rows], block_documents)
        by_block = np.argsort(block, kind="stable")
        rows = rows[by_block]
        block = np.unique(block[by_block], return_inverse=True)[1]
        n, with_ = int(block[-1]) + 1, partners[term]
        where[with_] = np.arange(len(with_))
        at = _ragged(starts[rows], sizes[rows])
        column = where[terms[at]]
        row = np.repeat(block, sizes[rows])
        used = column >= 0
        top = np.zeros(n * len(with_), np.int32)
        np.maximum.at(top, row[used] * len(with_) + column[used], gain[at][used])
        where[with_] = -1
        list_terms.append(term)
        list_blocks.append(n)
        block_ends.append(done + np.cumsum(np.bincount(block)))
        members.append(rows)
        summaries.append(top)
        done += len(rows)
    cat = lambda z: np.concatenate(z) if z else np.zeros(0, np.int64)
    got = {"ids": ids, "nameless": nameless, "row_ends": ends, "row_terms": terms, "row_gains": gain,
           "list_terms": np.array(list_terms), "list_blocks": np.cumsum(list_blocks), "block_ends": cat(block_ends),
           "members": cat(members), "summary_ends": np.cumsum([len(t) for t in summaries]), "summaries": cat(summaries)}
    return {k: np.asarray(got[k]).astype(kind) for k, kind in FIELDS.items()}


SHARD = "shard bigint, " + ", ".join(f"{name} binary" for name in FIELDS)


def build_shards(table: DataFrame, stats: Statistics, partners: list[np.ndarray], shard_postings: int = SHARD_POSTINGS,
                 shard_documents: int = SHARD_DOCUMENTS, block_documents: int = BLOCK_DOCUMENTS) -> DataFrame:
    """The written index: one row per shard, its arrays compressed."""
    sent = table.sparkSession.sparkContext.broadcast((stats.weights, partners))  # bounded by ITEM_TERMS
    documents, total = stats.documents, stats.terms

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext
        weights, with_ = sent.value
        directions = np.random.default_rng(11).standard_normal((max(1, len(weights)), SKETCH)).astype(np.float32)
        zip_ = zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 32

        def out(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts).combine_chunks()
            ids = t["doc_id"].combine_chunks()
            nameless = ids.is_null().to_numpy(zero_copy_only=False)
            order = np.lexsort((ids.fill_null(NO_ID).to_numpy(), nameless))
            t = t.take(pa.array(order))
            sizes = t["terms"].combine_chunks().value_lengths().to_numpy().astype(np.int64)
            terms, counts = (t[c].combine_chunks().flatten().to_numpy() for c in ("terms", "counts"))
            gain = gains(counts, np.repeat(t["n"].to_numpy(), sizes), Statistics(documents, total, weights))
            shard = make_shard(t["doc_id"].combine_chunks().fill_null(NO_ID).to_numpy(), nameless[order], sizes, terms, gain,
                               weights, with_, directions, block_documents)
            return pa.RecordBatch.from_pydict({"shard": pa.array([number], pa.int64())} | {
                k: pa.array([zip_.compress(v.tobytes())], pa.binary()) for k, v in shard.items()})

        parts, held, rows = [], 0, 0
        for batch in batches:
            batch = batch.filter(pa.compute.greater(pa.compute.list_value_length(batch.column("terms")), 0))
            sizes = pa.compute.list_value_length(batch.column("terms")).to_numpy().astype(np.int64)
            done = 0
            while done < len(sizes):
                room = max(1, min(shard_documents - rows, int(np.searchsorted(
                    np.cumsum(sizes[done:]), shard_postings - held, side="right"))))
                parts.append(batch.slice(done, room))
                held, rows = held + int(sizes[done:done + room].sum()), rows + len(parts[-1])
                done += room
                if done < len(sizes) or held >= shard_postings or rows >= shard_documents:
                    yield out(parts)
                    number, parts, held, rows = number + 1, [], 0, 0
        if parts:
            yield out(parts)

    return keep(table.mapInArrow(pack, SHARD), "lexical-shards")


def best(scores: np.ndarray, nameless: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id, missing ids last."""
    return np.lexsort((ids, nameless, -scores))[:k]


class Shard:
    def __init__(self, arrays: dict[str, np.ndarray], partners: list[np.ndarray]):
        self.__dict__.update(arrays)
        self.row_starts = np.concatenate([[0], self.row_ends[:-1]])
        self.block_starts = np.concatenate([[0], self.block_ends[:-1]])
        blocks = np.concatenate([[0], self.list_blocks])
        tops = np.concatenate([[0], self.summary_ends])
        self.lists = {int(t): (int(blocks[k]), partners[t],
                               self.summaries[tops[k]:tops[k + 1]].reshape(-1, len(partners[t])))
                      for k, t in enumerate(self.list_terms.tolist())}

    def score(self, rows: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Whole scores of documents; ``weight_of`` is zero for terms that the item lacks."""
        sizes = self.row_ends[rows] - self.row_starts[rows]
        at = _ragged(self.row_starts[rows], sizes)
        return np.add.reduceat(weight_of[self.row_terms[at]] * self.row_gains[at], np.cumsum(sizes) - sizes)

    def top(self, terms: np.ndarray, weights: np.ndarray, weight_of: np.ndarray, floor: int, k: int):
        """(rows, scores, blocks skipped) with at least the shard's k best documents of score ``floor`` or more."""
        numbers, bounds = [], []
        for t in terms.tolist():
            if t in self.lists:
                first, with_, top = self.lists[t]
                bounds.append(top[:, np.searchsorted(with_, terms)].astype(np.int64) @ weights)
                numbers.append(first + np.arange(len(top)))
        if not numbers:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        numbers, bounds = np.concatenate(numbers), np.concatenate(bounds)
        order = np.argsort(-bounds, kind="stable")
        numbers, bounds = numbers[order], bounds[order]
        seen = np.zeros(len(self.ids), bool)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done, step = 0, 4
        while done < len(numbers) and bounds[done] >= floor:
            now = numbers[done:done + step][bounds[done:done + step] >= floor]
            sizes = self.block_ends[now] - self.block_starts[now]
            new = np.unique(self.members[_ragged(self.block_starts[now], sizes)])
            new = new[~seen[new]]
            seen[new] = True
            if len(new):
                got = self.score(new, weight_of)
                rows, scores = np.concatenate([rows, new]), np.concatenate([scores, got])
                held = np.lexsort((rows, -scores))[:k]  # rows are in the order of ties
                rows, scores = rows[held], scores[held]
                if len(rows) == k:
                    floor = max(floor, int(scores[-1]))
            done, step = done + len(now), step * 2
        good = scores >= floor
        return rows[good], scores[good], len(numbers) - done


def search_shards(shards: DataFrame, items: Items, stats: Statistics, partners: list[np.ndarray], k: int,
                  floors: np.ndarray) -> DataFrame:
    """(item, doc_id, score): from every task the k best documents of each item at its floor or above."""
    sent = shards.sparkSession.sparkContext.broadcast(
        (stats.weights, partners, [np.array(t, np.int64) for t in items.terms], floors))  # bounded by ITEM_TERMS

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unzip = zstandard.ZstdDecompressor()
        weights, with_, terms, floor = sent.value
        weight_of = np.zeros(len(weights), np.int64)
        held = [tuple(np.zeros(0, t) for t in (np.int64, bool, np.int64)) for _ in terms]
        for batch in batches:
            for n in range(batch.num_rows):
                shard = Shard({c: np.frombuffer(unzip.decompress(batch.column(c)[n].as_buffer()), kind)
                               for c, kind in FIELDS.items()}, with_)
                for q, t in enumerate(terms):
                    if not len(t):
                        continue
                    weight_of[t] = weights[t]
                    scores, nameless, ids = held[q]
                    low = max(int(floor[q]), int(scores[-1]) if len(scores) == k else 1)
                    rows, got, _ = shard.top(t, weights[t], weight_of, low, k)
                    weight_of[t] = 0
                    if len(rows):
                        scores = np.concatenate([scores, got])
                        nameless = np.concatenate([nameless, shard.nameless[rows]])
                        ids = np.concatenate([ids, shard.ids[rows]])
                        first = best(scores, nameless, ids, k)
                        held[q] = scores[first], nameless[first], ids[first]
        for q, (scores, nameless, ids) in enumerate(held):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), q), pa.int32()), pa.array(ids, pa.int64(), mask=nameless),
                     pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    return shards.mapInArrow(of, "item int, doc_id bigint, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def search(documents: DataFrame, items: DataFrame, k: int = 50, item_terms: int = ITEM_TERMS,
           shard_postings: int = SHARD_POSTINGS, shard_documents: int = SHARD_DOCUMENTS,
           block_documents: int = BLOCK_DOCUMENTS, seed_share: int = SEED_SHARE) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item, score above 0.

    ``documents`` has whole-number doc_id and text, ``items`` item_id and text.  A term's weight is
    floor(1000 ln((2N+2)/(2df+1))); a document's score sums weight * ((10^9 tf) div (1000 tf + 20 m))
    with m = 100 - 50 + ((50 n N) div L) over the item's distinct terms.  Equal scores rank by doc_id.
    The result is exact at every parameter.  Items above ``item_terms`` terms in all are worked
    through in blocks, each with an index of its own terms.

    Null and empty texts have no terms and count in nothing; documents without id count and rank
    after equal scores; every row of either table stands for itself, so repeated documents take a
    rank each and repeated items give repeated rows; an empty table on either side gives no rows;
    other columns are ignored.  Long texts count whole.
    """
    spark: SparkSession = documents.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for block in item_blocks(items, item_terms):
        if not block.vocabulary:
            continue
        table = postings(documents, block.vocabulary)
        stats = statistics(table, len(block.vocabulary))
        partners = block.partners()
        shards = build_shards(table, stats, partners, shard_postings, shard_documents, block_documents)
        floors = np.ones(len(block.ids), np.int64)
        seeds = shards.where(F.pmod(F.xxhash64("shard"), F.lit(seed_share)) == 0)
        for r in _ranked(search_shards(seeds, block, stats, partners, k, floors), k).where(F.col("rank") == k).collect():
            floors[r["item"]] = r["score"]  # k documents reach it, so no document below it can rank
        found = _ranked(search_shards(shards, block, stats, partners, k, floors), k)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {kind}")
        out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
