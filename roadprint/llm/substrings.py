"""Substring dedup with prefix-partitioned suffix trees over words.

A suffix begins at every word that has ``min_words`` words from it to the end of its
document.  Its key holds hashes of its first word, its first four words and its first
``min_words`` words, from the highest bits down: 12, 12 and 64 bits.  Words are hashed by XXH3,
runs of words by a chain in which every word mixes all bits, so no words can be made to cancel out.  Sorting keys sorts
suffixes into the leaves of a tree cut off at that depth (a sort of fingerprints of fixed
depth; no suffix is compared beyond it): runs that agree in the upper bits hang under one
node, and runs of equal keys are the leaves of one deep internal node, a repeat.  The first
64 bits of a key are one number (key), the last 24 another (tail).

1. Documents are packed into blocks, written once (text compressed), with the number of
   distinct suffixes per first-word prefix.
2. Prefixes are put together, or lengthened where a single word is too frequent, into
   groups of about GROUP_SUFFIXES suffixes.  Every block sends each group its distinct
   keys, with the smallest doc_id of each: a passage in a third of all documents
   arrives once per block, not once per document.
3. A task builds the subtree of one group at a time and answers each block with one bit
   per key: whether the deep node holds a smaller doc_id than the block does.
4. Blocks meet their answers; repeats that touch become maximal spans, which are removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadprint.llm.common import keep

MIN_WORDS = 13
BLOCK_BYTES = 2 << 20  # text of a block; a longer document is a block of its own
GROUP_SUFFIXES = 1 << 20  # distinct suffixes (of a block each) that a subtree should hold
PREFIX_BITS = 12  # of the key, for each of the first word and the first four words
NO_ID = np.iinfo(np.int64).max  # order of a null doc_id, which is marked beside it
BLOCK = "block bigint, doc_ids binary, nameless binary, lengths binary, data binary, suffixes array<int>"
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
WORDS_HELD = 500_000  # distinct words whose hashes a task remembers; with more it starts afresh at the next block
STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits."""
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mul)
    return x ^ (x >> np.uint64(31))


class _Numbers(dict):
    """Words and their numbers; a word not met before gets the next."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Hasher:
    """Hashes words (XXH3 of their bytes) and runs of words, one word after the other."""

    def __init__(self):
        self.held, self.hashes = _Numbers(), np.zeros(0, np.uint64)

    def words(self, words: list[bytes]) -> np.ndarray:
        import xxhash
        if len(self.held) > WORDS_HELD:
            self.held, self.hashes = _Numbers(), np.zeros(0, np.uint64)
        number = np.fromiter(map(self.held.__getitem__, words), np.int64, len(words))
        if len(self.held) > len(self.hashes):  # numbers follow the order of insertion
            new = map(xxhash.xxh3_64_intdigest, islice(self.held, len(self.hashes), None))
            self.hashes = np.concatenate([self.hashes, np.fromiter(new, np.uint64, len(self.held) - len(self.hashes))])
        return self.hashes[number]

    def keys(self, data: bytes, lengths: np.ndarray, min_words: int):
        """(number of words per document, first word of every suffix, its document, its key, its tail)."""
        raw = np.frombuffer(data, np.uint8)
        inside = ~_SPACE[raw]
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1 if len(raw) else np.zeros(0, np.int64)
        if len(raw) and inside[0]:
            starts = np.concatenate([[0], starts])
        doc = np.searchsorted(np.cumsum(lengths + 1), starts, side="right")
        n_words = np.bincount(doc, minlength=len(lengths))
        last = np.cumsum(n_words)[doc]  # one past the last word of the document of each word
        at = np.flatnonzero(np.arange(len(starts)) + min_words <= last)
        if not len(at):
            return n_words, at, doc[at], np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        words = self.words(data.split())
        b = np.uint64(PREFIX_BITS)
        top = np.uint64(64) - b
        m = len(words) - min_words + 1  # windows, those across documents too
        run, spread = np.full(m, STEP), np.empty(m, np.uint64)
        for k in range(min_words):  # every step mixes all bits, so neither order nor repeats cancel out
            np.bitwise_xor(run, words[k:k + m], out=run)
            np.multiply(run, STEP, out=run)
            np.right_shift(run, np.uint64(32), out=spread)
            np.bitwise_xor(run, spread, out=run)
            if k == min(4, min_words) - 1:
                four = _mix(run[at]) >> top
        deep = _mix(run[at])
        first = words[at] >> top
        tail = deep & ((np.uint64(1) << (b + b)) - np.uint64(1))
        return n_words, at, doc[at], (first << top) | (four << (top - b)) | (deep >> (b + b)), tail


def _sorted(keys: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key and tail, and which of the sorted differ from the one before."""
    order = np.argsort(keys, kind="stable")
    k, t = keys[order], tails[order]
    if ((k[1:] == k[:-1]) & (t[1:] != t[:-1])).any():  # seldom: only then tails matter for the order
        order = np.lexsort((tails, keys))
        k, t = keys[order], tails[order]
    return order, np.r_[True, (k[1:] != k[:-1]) | (t[1:] != t[:-1])] if len(k) else np.zeros(0, bool)


def _distinct(keys: np.ndarray, tails: np.ndarray, ids: np.ndarray):
    """Distinct keys in order with their tails, the smallest id of each, and the place of every suffix among them."""
    order, new = _sorted(keys, tails)
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    low = np.minimum.reduceat(ids[order], at) if len(at) else np.zeros(0, np.int64)
    return keys[order[at]], tails[order[at]], low, place


def _pack(x: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as one plane per byte, without the planes that are all zero."""
    planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)
    used = 8
    while used and not planes[:, used - 1].any():
        used -= 1
    return bytes([used]) + np.ascontiguousarray(planes[:, :used].T).tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    used = data[0]
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :used] = np.frombuffer(data, np.uint8, n * used, 1).reshape(used, n).T
    return planes.reshape(-1).view("<u8")


def _open_block(row, hasher: Hasher, min_words: int):
    import zstandard
    data = zstandard.ZstdDecompressor().decompress(row.data)
    ids = np.frombuffer(row.doc_ids, "<i8")
    lengths = np.frombuffer(row.lengths, "<i8")
    return data, ids, lengths, *hasher.keys(data, lengths, min_words)


def blocks_of(documents: DataFrame, min_words: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Written blocks of documents: see BLOCK.  Ids are part of the table, so reruns read the same."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext
        hasher, zip_ = Hasher(), zstandard.ZstdCompressor(level=3)
        block = TaskContext.get().partitionId() << 32
        ids, nameless, texts, size = [], [], [], 0

        def out() -> pd.DataFrame:
            data = b"".join(t + b"\n" for t in texts)
            lengths = np.array([len(t) for t in texts], "<i8")
            id_of = np.array(ids, "<i8")
            _, _, doc, keys, tails = hasher.keys(data, lengths, min_words)
            top = _distinct(keys, tails, id_of[doc])[0] >> np.uint64(64 - PREFIX_BITS)
            return pd.DataFrame({"block": [block], "doc_ids": [id_of.tobytes()],
                                 "nameless": [np.array(nameless, bool).tobytes()], "lengths": [lengths.tobytes()],
                                 "data": [zip_.compress(data)],
                                 "suffixes": [np.bincount(top.astype(np.int64), minlength=1 << PREFIX_BITS)]})

        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                nameless.append(doc_id is None)
                ids.append(NO_ID if doc_id is None else int(doc_id))
                texts.append((text or "").encode("utf-8"))
                size += len(texts[-1]) + 1
                if size >= block_bytes:
                    yield out()
                    block, ids, nameless, texts, size = block + 1, [], [], [], 0
        if ids:
            yield out()

    # The id goes as text: as a number, a column with nulls would become floating point.
    return keep(documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
                .mapInPandas(pack, BLOCK), "substring-blocks")


def plan_groups(blocks: DataFrame, group_suffixes: int) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of every first-word prefix.

    Light prefixes share a group; a heavy one is cut, by the bits of longer prefixes, into as
    many as its count asks for.  The counts cover all suffixes; 2^PREFIX_BITS numbers
    reach the driver, at any size.
    """
    counts = np.zeros(1 << PREFIX_BITS, np.int64)
    for r in (blocks.select(F.posexplode("suffixes").alias("prefix", "n")).groupBy("prefix")
              .agg(F.sum("n").alias("n")).collect()):
        counts[r["prefix"]] = r["n"]
    parts = np.maximum(1, -(-counts // group_suffixes))
    first, group, load = np.zeros(len(counts), np.int64), 0, 0
    for p, n in enumerate(counts.tolist()):
        if load and (load + n > group_suffixes or parts[p] > 1):
            group, load = group + 1, 0
        first[p] = group
        load += n
        if parts[p] > 1:
            group, load = group + int(parts[p]), 0
    return first, parts


def _group_of(keys: np.ndarray, first: np.ndarray, parts: np.ndarray) -> np.ndarray:
    top = (keys >> np.uint64(64 - PREFIX_BITS)).astype(np.int64)
    rest = (keys << np.uint64(PREFIX_BITS)) >> np.uint64(32)
    return first[top] + ((rest * parts[top].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)


def _send(batches: Iterator[pd.DataFrame], first: np.ndarray, parts: np.ndarray,
          min_words: int) -> Iterator[pd.DataFrame]:
    """Each block's distinct keys, dealt to groups: (grp, block, n, start, keys, tails, low, ids)."""
    hasher = Hasher()
    for b in batches:
        for row in b.itertuples():
            _, ids, _, _, _, doc, keys, tails = _open_block(row, hasher, min_words)
            key, tail, low, _ = _distinct(keys, tails, ids[doc])
            if not len(key):
                continue
            group = _group_of(key, first, parts)  # rises with the key
            cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            out = []
            for s, e in zip(cuts, np.r_[cuts[1:], len(key)]):
                base = int(low[s:e].min())
                out.append((int(group[s]), row.block, int(e - s), int(key[s] >> np.uint64(1)), int(key[s] & np.uint64(1)),
                            _pack(np.diff(key[s:e])), _pack(tail[s:e]), base, _pack((low[s:e] - base).astype(np.uint64))))
            yield pd.DataFrame(out, columns=["grp", "block", "n", "start", "odd", "keys", "tails", "low", "ids"])


SENT = "grp bigint, block bigint, n bigint, start bigint, odd bigint, keys binary, tails binary, low bigint, ids binary"


def subtree(keys: np.ndarray, tails: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaf order of the suffixes of a group, and the smallest id under each leaf's deep node."""
    order, new = _sorted(keys, tails)
    node = np.cumsum(new) - 1  # leaves that agree to full depth share a node
    return order, np.minimum.reduceat(ids[order], np.flatnonzero(new))[node]


def _answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by group: one subtree at a time, one bit per key back to each block."""
    held: list = []

    def solve() -> pd.DataFrame:
        sizes = [r.n for r in held]
        keys = np.concatenate([np.cumsum(np.r_[np.uint64(r.start) << np.uint64(1) | np.uint64(r.odd),
                                               _unpack(r.keys, r.n - 1)]) for r in held])
        tails = np.concatenate([_unpack(r.tails, r.n) for r in held])
        ids = np.concatenate([_unpack(r.ids, r.n).astype(np.int64) + r.low for r in held])
        order, low = subtree(keys, tails, ids)
        earlier = np.zeros(len(keys), bool)
        earlier[order] = low < ids[order]
        ends = np.cumsum(sizes)
        found = [(r.block, r.grp, np.packbits(earlier[e - n:e]).tobytes())
                 for r, n, e in zip(held, sizes, ends) if earlier[e - n:e].any()]
        return pd.DataFrame(found, columns=["block", "grp", "bits"])

    for b in batches:
        for row in b.itertuples():
            if held and held[-1].grp != row.grp:
                yield solve()
                held = []
            held.append(row)
    if held:
        yield solve()


def _cut(batches: Iterator[pd.DataFrame], first: np.ndarray, parts: np.ndarray,
         min_words: int) -> Iterator[pd.DataFrame]:
    """Blocks with their answers: one row per document."""
    hasher = Hasher()
    for b in batches:
        for row in b.itertuples():
            data, ids, lengths, n_words, at, doc, keys, tails = _open_block(row, hasher, min_words)
            key, _, low, place = _distinct(keys, tails, ids[doc])
            earlier = np.zeros(len(key), bool)
            if row.answers is not None and len(row.answers):
                group = _group_of(key, first, parts)
                for a in row.answers:
                    s, e = np.searchsorted(group, [a["grp"], a["grp"] + 1])
                    earlier[s:e] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=e - s)
            repeat = at[earlier[place] | (low[place] < ids[doc])] if len(at) else at
            total = int(n_words.sum())
            depth = np.zeros(total + 1, np.int64)
            np.add.at(depth, repeat, 1)
            np.add.at(depth, np.minimum(repeat + min_words, total), -1)
            gone = np.cumsum(depth)[:total] > 0
            out, pos, word = [], 0, 0
            for doc_id, unnamed, size, n in zip(ids.tolist(), row.nameless, lengths.tolist(), n_words.tolist()):
                words = data[pos:pos + size].split()
                cut = gone[word:word + n]
                removed = int(cut.sum())
                spans: list = []
                if removed:
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], cut, [False]]).astype(np.int8)))
                    spans = [{"start": s, "stop": e} for s, e in edge.reshape(-1, 2).tolist()]
                    words = [w for w, c in zip(words, cut.tolist()) if not c]
                out.append((None if unnamed else str(doc_id), n, removed,
                            b" ".join(words).decode("utf-8"), spans))
                pos, word = pos + size + 1, word + n
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_text", "spans"])


CUT = "doc_id string, n_words bigint, n_removed bigint, kept_text string, spans array<struct<start:bigint,stop:bigint>>"


def remove_repeats(documents: DataFrame, min_words: int = MIN_WORDS, group_suffixes: int = GROUP_SUFFIXES,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, spans) of every document.

    A word goes if a window of ``min_words`` words over it also starts in a document with a
    smaller doc_id; windows are judged on the input.  ``spans`` are the maximal removed runs,
    in words; ``kept_text`` joins the other words by one space.  Words are runs of anything but
    space and \\t \\n \\v \\f \\r, compared by bytes, through keys of 88 bits, 64 of
    them from all ``min_words`` words.

    Null and empty texts have no words; rows that repeat a doc_id never remove each other's
    words; rows without doc_id rank with the largest possible id and keep among themselves; an empty
    table gives no rows; other columns are ignored.
    """
    blocks = blocks_of(documents, min_words, block_bytes)
    first, parts = plan_groups(blocks, group_suffixes)
    sent = blocks.select("block", "doc_ids", "lengths", "data").mapInPandas(
        lambda b: _send(b, first, parts, min_words), SENT)
    answers = keep(sent.repartition("grp").sortWithinPartitions("grp", "block").mapInPandas(
        _answer, "block bigint, grp bigint, bits binary"), "substring-answers")
    per_block = answers.groupBy("block").agg(F.collect_list(F.struct("grp", "bits")).alias("answers"))
    met = blocks.select("block", "doc_ids", "nameless", "lengths", "data").join(per_block, "block", "left")
    kind = documents.schema["doc_id"].dataType
    return met.mapInPandas(lambda b: _cut(b, first, parts, min_words), CUT).withColumn(
        "doc_id", F.col("doc_id").cast(kind))
