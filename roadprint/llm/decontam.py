"""Benchmark decontamination: greedy string tiling with running Karp-Rabin matching."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[^\W_]+")
MIN_TILE = 5  # words of the shortest tile, and of a seed
COVERAGE = 0.8  # share of an item's words under tiles from which a document is contaminated
BLOCK_WORDS = 1_000_000  # benchmark words that go to every task at once; more are done in blocks
BASE = 1_000_003  # of the rolling hash, modulo 2^64
FOUND = "array<struct<item_id:bigint,n_tiles:int,covered:int,item_words:int>>"


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return TOKEN.findall((text or "").lower())


def _window_hashes(ids: list[int], marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(position, Karp-Rabin hash) of every window of ``size`` unmarked tokens, rolled one by one."""
    top = pow(BASE, size - 1, 1 << 64)
    value = length = 0
    for end, (token, mark) in enumerate(zip(ids, marked)):
        if mark:
            value = length = 0
            continue
        if length == size:
            value -= ids[end - size] * top
            length -= 1
        value = (value * BASE + token) & 0xFFFFFFFFFFFFFFFF
        length += 1
        if length == size:
            yield end - size + 1, value


def tile(item: list[int], text: list[int], min_tile: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles (position in item, position in text, length): longest matches first, never overlapping."""
    item_marked, text_marked = [False] * len(item), [False] * len(text)
    tiles: list[tuple[int, int, int]] = []
    size = len(item)
    while size >= min_tile:
        at: dict[int, list[int]] = {}
        for j, h in _window_hashes(text, text_marked, size):
            at.setdefault(h, []).append(j)
        found = []
        for i, h in _window_hashes(item, item_marked, size):
            for j in at.get(h, ()):
                if i and j and item[i - 1] == text[j - 1] and not item_marked[i - 1] and not text_marked[j - 1]:
                    continue  # part of the longer match that starts one word before
                k = 0
                while (i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k]
                       and not item_marked[i + k] and not text_marked[j + k]):
                    k += 1
                if k >= size:
                    found.append((-k, i, j))
        longest = min(found, default=(0, 0, 0))[0]
        for k, i, j in sorted(found):
            if k > longest or any(item_marked[i:i - k]) or any(text_marked[j:j - k]):
                continue  # the next scan at this size finds what is left of it
            item_marked[i:i - k] = text_marked[j:j - k] = [True] * -k
            tiles.append((i, j, -k))
        if not any(True for _ in _window_hashes(item, item_marked, min_tile)):
            break
        if not found:
            size = max(min_tile, size // 2) if size > min_tile else 0
    return tiles


class Benchmark:
    """Items of a block with their seeds: every run of ``min_tile`` words and the items that hold it."""

    def __init__(self, items: list[tuple[int, str]], min_tile: int):
        self.min_tile = min_tile
        self.ids: dict[str, int] = {}  # word -> number from 1; 0 is any word of no item
        self.items = []
        seeds: dict[int, set[int]] = {}
        for item_id, text in items:
            tokens = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            if len(tokens) < min_tile:
                continue
            self.items.append((item_id, tokens))
            for _, h in _window_hashes(tokens, [False] * len(tokens), min_tile):
                seeds.setdefault(h, set()).add(len(self.items) - 1)
        self.seeds = {h: sorted(s) for h, s in seeds.items()}
        self.sorted = np.array(sorted(seeds), np.uint64)

    def overlaps(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, number of tiles, covered words, words) of every item sharing a seed with the text."""
        words = words_of(text)
        if len(words) < self.min_tile or not len(self.sorted):
            return []
        ids = np.fromiter((self.ids.get(w, 0) for w in words), np.uint64, len(words))
        h = np.zeros(len(ids) - self.min_tile + 1, np.uint64)
        for k in range(self.min_tile):
            h = h * np.uint64(BASE) + ids[k:len(ids) - self.min_tile + 1 + k]
        where = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        hits = np.flatnonzero(self.sorted[where] == h)
        by_item: dict[int, list[int]] = {}
        for j in hits.tolist():
            for n in self.seeds[int(h[j])]:
                by_item.setdefault(n, []).append(j)
        out = []
        for n, starts in sorted(by_item.items()):
            # Only words under this item's seeds can be under a tile; -1 parts their runs.
            near: list[int] = []
            end = -1
            for j in starts:
                if j > end:
                    near.append(-1)
                near += ids[max(j, end):j + self.min_tile].astype(np.int64).tolist()
                end = j + self.min_tile
            item_id, tokens = self.items[n]
            tiles = tile(tokens, near, self.min_tile)
            if tiles:
                out.append((item_id, len(tiles), sum(t[2] for t in tiles), len(tokens)))
        return out


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int, str]]]:
    """(item_id, text) of the benchmark in blocks of about ``block_words`` words; one block, as a rule."""
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = max(1, -(-total // block_words))
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").collect()
        yield [(r["item_id"], r["text"]) for r in rows]


def _column(spark, items: list[tuple[int, str]], min_tile: int, text: str) -> Column:
    sent = spark.sparkContext.broadcast((items, min_tile))  # plain values, about BLOCK_WORDS words

    @F.pandas_udf(FOUND)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = Benchmark(*sent.value)
        for texts in batches:
            yield pd.Series([[dict(zip(("item_id", "n_tiles", "covered", "item_words"), o))
                              for o in block.overlaps(t)] for t in texts], dtype="object")

    return of(text)


def report(documents: DataFrame, benchmark: DataFrame, min_tile: int = MIN_TILE, coverage: float = COVERAGE,
           block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, n_tiles, covered, item_words, coverage, contaminated) of every pair with a tile.

    Documents and items are compared as lower-cased runs of letters and digits.  A document
    shares a seed with an item if it holds ``min_tile`` consecutive words of it; for those,
    greedy tiling marks the longest common runs first, so moved passages count in full.

    Null and empty texts share nothing; items under ``min_tile`` words and items without id or
    text are never matched; repeated items count once, repeated documents once each; an
    empty table on either side gives no rows; other columns are ignored.
    """
    out = None
    for block in _blocks(benchmark, block_words):
        part = documents.select("doc_id", F.explode(_column(documents.sparkSession, block, min_tile, "text")).alias("o"))
        out = part if out is None else out.unionByName(part)
    share = F.col("o.covered") / F.col("o.item_words")
    return out.select("doc_id", "o.*", share.alias("coverage"), (share >= coverage).alias("contaminated"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, min_tile: int = MIN_TILE,
                      coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that no item covers to ``coverage`` of its words or more, columns unchanged."""
    for block in _blocks(benchmark, block_words):
        found = _column(documents.sparkSession, block, min_tile, "text")
        documents = documents.where(~F.exists(found, lambda o: o["covered"] / o["item_words"] >= coverage))
    return documents
