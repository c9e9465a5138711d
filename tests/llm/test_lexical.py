"""Ranked lexical search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from roadprint.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(documents, items, k=50):
    docs = [(i, Counter(terms(t))) for i, t in documents]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for i, c in docs:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (
                (10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item_id, r, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


def check(spark, documents, items, k=50, **how):
    got = lexical.search(spark.createDataFrame(documents, "doc_id bigint, text string"),
                         spark.createDataFrame(items, "item_id bigint, text string"), k, **how)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(documents, items, k)


def made(seed, n=400, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 30, 120])))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(150)]  # a large group of copies
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 20])))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("how", [{}, {"shard_postings": 200, "block_documents": 4, "seed_share": 2},
                                 {"shard_documents": 7, "block_documents": 1, "seed_share": 1},
                                 {"item_terms": 20, "shard_postings": 1000, "block_documents": 16}])
def test_against_all_scores(spark, how):
    docs, items = made(1)
    check(spark, docs, items, 10, **how)


def test_cases_at_the_edge(spark):
    docs = [(1, "Apple ÄPFEL apple-pie"), (2, None), (3, ""), (4, "!!! ..."), (None, "apple pie"), (5, "apple pie"),
            (5, "apple pie"), (-7, "apple pie"), (None, "apple pie"), (9223372036854775807, "apple pie"),
            (6, "pie " * 50000 + "äpfel"), (7, "a1 ß é é"), (8, "APPLE")]
    items = [(1, "apple"), (2, None), (3, ""), (None, "pie"), (4, "Pie pie apple äpfel ÄPFEL"), (4, "nothing here"),
             (1, "apple"), (5, "é é ß")]
    check(spark, docs, items)
    check(spark, docs, items, 3, block_documents=2, shard_documents=3, seed_share=1)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "one two", 3, "x")], "doc_id bigint, text string, n int, terms string")
    items = spark.createDataFrame([("q", "two", 1, 2)], "item_id string, text string, rank int, item int")
    assert [tuple(r) for r in lexical.search(docs, items).collect()][0][:3] == ("q", 1, 1)
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0


def test_blocks_are_skipped_and_bounds_hold():
    """Summaries bound the score of every member, and a threshold leaves blocks unread."""
    rng = np.random.default_rng(5)
    n_terms, n_docs = 40, 500
    rows = [np.sort(rng.choice(n_terms, rng.integers(1, 9), replace=False)) for _ in range(n_docs)]
    sizes, flat = np.array([len(r) for r in rows]), np.concatenate(rows)
    gain = rng.integers(1, 10**6, len(flat)).astype(np.int32)
    weights = rng.integers(1, 9000, n_terms)
    partners = [np.arange(n_terms, dtype=np.int32)] * n_terms
    directions = rng.standard_normal((n_terms, lexical.SKETCH)).astype(np.float32)
    shard = lexical.Shard(lexical.make_shard(np.arange(n_docs), np.zeros(n_docs, bool), sizes, flat.astype(np.int32), gain,
                                             weights, partners, directions, 16), partners)
    terms_ = np.array([1, 5, 9, 20])
    weight_of = np.zeros(n_terms, np.int64)
    weight_of[terms_] = weights[terms_]
    everything = shard.score(np.arange(n_docs), weight_of)
    for t in terms_.tolist():
        first, with_, top = shard.lists[t]
        for b in range(len(top)):
            members = shard.members[shard.block_starts[first + b]:shard.block_ends[first + b]]
            assert everything[members].max() <= (top[b][terms_] * weights[terms_]).sum()
    found, scores, skipped = shard.top(terms_, weights[terms_], weight_of, 1, 5)
    want = np.lexsort((np.arange(n_docs), -everything))[:5]
    assert found.tolist() == want.tolist() and scores.tolist() == everything[want].tolist() and skipped > 0
