"""Consistent weighted sampling against a plain Python version and the exact similarity."""

import hashlib
import math
import random
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from roadprint.llm import fingerprints as fp
from roadprint.llm.queries import op13_fingerprints

SF = "/root/testdata/sf0.001"


def bag(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def chained(*parts):
    """Spark's xxhash64 of (bytes or long, ints): each hash seeds the next, 42 first."""
    seed = 42
    for p in parts:
        data = p if isinstance(p, bytes) else struct.pack("<q", p - (1 << 64) if p >= 1 << 63 else p)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def plain(text, samples=fp.SAMPLES):
    unit = lambda h: ((h >> 11) + 0.5) * 2.0 ** -53
    words = {chained(w.encode()): n for w, n in bag(text).items()}
    if not words:
        return "0" * 4 * samples
    out = []
    for k in range(samples):
        low = math.inf
        for w, s in words.items():
            h = chained(w, struct.pack("<i", k // fp.TOGETHER), struct.pack("<i", k % fp.TOGETHER))
            second = chained(h)
            e1, e2, u = -math.log(unit(h)), -math.log(unit(second)), unit(chained(second))
            r = -math.log(e1 / (e1 + e2) * u)
            b = math.log(u) / -r
            t = math.floor((math.log(s) - math.log(u)) / r) if s > 1 else 0
            a = e1 * math.exp(-r * t) if s > 1 else e1
            assert t == math.floor(math.log(s) / r + b)
            assert math.isclose(a, (e1 + e2) * math.exp(-r * (t - b + 1)), rel_tol=1e-6)  # as the method has it
            low = min(low, a)
        out.append(f"{signed_mod(chained(struct.pack('<f', low)), 65535) + 1:04x}")
    return "".join(out)


def signed_mod(h, m):
    return (h - (1 << 64) if h >= 1 << 63 else h) % m


def pieces(s):
    return [s[i:i + 4] for i in range(0, len(s), 4)]


def expected(rows):
    """(doc_id, text) to the contract's columns that need no fingerprint."""
    docs = [(i, t or "") for i, t in rows]
    order = sorted(set(docs), key=lambda d: (d[0] is None, -(d[0] or 0),
                                             hashlib.md5(f"{'' if d[0] is None else d[0]}|{d[1]}".encode()).digest()))
    after = {d: order[(k + 1) % len(order)] for k, d in enumerate(order)}
    out = []
    for d in docs:
        n, nxt = len(d[1]), after[d][1]
        edited = d[1][:n - n // 2] + nxt[:n // 2]
        out.append((d[0], n, hashlib.sha256(edited.encode()).hexdigest(), d[1], edited, nxt))
    return out


def check(rows, got):
    want = expected(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got = sorted(map(tuple, got), key=key)
    want.sort(key=key)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    memo = {}
    equal = total = 0
    for g, w in zip(got, want):
        for text in w[3:]:
            if text not in memo:
                memo[text] = plain(text)
        for have, text in ((g[3], w[3]), (g[4], w[4])):
            equal += sum(a == b for a, b in zip(pieces(have), pieces(memo[text])))
            total += fp.SAMPLES
        share = lambda a, b: sum(x == y for x, y in zip(pieces(a), pieces(b))) / fp.SAMPLES
        assert g[5] == share(g[3], g[4])
        assert abs(g[6] - share(memo[w[3]], memo[w[5]])) <= 0.05
    assert equal >= 0.995 * total  # the last bit of a logarithm may differ between libraries


def test_cases_against_plain_python(spark):
    long = "alpha beta " * 2000 + "gamma"
    rows = [(1, "one two two three"), (2, None), (3, ""), (4, "  \t\n "), (None, "no id here"), (5, "é ü 東京 🎉🎉 ß"),
            (7, "same text"), (8, "same text"), (7, "same text"), (7, "other text of seven"), (9, long), (None, None),
            (10, "a\x0bb\x0cc\rd\ne\tf"), (9223372036854775807, "largest id"), (-4, "x" * 999), (6, "nbsp stays")]
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id bigint, text string, key string, side int")
    got = fp.fingerprint_edits(df).collect()
    check(rows, got)
    by_text = {}
    for r in got:
        for text in [t or "" for i, t in rows if i == r.doc_id and len(t or "") == r.n_chars]:
            if " ".join(bag(text)) and text == "same text":
                by_text.setdefault(text, set()).add(r.fingerprint)
    assert len(by_text["same text"]) == 1


def test_single_document_and_empty_table(spark):
    one = fp.fingerprint_edits(spark.createDataFrame([(1, "ab cd")], "doc_id bigint, text string")).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(5, 1.0)]
    check([(1, "ab cd")], one)
    assert fp.fingerprint_edits(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query_against_plain_python(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    short = sorted(rows, key=lambda r: len(r[1] or ""))[:60]
    got = {r.doc_id: r for r in op13_fingerprints(spark, SF).collect()}
    assert len(got) == len(rows)
    want = {w[0]: w for w in expected(rows)}
    for i, _ in short:
        assert (got[i].n_chars, got[i].edited_sha256) == want[i][1:3]
        same = sum(a == b for a, b in zip(pieces(got[i].fingerprint), pieces(plain(want[i][3]))))
        assert same >= fp.SAMPLES - 1


@pytest.mark.parametrize("samples", [1024])
def test_collision_rate_is_the_generalised_jaccard_similarity(spark, samples):
    rng = random.Random(3)
    rows, exact = [], {}
    for i in range(40):
        a = Counter({f"w{k}": rng.choice([1, 1, 1, 2, 3, 9, 40]) for k in rng.sample(range(60), rng.randint(1, 40))})
        b = Counter({w: max(0, n + rng.choice([0, 0, 0, 1, -1, 5])) for w, n in a.items()})
        b.update({f"v{k}": 1 for k in range(rng.randint(0, 10))})
        text = lambda c: " ".join(w for w, n in c.items() for _ in range(n))
        rows.append((i, text(a), text(b)))
        words = set(a) | set(b)
        exact[i] = sum(min(a[w], b[w]) for w in words) / sum(max(a[w], b[w]) for w in words)
    df = spark.createDataFrame(rows, "id int, a string, b string")
    drawn = fp.signatures(fp.bags(df, ["id"], ["a", "b"]), ["id"], samples)
    both = drawn.groupBy("id").pivot("side", [0, 1]).agg(F.first("fingerprint"))
    near = {r[0]: r[1] for r in both.select("id", fp.likeness(F.col("0"), F.col("1"), samples)).collect()}
    gaps = [near[i] - exact[i] for i in near]
    assert len(near) == 40 and abs(sum(gaps) / len(gaps)) < 0.01 and max(map(abs, gaps)) < 0.08


def test_no_python_and_texts_dealt_by_key_once(spark):
    pairs, _ = fp.edited_pairs(spark.read.parquet(f"{SF}/documents.parquet"))
    plan = fp.signatures(fp.bags(pairs, ["key"], ["text", "edited"]), ["key"])._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "Python" not in physical and "Arrow" not in physical
    assert "hashpartitioning(key" in physical and "hashpartitioning(word" not in physical
