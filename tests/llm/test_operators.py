"""Every dealt operator against brute force on small tables, with nulls, ties, repeats and empty tables."""

import hashlib
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadprint.llm import decontam, mixing, pii, simhash, substrings, tokens, toxicity, urls, vectors, warc
from roadprint.llm.common import components, table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, row string"
LONG = "lorem ipsum " * 20000


def docs(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, None, s, None, "x", "y") for i, t, s in rows], DOCS)


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda x: (x is None, x))


# ---- components

def test_components(spark):
    pairs = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5), (None, 4)] + [(100, k) for k in range(101, 160)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert {k: got[k] for k in (1, 2, 3, 7, 8, 9)} == dict.fromkeys((1, 2, 3, 7, 8, 9), 1)
    assert got[21] == 20 and got[159] == 100 and 5 not in got and 4 not in got


# ---- 1 decontamination

def brute_cover(p, t, m):
    mp, mt, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while (i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k]
                       and i + k not in mp and j + k not in mt):
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < m:
            return covered
        mp |= set(range(i, i + k))
        mt |= set(range(j, j + k))
        covered += k


def test_tiles_are_greedy():
    rng = np.random.default_rng(3)
    for _ in range(200):
        p = rng.integers(1, 4, rng.integers(1, 14)).tolist()
        t = rng.integers(1, 4, rng.integers(1, 18)).tolist()
        got = decontam.tile(p, t, 3)
        assert sum(k for _, _, k in got) == brute_cover(p, t, 3)
        assert all(p[i:i + k] == t[j:j + k] for i, j, k in got)


def test_tiles_of_repetitive_texts_take_no_cubic_time():
    start = time.process_time()
    assert decontam.tile([1] * 2000, [1] * 1999) == [(0, 0, 1999)]
    decontam.tile([1, 2] * 1000, ([1, 2] * 30 + [3]) * 60)
    assert time.process_time() - start < 15  # extending every pair of equal windows takes minutes



def test_decontamination(spark):
    item = " ".join(f"w{i}" for i in range(20))
    moved = "Start. " + " ".join(f"W{i}," for i in range(10, 20)) + " between " + " ".join(f"w{i}" for i in range(10))
    part = " ".join(f"w{i}" for i in range(12))
    d = docs(spark, [(1, "x " + item + " y", "a"), (2, moved, "a"), (3, part, "a"), (4, None, None), (5, "", "a"),
                     (6, LONG, "a"), (1, "x " + item + " y", "a"), (None, item, "a")])
    b = spark.createDataFrame([(7, item), (7, item), (8, "a b"), (9, None), (None, item), (10, "")],
                              "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.covered, r.n_tiles, r.contaminated) for r in decontam.report(d, b).collect()}
    assert got == {(1, 7): (20, 1, True), (2, 7): (20, 2, True), (3, 7): (12, 1, False), (None, 7): (20, 1, True)}
    assert decontam.report(d, b).count() == 5
    kept = decontam.drop_contaminated(d, b)
    assert ids(kept) == [3, 4, 5, 6] and kept.columns == d.columns
    assert ids(decontam.drop_contaminated(d, b.limit(0))) == ids(d)
    assert decontam.report(d.limit(0), b).count() == 0
    many = spark.createDataFrame([(k, " ".join(f"q{k}x{i}" for i in range(30))) for k in range(40)] + [(77, item)],
                                 "item_id long, text string")
    blocks = sorted(map(tuple, decontam.report(d, many, block_words=100).collect()), key=str)
    assert blocks == sorted(map(tuple, decontam.report(d, many).collect()), key=str) and len(blocks) == 5


# ---- 2 substring dedup

def brute_cut(rows, k=13):
    first, inf = {}, float("inf")
    split = [(inf if i is None else i, i, (t or "").encode().split()) for i, t in rows]
    for v, _, w in split:
        for j in range(len(w) - k + 1):
            key = b" ".join(w[j:j + k])
            first[key] = min(first.get(key, inf), v)
    out = []
    for v, i, w in split:
        gone = bytearray(len(w))
        for j in range(len(w) - k + 1):
            if first[b" ".join(w[j:j + k])] < v:
                gone[j:j + k] = b"\1" * k
        out.append((i, len(w), sum(gone), " ".join(x.decode() for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"group_suffixes": 200, "block_bytes": 20000}])
def test_substrings(spark, options):
    numbers = list(map(str, range(60)))
    edge = [(None, "a b"), (None, " ".join(numbers)), (-5, " ".join(numbers[5:30])), (-5, " ".join(numbers[5:30])),
            (10 ** 9, ""), (10 ** 9 + 1, None), (10 ** 9 + 2, "x " * 500), (10 ** 9 + 3, "x " * 50),
            (10 ** 9 + 4, "é ü\x1cb\t " * 60), (10 ** 9 + 5, LONG)]
    d = table(spark, SF, "documents").select("doc_id", "text").unionByName(
        spark.createDataFrame(edge, "doc_id long, text string"))
    got = substrings.remove_repeats(d.withColumn("block", F.lit(1)), **options)
    rows = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=str)
    assert rows == brute_cut([tuple(r) for r in d.collect()])
    assert all(sum(s.stop - s.start for s in r.spans) == r.n_removed for r in got.collect())


def test_substrings_keys_tell_windows_apart(spark):
    pairs = [(2459615, 3254613), (148878, 230405), (148946, 462448), (19060, 606569)]
    text = lambda v: f"a b c d e f g h i j k l {v}"  # noqa: E731  (of each pair, the first 64 bits of the keys are equal)
    data = [text(v).encode() for pair in pairs for v in pair]
    keys, tails = substrings.Hasher().keys(b"".join(t + b"\n" for t in data), np.array([len(t) for t in data]), 13)[3:]
    assert (keys[::2] == keys[1::2]).all() and (tails[::2] != tails[1::2]).all()
    d = docs(spark, [(v, text(v), "s") for pair in pairs for v in pair] + [(9 * 10 ** 6, text(230405), "s")])
    for options in ({}, {"block_bytes": 1}):
        got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(d, **options).collect()}
        assert got == {v: 0 for pair in pairs for v in pair} | {9 * 10 ** 6: 13}


def test_substrings_empty(spark):
    assert substrings.remove_repeats(docs(spark, []).limit(0)).count() == 0


# ---- 3 urls

def test_url_parts_and_rules(spark):
    cases = [("HTTP://WWW.Example.COM/en/a?x#y", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
             ("https://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
             ("https://x.com?q=/en/", "x.com", "", None, "allow"),
             ("https://é.net/fr/É#z", "é.net", "/fr/É", "net/fr/", "block"),
             ("https://notnet/fr/1", "notnet", "/fr/1", None, "allow"),
             ("no scheme/en/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow")]
    pages = spark.createDataFrame([(i, c[0], "z") for i, c in enumerate(cases)], "page_id long, url string, host string")
    empty = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, empty).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}
    assert urls.judge(pages.limit(0), empty).count() == 0


def test_url_templates(spark):
    rows, bad = [], []
    for i in range(400):
        section = ("spam", "news", "blog", "shop")[i % 4]
        rows.append((i, f"https://site.org/{section}/{i}.html"))
        bad.append((i, int(section == "spam") if i % 5 else None))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = urls.judge(pages, spark.createDataFrame(bad, "page_id long, bad int")).collect()
    assert {(r.template, r.verdict) for r in got} == {("/spam/{n}.html", "block"), ("/*-/{n}.html", "allow")}
    assert all((r.verdict == "block") == ("/spam/" in r.path) for r in got)


def test_url_templates_go_to_the_last_segment(spark):
    rows = [(i, f"https://deep.org/a/b/c/d/e/f/{('spam', 'docs')[i % 2]}/x/{i}") for i in range(80)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "page_id long, bad int")
    got = {(r.page_id % 2, r.template, r.verdict) for r in urls.judge(pages, marks).collect()}
    assert got == {(0, "/a/b/c/d/e/f/spam/x/{n}", "block"), (1, "/a/b/c/d/e/f/docs/x/{n}", "allow")}


def test_url_branches_without_evidence_have_the_prior(spark):
    name = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    urls_of = [f"https://one.org/spam/{name(i)}" for i in range(120)] + [f"https://one.org/docs/{i}" for i in range(50)]
    urls_of += [f"https://few.org/spam/{i}" for i in range(5)] + [f"https://few.org/docs/{i}" for i in range(20)]
    urls_of += [f"https://good.org/a/{i}" for i in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls_of)), "page_id long, url string")
    marks = [(i, int("/spam/" in u)) for i, u in enumerate(urls_of) if i < 100 or "few.org/spam" in u or "good.org" in u]
    marks += [(120 + i, 0) for i in range(3)]
    got = urls.judge(pages, spark.createDataFrame(marks, "page_id long, bad int")).collect()
    assert len(got) == len(urls_of)
    assert all((r.verdict == "block") == r.path.startswith("/spam/") for r in got if r.host != "few.org")
    assert {r.verdict for r in got if r.host == "few.org" and r.path.startswith("/docs/")} == {"allow"}


# ---- 4 embeddings

def test_vectors(spark, monkeypatch):
    rng = np.random.default_rng(0)
    rows, n = [], 0
    for label in (1, 2, None):
        for c in rng.normal(size=(12, 24)):
            for k in range(12):
                v = c + rng.normal(size=24) * 0.05 * (k % 4)
                rows.append((n, v.tolist(), label))
                n += 1
    same = rng.normal(size=24).tolist()
    rows += [(n + k, same, 3) for k in range(5)] + [(n + 9, None, 1), (n + 10, [0.0] * 24, 1),
                                                    (n + 11, [float("nan")] + [1.0] * 23, 1),
                                                    (n + 12, [None] + [1.0] * 23, 1), (n + 13, [], 1),
                                                    (n + 14, same[:10], 3), (None, same, 3),
                                                    (n, same, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("v", F.lit(1))
    root = {r[0]: r[0] for r in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    degree = [0] * len(rows)
    good = [i for i, (k, v, lab) in enumerate(rows) if k is not None and v and lab is not None
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for a in good:
        for b in good:
            va, vb = np.array(rows[a][1]), np.array(rows[b][1])
            if a != b and rows[a][2] == rows[b][2] and len(va) == len(vb) and (
                    va @ vb / np.linalg.norm(va) / np.linalg.norm(vb) >= 0.93):
                degree[a] += 1
                x, y = top(rows[a][0]), top(rows[b][0])
                root[max(x, y)] = min(x, y)
    want = sorted(((r[0], degree[i], None if r[0] is None else top(r[0])) for i, r in enumerate(rows)), key=str)
    for block, wide in ((2048, 32), (4, 2)):
        monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
        monkeypatch.setattr(vectors, "WIDE_RUN", wide)
        got = vectors.near_duplicates(df).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


# ---- 5 mixing

def test_mixing(spark):
    rows = [(i, "w " * (i % 37 + 1), f"s{i % 3}") for i in range(300)] + [(1000 + i, "a b c", "tiny") for i in range(4)]
    rows += [(2000, None, "s0"), (2001, "", None), (2002, "x " * 50, None), (None, "q " * 9, "s1"), (5, "w " * 6, "s2"),
             (3000, LONG, "s0")]
    d = docs(spark, rows)
    got = mixing.mix(d).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[2] for r in rows}
    taken, target, size = {}, {}, {}
    for r in got:
        s = source[r.doc_id]
        taken[s] = taken.get(s, 0) + r.taken
        size[s] = size.get(s, 0) + r.size
        target[s] = r.target
        assert r.source_size >= 0 and 0 <= r.taken <= 3 * r.size
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in taken)
    assert target["tiny"] == 3 * size["tiny"] == 36
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    free = {s: w for s, w in zip(sorted(x for x in size if x) + [None], (1, 2, 3, 1, 2)) if target[s] < 3 * size[s]}
    level = {round(target[s] / w, 6) for s, w in free.items()}
    assert len(level) == 1
    assert sorted(map(tuple, mixing.mix(d).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mix(d.limit(0)).count() == 0


# ---- 6 toxicity

def test_toxicity(spark):
    rng = np.random.default_rng(1)
    plain = [f"word{chr(97 + a)}{chr(97 + b)}" for a in range(20) for b in range(5)]
    nasty = ["grumbler", "snarler"]
    text, marks = {}, {}
    for i in range(600):
        w = rng.choice(plain, 30).tolist()
        if i % 3 == 0:
            w[3:3] = [nasty[i % 2]] * 2
        text[i], marks[i] = " ".join(w), int(i % 3 == 0)
    d = docs(spark, [(i, t, "s") for i, t in text.items()] + [(900, None, None), (901, "", "s"), (None, "wordaa", "s"),
                                                             (902, " ".join(plain[:20]) + " grumblerz grumblers", "s"),
                                                             (0, text[0], "s"), (903, LONG, "s")])
    lab = spark.createDataFrame([(i, 1, m) for i, m in marks.items()] + [(5, 1, None), (None, 1, 1)],
                                "doc_id long, quality int, toxic int")
    got = toxicity.score(d, lab, epochs=40).collect()
    assert len(got) == d.count() and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in marks]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert np.mean([r.predicted == marks[r.doc_id] for r in held]) > 0.95
    by = {r.doc_id: r for r in got}
    assert by[902].score > by[901].score  # an unseen spelling shares n-grams
    assert by[900].score == by[901].score
    kept = toxicity.reject(d, lab, epochs=40)
    assert kept.columns == d.columns and 3 not in ids(kept) and 1 in ids(kept)
    assert {r.score for r in toxicity.score(d, lab.limit(0)).collect()} == {0.5}
    assert toxicity.score(d.limit(0), lab).count() == 0


# ---- 7 warc

def test_warc(spark, tmp_path):
    big, other = "é" * 700, "b" * 1000
    rows = [(1, "http://a/\r\n1", big), (5, "http://a/2", big), (3, None, big), (2, "u", "short"), (4, "u", "short"),
            (6, "u", None), (7, "u", ""), (8, "u", other), (9, "u", "a\r\n\r\nWARC/1.0\r\n\x1f\x8b\x08" + "c" * 2000),
            (2 ** 53 + 1, "u", other), (10, "u", LONG), (1, "http://a/\r\n1", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    last = {}
    for p, _, h in rows:
        last[h or ""] = max(last.get(h or "", 0), p)
    want = []
    for p, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= 1000 and last[h] != p
        want.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response",
                     last[h] if again else None))
    for split in (64, 1000, 8 << 20):
        got = warc.round_trip(spark, pages.repartition(3), f"file://{tmp_path}/w{split}", split_bytes=split)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    manifest = warc.write_archives(pages.repartition(2), f"file://{tmp_path}/x")
    texts = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(manifest, 500).collect()
             if r.record_type == "response"}
    assert texts[10] == LONG and texts[9] == rows[8][2] and texts[6] == ""
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


# ---- 8 simhash

def brute_fingerprint(text):
    import xxhash
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_covering_masks():
    masks = simhash.covering_masks(4)
    rng = np.random.default_rng(2)
    for _ in range(2000):
        bits = sum(1 << int(b) for b in set(rng.integers(0, 64, 4).tolist()))
        assert any(m & bits == 0 for m in masks)


def test_simhash_links(spark, monkeypatch):
    rng = np.random.default_rng(4)
    prints = set()
    for c in rng.integers(0, 2 ** 63, 40).tolist():
        for _ in range(12):
            prints.add(c ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 6)).tolist())))
    prints = sorted(prints)
    want = {}
    for a in range(len(prints)):
        want.setdefault(a, a)
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    signed = [(i, p - 2 ** 64 if p >= 2 ** 63 else p) for i, p in enumerate(prints)]
    df = spark.createDataFrame(signed, "id long, fp long")
    for wide in (64, 2):
        monkeypatch.setattr(simhash, "WIDE_RUN", wide)
        got = dict(map(tuple, components(simhash.near_links(df)).collect()))
        assert [got.get(i, i) for i in range(len(prints))] == [top(i) for i in range(len(prints))]


def test_simhash(spark):
    base = " ".join(f"tok{i}" for i in range(400))
    rows = [(9, base, "a"), (4, base.upper(), "a"), (7, base + " end", "a"), (1, "other words here now " * 9, "b"),
            (2, None, None), (3, "", "b"), (5, " \t ", "b"), (None, base, "a"), (9, base, "a"), (6, "one two", "b"),
            (8, LONG, "c"), (None, "alone in the dark " * 7, "z"), (None, "alone in the dark " * 7, "z")]
    d = docs(spark, rows)
    got = simhash.near_duplicates(d).collect()
    assert sorted((r.doc_id, r.fingerprint) for r in got if r.doc_id is not None) == sorted(
        (i, f"{brute_fingerprint(t):016x}") for i, t, _ in rows if i is not None)
    comp = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert comp[9] == comp[4] == 4 and comp[2] == comp[3] == comp[5] == 2 and comp[1] == 1
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns
    want = sorted({c for c in comp.values()}) + [None]
    assert ids(kept) == want
    assert simhash.keep_one(d.limit(0)).count() == 0


# ---- 9 personal data

SHAPES = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
          ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_spans(text):
    out = []
    for kind, shape in SHAPES:
        for m in re.finditer(shape, text or ""):
            s, d = m[0], re.sub("[^0-9]", "", m[0])
            twice = [int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))]
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in s.split("."))
                    or kind == "card" and 13 <= len(d) <= 19 and sum(twice) % 10 == 0
                    or kind == "phone" and 9 <= len(d) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii(spark):
    texts = [None, "", "a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 256.1.1.1 0255.001.1.0", "+1 (988) 555-2485 and +12 34",
             "4111 1111 1111 1111-5", "é4111-1111-1111-1111é a@b.co 1.1.1.1", "9" * 100000, "1 " * 30000 + "x",
             "a.b@c-d.e-f..g +1.2.3.4.5.6.7.8.9", "ß a@b.c\n\na@b.c", LONG, "a@b.c_d@e.f x@y"]
    d = table(spark, SF, "documents").select("doc_id", "text").unionByName(spark.createDataFrame(
        [(10 ** 6 + i, t) for i, t in enumerate(texts)] + [(None, "x a@b.c")], "doc_id long, text string"))
    got = {r.doc_id: r for r in pii.scan(d.withColumn("row", F.lit(0))).collect()}
    for r in d.collect():
        base = brute_spans(r.text)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[r.doc_id].spans.split(","))
        assert got[r.doc_id].n_email >= base.count("email")
    assert pii.scan(d.limit(0)).count() == 0


def test_pii_learns_contexts(spark):
    rows = [(i, f"please ring my desk +1 200 300 4{i:03d} today", "s") for i in range(12)]
    rows += [(50, "please ring my desk 200-300-4999 today", "s"), (51, "the lot 200-300-4777 sold", "s"),
             (52, "", None), (53, None, "s"), (54, "mail me@b.co or 1.2.3.4 now", "s"), (54, "mail me@b.co or 1.2.3.4 now", "s")]
    d = docs(spark, rows)
    got = {r.doc_id: r.spans for r in pii.scan(d).collect()}
    assert got[50] == "phone:20:32" and got[51] == ""
    out = pii.redact(d)
    text = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == d.columns and out.count() == len(rows)
    assert text[50] == "please ring my desk [PHONE] today" and text[51] == "the lot 200-300-4777 sold"
    assert text[54] == "mail [EMAIL] or [IP] now" and text[52] == "" and text[53] is None


def test_pii_learns_spaced_and_obfuscated(spark):
    rows = [(i, f"please ring my desk +1 200 300 4{i:03d} today", "s") for i in range(12)]
    rows += [(20 + i, f"kindly write to user{i}@site.org for help", "s") for i in range(12)]
    rows += [(50, "please ring my desk (017) 555-7713 today", "s"), (51, "please ring my desk 0171 555 7713 today", "s"),
             (52, "kindly write to john[at]site[dot]com for help", "s"), (53, "sold 0171 555 7799 sheep", "s"),
             (54, "please ring my desk 200-300-4999 5 times", "s"), (55, "the poet[at]large sang", "s")]
    got = {r.doc_id: r.spans for r in pii.scan(docs(spark, rows)).collect()}
    assert got[50] == "phone:20:34" and got[51] == "phone:20:33" and got[52] == "email:16:36"
    assert got[54] == "phone:20:32" and got[53] == got[55] == ""
    assert got[3] == "phone:20:35"


def test_pii_learns_to_the_end(spark):
    number = iter(range(10 ** 10, 10 ** 11, 7654321))
    rows, shared = [], []
    for k in range(7):  # a word of context counts only once the values shared with the one before are known
        new = [next(number) for _ in range(4)]
        rows += [f"ask the {'abcdefg'[k] * 4} {v} please" for v in [f"+{next(number)}" for _ in range(20)] + shared + new]
        shared = new
    got = pii.scan(docs(spark, [(i, t, "s") for i, t in enumerate(rows)])).collect()
    assert all(r.n_phone == 1 for r in got)


# ---- 10 token counts

def test_tokens(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = [None, "", " ", "a  b", " lead and trail ", "tab\tand\n\nlines \n x", "a<|endoftext|> b <|endoftext|>",
             "don't I'll 12,34 é ü \x1c x", LONG, "same", "same"]
    d = docs(spark, list(zip(range(len(texts)), texts, ["s"] * len(texts))) + [(None, "nameless one", "s")])
    cache = f"file://{tmp_path}/cache"
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(d, path, cache).collect()}
    for i, t in enumerate(texts):
        n = len(tok.encode(t or "", add_special_tokens=False))
        assert got[i] == (len((t or "").encode()), n, n > 512)
    more = d.unionByName(docs(spark, [(99, "a new text", "s")]))
    assert tokens.count_tokens(more, path, cache).count() == len(texts) + 2
    held = spark.read.parquet(cache)
    assert held.count() == held.select("digest").distinct().count() == 11  # each text encoded once
    assert tokens.count_tokens(d.limit(0), path).count() == 0
    sample = table(spark, SF, "documents").select("doc_id", "text")
    want = {r.doc_id: len(tok.encode(r.text, add_special_tokens=False)) for r in sample.collect()}
    assert {r.doc_id: r.n_tokens for r in tokens.count_tokens(sample, path).collect()} == want


def test_tokens_piece_model(spark):
    import public_tokenizers
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    d = docs(spark, [(1, "Hello there, world", "s"), (2, "", "s"), (3, None, "s")])
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(d, path).collect()}
    assert got == {1: len(sp.encode("Hello there, world")), 2: 0, 3: 0}


def test_op2_words_keep_small_numbers_and_their_hashes(monkeypatch):
    """A word's hash is looked up by its number; beyond the limit a hasher starts afresh and hashes alike."""
    import xxhash
    monkeypatch.setattr(substrings, "WORDS_HELD", 6)
    hasher = substrings.Hasher()
    for words in ([b"a", b"b", b"a"], [], [b"b", b"c", b"\xff", b"c"], [b"%d" % i for i in range(9)], [b"a", b"8", b"a"]):
        assert hasher.words(words).tolist() == [xxhash.xxh3_64_intdigest(w) for w in words]
        assert sorted(hasher.held.values()) == list(range(len(hasher.held)))
    assert set(hasher.held) == {b"a", b"8"}
