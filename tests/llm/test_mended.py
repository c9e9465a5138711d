"""Cases that once went wrong: one test each."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from roadprint.llm import mixing, pii, simhash, substrings

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_words_that_cancel_out_in_polynomial_hashes_are_told_apart(spark):
    """A long word of two letters and its mirror image (letters swapped) collide modulo 2^64 for every base."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    rest = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{one} {rest}"),
            (4, " ".join("xy"[b] for b in bits[:64])), (5, " ".join("yx"[b] for b in bits[:64]))]
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    words = {i: t.split() for i, t in rows}
    seen, want = set(), {}
    for i, w in words.items():
        runs = [tuple(w[k:k + 13]) for k in range(len(w) - 12)]
        want[i] = len({k + j for k, r in enumerate(runs) if r in seen for j in range(13)})
        seen |= set(runs)
    assert got == want and got[2] == 0 and got[3] == 13


def test_largest_id_survives(spark):
    rows = [(2**63 - 1, "a b c"), (None, "d e f"), (-2**63, "g")]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.n_words) for r in got} == {(2**63 - 1, 3), (None, 3), (-2**63, 1)}


def _near(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count() <= 4


def test_documents_meet_through_a_text_without_id(spark):
    base = [f"word{i} " for i in range(400)]
    fp = lambda t: simhash.fingerprint(t)
    middle = "".join(base)
    near = []
    for k in range(2000):  # two texts near the middle one, far from each other
        words = base[:]
        words[(k * 7) % 400] = f"x{k} "
        words[(k * 13 + 5) % 400] = f"y{k} "
        t = "".join(words)
        if _near(fp(t), fp(middle)):
            near.append(t)
    one, two = next((a, b) for i, a in enumerate(near) for b in near[i + 1:] if not _near(fp(a), fp(b)))
    rows = [(1, one), (2, two), (None, middle)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.component_id for r in simhash.near_duplicates(df).collect()} == {1}
    assert [r.doc_id for r in simhash.keep_one(df).collect()] == [1]
    nameless = spark.createDataFrame([(None, one), (None, middle), (None, two), (7, "alone")], df.schema)
    assert simhash.keep_one(nameless).count() == 2


def test_same_mix_in_any_layout(spark):
    rows = [(i % 7, f"{'w ' * (1 + i % 11)}{i % 13}", f"s{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    a = sorted(map(tuple, mixing.mix(df.repartition(5)).collect()))
    b = sorted(map(tuple, mixing.mix(df.repartition(3, "text").orderBy(F.desc("text"))).collect()))
    assert a == b


def test_mixed_documents_keep_their_columns(spark):
    rows = [(1, "a b c", "s", 5, "k"), (2, None, None, 6, None), (2, "", "s", 7, "m"), (None, "d", "t", 8, "n"), (1, "a b c", "s", 5, "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, taken int, prefix string")
    got = mixing.mix_documents(df)
    assert got.columns == ["doc_id", "text", "source", "prefix", "size", "source_size", "target", "taken", "epochs"]
    assert sorted(map(str, got.select("doc_id", "size", "source_size", "target", "taken", "epochs").collect())) == sorted(
        map(str, mixing.mix(df).select("doc_id", "size", "source_size", "target", "taken", "epochs").collect()))
    assert sorted(map(str, got.select("doc_id", "text", "source", "prefix").collect())) == sorted(
        map(str, df.select("doc_id", "text", "source", "prefix").collect()))
    assert mixing.mix_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("names", [["_digest", "_spans", "_new", "digest", "spans", "doc", "new"],
                                   ["_fp", "fp", "row", "node", "doc", "n", "id"]])
def test_columns_of_any_name(spark, names):
    rows = [(1, "mail a.b@example.org now", *range(len(names))), (2, None, *range(len(names))),
            (2, None, *range(len(names))), (3, "plain text here", *range(len(names)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"{n} int" for n in names))
    red = pii.redact(df)
    assert red.columns == df.columns and sorted(map(str, red.drop("text").collect())) == sorted(map(str, df.drop("text").collect()))
    assert red.where("doc_id = 1").first()["text"] == "mail [EMAIL] now"
    one = simhash.keep_one(df)
    assert one.columns == df.columns and sorted(r.doc_id for r in one.collect()) == [1, 2, 3]
    assert one.exceptAll(df).isEmpty()


def test_workers_need_no_package(tmp_path):
    """Every operator with Python tasks, where workers cannot import this package."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setCheckpointDir({str(tmp_path)!r})
def there(_):
    try:
        import roadprint
        return [1]
    except ModuleNotFoundError:
        return [0]
assert sum(spark.sparkContext.parallelize(range(4), 4).mapPartitions(there).collect()) == 0, "importable"
for name, q in e.queries().items():
    if name.startswith("op") and name.split("_")[0] not in ("op3", "op5", "op9", "op13", "op6"):
        print(name, q(spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert got.returncode == 0, got.stderr[-3000:]
    assert got.stdout.count("op") >= 8
