"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, with multiprobe."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadprint.llm.common import components, keep

MIN_COSINE = 0.93
TABLES = 10
PROBES = 3  # buckets that a vector is put in per table, its own included
SEED = 5
BUCKET_ROWS = 64  # vectors that a bucket of unrelated vectors should hold: sets the hashes per table
WIDE_RUN = 32  # buckets above this are multiplied as matrices
PIECE_ROWS = 8192  # rows of whole buckets worked on at a time
BLOCK_ROWS = 2048  # a larger bucket is compared in pairs of blocks of this many rows


def rotate(x: np.ndarray, table: int, part: int) -> np.ndarray:
    """Three rounds of random signs and a fast Hadamard transform, on rows padded to a power of two."""
    n = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), n))
    y[:, :x.shape[1]] = x
    rng = np.random.default_rng([SEED, table, part, n])
    for _ in range(3):
        y = y * rng.choice([-1.0, 1.0], n)
        h = 1
        while h < n:
            z = y.reshape(len(y), n // (2 * h), 2, h)
            y = np.concatenate([z[:, :, :1] + z[:, :, 1:], z[:, :, :1] - z[:, :, 1:]], axis=2).reshape(len(y), n)
            h *= 2
        y /= math.sqrt(n)
    return y


def codes(x: np.ndarray, table: int, hashes: int, probes: int = PROBES) -> np.ndarray:
    """(rows, probes) bucket codes of unit rows in one table.

    A hash is the signed axis nearest to the rotated vector; ``hashes`` of them make a code.
    The further probes replace the hash whose runner-up axis is nearest to its best one.
    """
    best, second, gap = [], [], []
    for part in range(hashes):
        y = rotate(x, table, part)
        size = np.abs(y)
        top = np.argpartition(-size, min(1, size.shape[1] - 1), axis=1)[:, :2]
        rows = np.arange(len(x))[:, None]
        top = np.take_along_axis(top, np.argsort(-size[rows, top], axis=1, kind="stable"), axis=1)
        axis = 2 * top + (y[rows, top] < 0)
        best.append(axis[:, 0])
        second.append(axis[:, -1])
        gap.append(size[rows[:, 0], top[:, 0]] - size[rows[:, 0], top[:, -1]])
    base = 2 * y.shape[1]
    power = np.array([base ** k for k in range(hashes)], np.int64)
    best, second, gap = np.stack(best, 1), np.stack(second, 1), np.stack(gap, 1)
    own = best @ power
    out = [own]
    order = np.argsort(gap, axis=1, kind="stable")
    for p in range(probes - 1):
        at = order[:, p % hashes]
        rows = np.arange(len(x))
        out.append(own + (second[rows, at] - best[rows, at]) * power[at] if p < hashes else own)
    return np.stack(out, 1)


def _spread(batches: Iterator[pa.RecordBatch], hashes: int) -> Iterator[pa.RecordBatch]:
    """One row per vector, table and distinct probe: its bucket (label, dim, t, code) and id."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for d in np.unique(dims):
            part = batch.filter(pa.array(dims == d))
            x = _unit(part)
            for t in range(TABLES):
                c = codes(x, t, hashes)
                for p in range(PROBES):
                    new = (c[:, :p] != c[:, p:p + 1]).all(axis=1)
                    rows = part.select(["label", "dim", "id"]).filter(pa.array(new))
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(np.full(len(rows), t, np.int32)), pa.array(c[new, p])],
                        names=["label", "dim", "id", "t", "code"])


def _unit(batch: pa.RecordBatch) -> np.ndarray:
    """Rows of column v (equal lengths) as unit rows in double precision."""
    col = batch.column("v")
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large components would overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pairs(x: np.ndarray, run: np.ndarray, side: np.ndarray, one: np.ndarray, cosine: float):
    """Linked pairs (i, j), i < j, of rows of one run; of runs of two blocks only pairs across them."""
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[starts, len(run)])
    left, right = [], []
    wide = np.repeat(sizes > WIDE_RUN, sizes)
    for d in range(1, min(WIDE_RUN, int(sizes.max()))):
        i = np.flatnonzero((run[d:] == run[:-d]) & ~wide[d:] & (one[d:] | (side[d:] != side[:-d])))
        i = i[np.einsum("ij,ij->i", x[i], x[i + d]) >= cosine]
        left.append(i)
        right.append(i + d)
    for s, m in zip(starts[sizes > WIDE_RUN].tolist(), sizes[sizes > WIDE_RUN].tolist()):
        for k in range(s, s + m, 256):
            i, j = np.nonzero(x[k:min(k + 256, s + m)] @ x[s:s + m].T >= cosine)
            i, j = i + k, j + s
            ok = (i < j) & (one[i] | (side[i] != side[j]))
            left.append(i[ok])
            right.append(j[ok])
    cat = lambda z: np.concatenate(z) if z else np.zeros(0, np.int64)
    return cat(left), cat(right)


def _roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest row reachable by the pairs, for each of n rows."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == before).all():
            return root


def _links(rows: pa.Table, cosine: float, hashes: int) -> pa.RecordBatch:
    """Links within whole runs of one bucket or pair of blocks (``g``), one vector length.

    Returns link counts of rows (b = -1) and each row's smallest connected row of its run
    (a, b).  A pair counts only in the first bucket, by table and code, where it meets.
    """
    col = {c: rows.column(c).to_numpy() for c in ("g", "id", "weight", "side", "lo", "hi", "t", "code")}
    x = _unit(rows.select(["v"]).combine_chunks().to_batches()[0])
    i, j = _pairs(x, col["g"], col["side"], col["lo"] == col["hi"], cosine)
    n = np.zeros(len(x), np.int64)
    if len(i):
        used, at = np.unique(np.r_[i, j], return_inverse=True)
        a, b = at[:len(i)], at[len(i):]
        first = np.ones(len(i), bool)
        for t in range(int(col["t"][i].max()) + 1):
            c = codes(x[used], t, hashes)
            for s in range(0, len(i), 1 << 16):
                e = slice(s, s + (1 << 16))
                same = c[a[e]][:, :, None] == c[b[e]][:, None, :]
                low = np.where(same, c[a[e]][:, :, None], np.iinfo(np.int64).max).min(axis=(1, 2))
                at_t = col["t"][i[e]]
                first[e] &= (at_t < t) | ((at_t > t) & ~same.any(axis=(1, 2))) | (
                    (at_t == t) & (low == col["code"][i[e]]))
        np.add.at(n, i[first], col["weight"][j[first]])
        np.add.at(n, j[first], col["weight"][i[first]])
    root = _roots(i, j, len(x))
    own, up = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(x)))
    return pa.RecordBatch.from_pydict({
        "a": np.r_[col["id"][own], col["id"][up]], "b": np.r_[np.full(len(own), -1), col["id"][root[up]]],
        "n": np.r_[n[own], np.zeros(len(up), np.int64)]})


def _meet(batches: Iterator[pa.RecordBatch], cosine: float, hashes: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by dim and g, in pieces cut between runs."""
    held = None
    for batch in batches:
        held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        if held.num_rows < PIECE_ROWS:
            continue
        g = held.column("g").to_numpy()
        cut = int(np.flatnonzero(g != g[-1]).max(initial=-1)) + 1
        if cut:
            yield from _by_length(held.slice(0, cut), cosine, hashes)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield from _by_length(held, cosine, hashes)


def _by_length(rows: pa.Table, cosine: float, hashes: int) -> Iterator[pa.RecordBatch]:
    dims = rows.column("dim").to_numpy()
    for d in np.unique(dims):
        yield _links(rows.filter(pa.array(dims == d)), cosine, hashes)


def near_duplicates(embeddings: DataFrame, cosine: float = MIN_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``embeddings(vec_id, embedding, label)``.

    Vectors of one label are linked if they meet in a bucket and their cosine, in double
    precision, is ``cosine`` or more.  Equal vectors are first merged to their smallest
    vec_id with a weight (a partial aggregate), so copies are neither hashed nor paired.
    Buckets above BLOCK_ROWS are compared in pairs of blocks, each a task's group, so every
    bucket is compared whole in bounded memory.  Link counts and a spanning set of links
    leave the tasks, never all pairs.

    Null, zero, empty and non-finite vectors, null labels and null vec_ids link with nothing
    (their component is their own vec_id); vectors of different lengths never link; repeated
    rows link with each other; an empty table gives no rows; other columns are ignored.
    """
    rows = embeddings.select("vec_id", "label", F.col("embedding").alias("v"))
    whole = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
             & F.coalesce(F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (
                 F.abs(e.cast("double")) < float("inf"))),
                          F.lit(False)) & F.exists("v", lambda e: e != 0))
    rows = rows.withColumn("whole", F.coalesce(whole, F.lit(False)))
    nodes = keep(rows.where("whole").groupBy("label", "v").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")), "vectors")
    # A vec_id that names several different vectors would name several nodes: number nodes apart.
    nodes = keep(nodes.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    n, dim = nodes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = 2 << max(0, (dim or 1) - 1).bit_length()
    hashes = max(1, min(3, round(math.log(max(n, 1) / BUCKET_ROWS + 1, width)) + 1))
    dealt = keep(nodes.select(F.col("node").alias("id"), F.col("label").cast("bigint").alias("label"),
                              F.size("v").alias("dim"), "v").mapInArrow(
        lambda b: _spread(b, hashes), "label bigint, dim int, id bigint, t int, code bigint"), "vector-buckets")
    bucket = ["label", "dim", "t", "code"]
    full = dealt.groupBy(*bucket).agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(
        *bucket, F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("blocks"))
    met = (dealt.join(full, bucket).withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other"))
           .withColumn("g", F.xxhash64(*bucket, "lo", "hi")).drop("other", "blocks", "label")
           .join(nodes.select(F.col("node").alias("id"), "weight", "v"), "id")
           .repartition("dim", "g").sortWithinPartitions("dim", "g", "t", "code", "id"))
    links = keep(met.mapInArrow(lambda b: _meet(b, cosine, hashes), "a bigint, b bigint, n bigint"), "vector-links")
    counts = links.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    comp = components(links.where("b >= 0").select("a", "b")).withColumnRenamed("node", "of")
    named = nodes.join(counts, "node", "left").join(comp, F.col("node") == F.col("of"), "left").withColumn(
        "root", F.coalesce("component", "node"))
    lowest = named.groupBy("root").agg(F.min("id").alias("component_id"))
    known = keep(named.join(lowest, "root").select("label", "v", "component_id", (
        F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "vector-groups")
    none = rows.where("not whole").select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    found = rows.where("whole").join(known, ["label", "v"]).select("vec_id", "n_links", "component_id")
    return found.unionByName(none).select("vec_id", "n_links", "component_id",
                                          F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
