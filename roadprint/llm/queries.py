"""Registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadprint.llm import alignment, decontam, fingerprints, lexical, mixing, pii, simhash, substrings, tokens, toxicity, urls, vectors, warc
from roadprint.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that share a tile, with the item's coverage."""
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are left without passages of 13 words of earlier documents."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page url: fixed rules, else its host's path-template tree.

    A page's label is that of the document with its number: bad where quality is 0.
    """
    labelled = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).cast("int").alias("bad"))
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), labelled)


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of one label with cosine 0.93 or more."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3, ... over their sources, at most 3 epochs."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels outside the held-out fifth."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every whole document."""
    return pii.scan(table(spark, sf_dir, "documents"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document for the 50k byte-level BPE, through a fresh digest cache."""
    import public_tokenizers
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of a byte-level BPE and a sentencepiece model over every document."""
    import public_tokenizers
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_substrings": op2_substrings,
    "op3_urls": op3_urls,
    "op4_embeddings": op4_embeddings,
    "op5_mixing": op5_mixing,
    "op6_toxicity": op6_toxicity,
    "op7_warc": op7_warc,
    "op8_simhash": op8_simhash,
    "op9_pii": op9_pii,
    "op10_tokens": op10_tokens,
    "op11_lexical": op11_lexical,
    "op12_alignment": op12_alignment,
    "op13_fingerprints": op13_fingerprints,
}

# The mix in one statement: the cap-per-weight order as in water_fill, then a running
# sum of sizes in draw order meets each source's remainder.
MIXING_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk,
    md5('42|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || coalesce(md5(text), 'null')) AS draw FROM documents),
s0 AS (SELECT sk, CAST(sum(size) AS BIGINT) AS source_size,
    1 + (row_number() OVER (ORDER BY sk) - 1) % 3 AS weight FROM d GROUP BY sk),
s1 AS (SELECT *, 3 * source_size AS cap, row_number() OVER o AS pos,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_weight
    FROM s0 WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / weight, sk)),
s2 AS (SELECT *, cap * rest_weight <= rest * weight AS clamped FROM s1),
lv AS (SELECT arg_min(rest, pos) AS r, arg_min(rest_weight, pos) AS w FROM s2 WHERE NOT clamped),
s3 AS (SELECT sk, source_size, CASE WHEN clamped THEN CAST(cap AS DOUBLE)
    ELSE CAST(lv.r AS DOUBLE) * weight / lv.w END AS target FROM s2, lv),
s4 AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS words FROM s3),
s5 AS (SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS epochs FROM s4),
r AS (SELECT d.doc_id, d.size, s5.source_size, s5.target, s5.epochs, words - epochs * source_size AS remainder,
    coalesce(sum(d.size) OVER (PARTITION BY d.sk ORDER BY d.draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN s5 USING (sk))
SELECT doc_id, size, source_size, target, CAST(epochs AS BIGINT) AS epochs,
    CAST(size * epochs + greatest(0, least(size, remainder - before)) AS BIGINT) AS taken FROM r
"""

# A window goes if its words also start in a document with a smaller id (null: after all others).
SUBSTRINGS_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS rank,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
word AS (SELECT r, rank, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p,
    unnest(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN i + 12 <= len(w)
        THEN array_to_string(w[i:i + 12], ' ') END)) AS k FROM d),
seen AS (SELECT r, word, p, k IS NOT NULL AND rank > min(rank) OVER (PARTITION BY k) AS again FROM word),
cut AS (SELECT r, word, p, bool_or(again) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)
    AS gone FROM seen),
kept AS (SELECT r, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS t FROM cut GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM q)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND last_id IS DISTINCT FROM page_id AND last_id IS NOT NULL
        THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND last_id IS DISTINCT FROM page_id THEN last_id END AS refers_to FROM m
"""

# Term counts of the items' terms only; integers but for the logarithm.
LEXICAL_SQL = r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, up, low),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents, fold WHERE text IS NOT NULL),
dn AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
c AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM dn),
q AS (SELECT DISTINCT item, item_id, unnest(regexp_extract_all(translate(text, up, low),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item, * FROM benchmark), fold WHERE text IS NOT NULL),
v AS (SELECT DISTINCT term FROM q),
o AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM dn) JOIN v USING (term) GROUP BY r, term),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
    FROM (SELECT term, count(*) AS df FROM o GROUP BY term), c),
g AS (SELECT r, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nd) // l))) AS s
    FROM o JOIN wt USING (term) JOIN dn USING (r), c),
sc AS (SELECT item, item_id, r, CAST(sum(s) AS BIGINT) AS score FROM q JOIN g USING (term) GROUP BY item, item_id, r),
rk AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item
    ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM sc JOIN dn USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM rk WHERE rank <= 50
"""

ORACLE_SQL = {"op11_lexical": LEXICAL_SQL, "op2_substrings": SUBSTRINGS_SQL, "op5_mixing": MIXING_SQL, "op7_warc": WARC_SQL}
