"""Token counts with a digest cache: every distinct text is encoded once per tokenizer version."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadprint.session import shared_dir

PIECES_HELD = 1_000_000  # pieces a task remembers; then it starts afresh
MAX_TOKENIZER_BYTES = 64 << 20  # of a tokenizer file, which goes to every task
CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens bigint"

# Two white-space characters in a row: such a text is counted whole.  In any other text a
# space stands between two non-space characters, where it always starts a pre-token of a
# byte-level tokenizer (" ?\p{L}+" and its siblings take it as their first character),
# so the counts of the parts add up to the count of the whole.
WIDE_SPACE = re.compile(r"\s\s|^\s|\s\Z")


def tokenizer_version(path: str) -> tuple[bytes, str]:
    """The file's bytes and the digest of bytes, library and library version."""
    with open(path, "rb") as f:
        data = f.read()
    if len(data) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} is larger than {MAX_TOKENIZER_BYTES} bytes")
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    kind = f"{library.__name__} {library.__version__}"
    return data, hashlib.sha256(kind.encode() + b"\0" + data).hexdigest()


def load_counter(data: bytes, kind: str) -> Callable[[str], int]:
    """A function giving the number of tokens of a text."""
    if kind == "model":
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda text: len(sp.encode(text))
    import json
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(data.decode("utf-8"))
    tok.no_truncation()
    tok.no_padding()
    spec = json.loads(data)
    pre = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    additive = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or " " in t["content"]
                            for t in added))
    if not additive:
        return lambda text: len(tok.encode(text, add_special_tokens=False))
    held: dict[str, int] = {}  # tokens of " " + part
    whole = lambda text: len(tok.encode(text, add_special_tokens=False))

    def count(text: str) -> int:
        if WIDE_SPACE.search(text):
            return whole(text)
        first, *parts = text.split(" ")
        new = set(parts).difference(held)
        if len(held) + len(new) > PIECES_HELD:
            held.clear()
            new = set(parts)
        if new:
            got = tok.encode_batch_fast([" " + p for p in new], add_special_tokens=False)
            held.update(zip(new, map(len, got)))
        return whole(first) + sum(map(held.__getitem__, parts))

    return count


def encode_counts(texts: DataFrame, path: str, out: str = "n_tokens") -> DataFrame:
    """``texts`` (column text) with the number of tokens in column ``out``."""
    data, _ = tokenizer_version(path)
    kind = path.rsplit(".", 1)[-1]
    sent = texts.sparkSession.sparkContext.broadcast(data)  # at most MAX_TOKENIZER_BYTES

    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = load_counter(sent.value, kind)
        for batch in batches:
            yield pd.Series([count(t) for t in batch], dtype="int64")

    return texts.withColumn(out, of("text"))


def cached_counts(spark, cache: str, version: str) -> DataFrame | None:
    """(digest, n_tokens) known for a tokenizer version; None where there is no cache yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def count_tokens(documents: DataFrame, tokenizer_path: str, cache: str | None = None, limit: int = 512,
                 normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document.

    Contents are compared by the SHA-256 of their normalised text.  ``normalise`` must not
    change counts; a byte-level tokenizer sees every byte, so the default changes nothing.
    Digests that the cache (a Parquet folder; a new one in the shared folder by default)
    does not hold for this tokenizer version are encoded once each and appended, and all
    documents join the cache.  Copies are merged before the shuffle.

    Null texts count as empty (0 bytes, 0 tokens of a byte-level tokenizer); special
    strings inside texts are handled as the tokenizer file says; no special tokens are
    added; repeated rows give repeated rows; an empty table gives no rows.
    """
    spark = documents.sparkSession
    cache = cache or shared_dir(spark, "token-cache")
    _, version = tokenizer_version(tokenizer_path)
    text = F.coalesce("text", F.lit(""))
    docs = documents.select("doc_id", (normalise(text) if normalise else text).alias("text"),
                            F.octet_length(text).cast("bigint").alias("n_bytes")).withColumn(
        "digest", F.unhex(F.sha2(F.col("text"), 256)))
    misses = docs.groupBy("digest").agg(F.first("text").alias("text"))
    known = cached_counts(spark, cache, version)
    if known is not None:
        misses = misses.join(known, "digest", "left_anti")
    (encode_counts(misses, tokenizer_path)
     .select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache))
    return (docs.select("doc_id", "n_bytes", "digest").join(cached_counts(spark, cache, version), "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
