"""Cross-tokenizer alignment: which tokens of two tokenizers end on the same byte of a text.

A task works through its documents in Arrow.  Texts are cut into units (words, where both
tokenizers provably encode words alone, else the whole text); every distinct unit is encoded
once, and lists of token ids are taken per unit and flattened to documents.  Token byte lengths
are summed up per document (a running sum less its value at the document's parent index), and an
Acero hash join on (document, end) pairs the tokens that end together.  Pair counts are grouped in
Arrow per block of documents and summed by Spark; each block then meets the counts of its own
pairs only.

1. ``encode_blocks``: blocks of documents, written once: per document its sizes, the digest of its
   groups and its links as numbers into the block's distinct pairs, and these pairs with their counts.
2. ``pair_counts``: the corpus-wide count of each pair, and whether it is the highest of its B id.
3. ``align``: blocks cogrouped with the counts of their pairs; sums per document.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadprint.llm.common import keep

BLOCK_BYTES = 8 << 20  # text of a block; a longer document is a block of its own
STEP_BYTES = 1 << 20  # text that is aligned at once; a longer document goes alone
UNITS_HELD = 400_000  # distinct units a task remembers; then it starts afresh
UNIT_HELD = 64  # characters; a longer unit is encoded but not remembered
MAX_TOKENIZER_BYTES = 64 << 20  # of a tokenizer file, which goes to every task

# Two white-space characters in a row, or one at an end: such a text is one unit.  In any other
# text every space stands between two non-space characters.
WIDE_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]{2}|\A[\s\x0b\x1c-\x1f\x{85}\p{Z}]|[\s\x0b\x1c-\x1f\x{85}\p{Z}]\z"


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the byte-level alphabet: printable bytes stand for themselves, the
    others for the code points from 256 up, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A: a byte-level BPE of the ``tokenizers`` library; a unit is encoded after a space."""

    def __init__(self, data: bytes):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(data.decode("utf-8"))
        self.tok.encode_special_tokens = True  # their strings inside texts are plain text
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(data)
        pre = spec.get("pre_tokenizer") or {}
        # A space before a non-space always starts a pre-token (" ?\p{L}+" and its siblings).
        self.by_word = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                        and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                        and all(t["special"] for t in spec.get("added_tokens") or []))
        alphabet = byte_alphabet()
        self.bytes = [b""] * self.tok.get_vocab_size()
        for token, i in self.tok.get_vocab().items():
            self.bytes[i] = (bytes(alphabet[c] for c in token) if all(c in alphabet for c in token)
                             else token.encode("utf-8"))

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]


class Pieces:
    """Tokenizer B: a sentencepiece model, which adds the space itself."""

    def __init__(self, data: bytes):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        # Words are encoded alone if no piece holds a space mark after anything but space marks.
        self.by_word = not any("▁" in p.lstrip("▁") for p in names)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                      for i, p in enumerate(names)]

    def encode(self, units: list[str]) -> list[list[int]]:
        return self.sp.encode(units, num_threads=1)


class Encoder:
    """Token ids of units by both tokenizers, every distinct unit encoded once while it is held."""

    def __init__(self, a: bytes, b: bytes):
        self.tokenizers = (ByteLevel(a), Pieces(b))
        self.by_word = all(t.by_word for t in self.tokenizers)
        self.lengths = [pa.array([len(x) for x in t.bytes], pa.int64()) for t in self.tokenizers]
        text = [pa.array(map(str, range(len(t.bytes)))) for t in self.tokenizers]
        # Ids as text with what follows them: A inside a group, A at its end, B inside, B at its end, B at the text's.
        self.names = pa.concat_arrays([pc.binary_join_element_wise(text[k], end, "")
                                       for k, end in ((0, ","), (0, "|"), (1, ","), (1, ";"), (1, ""))]).cast(pa.binary())
        self.names_from = np.cumsum([0, len(text[0]), len(text[0]), len(text[1]), len(text[1])])
        self.clear()

    def clear(self) -> None:
        self.held: dict[str, int] = {}
        empty = pa.array([], pa.list_(pa.int32()))
        self.kept = [empty, empty]
        self.kept_good = np.zeros(0, bool)

    def _encode(self, units: list[str]) -> tuple[list[pa.Array], np.ndarray]:
        """Token id lists of both tokenizers, and whether both spell the unit after a space."""
        good = np.ones(len(units), bool)
        lists = []
        for t in self.tokenizers:
            got = t.encode(units) if units else []
            for n, (u, ids) in enumerate(zip(units, got)):
                if b"".join(map(t.bytes.__getitem__, ids)) != b" " + u.encode("utf-8"):
                    good[n] = False
            lists.append(pa.array(got, pa.list_(pa.int32())))
        return lists, good

    def encode(self, units: list[str]) -> tuple[np.ndarray, list[pa.Array], np.ndarray]:
        """(row of every distinct unit, id lists by row of both tokenizers, which rows spell their unit)."""
        new = [u for u in units if len(u) <= UNIT_HELD and u not in self.held]
        if len(self.held) + len(new) > UNITS_HELD:
            self.clear()
            new = [u for u in units if len(u) <= UNIT_HELD]
        lists, good = self._encode(new)
        self.held.update(zip(new, range(len(self.kept_good), len(self.kept_good) + len(new))))
        self.kept = [pa.concat_arrays(z) for z in zip(self.kept, lists)]
        self.kept_good = np.concatenate([self.kept_good, good])
        long = [u for u in units if len(u) > UNIT_HELD]
        lists, good = self._encode(long)
        row_of = self.held | dict(zip(long, range(len(self.kept_good), len(self.kept_good) + len(long)))) if long else self.held
        return (np.fromiter(map(row_of.__getitem__, units), np.int64, len(units)),
                [pa.concat_arrays(z) for z in zip(self.kept, lists)], np.concatenate([self.kept_good, good]))


def units_of(texts: pa.Array, by_word: bool) -> pa.ListArray:
    """The units of every text; a unit stands for its bytes with a space before them."""
    whole = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1), pa.int32()), texts)
    if not by_word:
        return whole
    wide = pc.match_substring_regex(texts, WIDE_SPACE).to_numpy(zero_copy_only=False)
    order = np.concatenate([np.flatnonzero(~wide), np.flatnonzero(wide)])
    words = pc.split_pattern(texts.filter(pa.array(~wide)), " ")
    both = pa.concat_arrays([words, whole.filter(pa.array(wide)).cast(words.type)])
    return both.take(pa.array(np.argsort(order, kind="stable")))


def _tokens(lists: pa.ListArray, lengths: pa.Array, parents: pa.Array, n_docs: int):
    """(ids, document, byte end in its document) of the tokens of all units, and tokens per document."""
    ids = lists.flatten()
    doc = parents.take(pc.list_parent_indices(lists))
    ends = pc.cumulative_sum(lengths.take(ids))
    per_doc = np.bincount(doc.to_numpy(), minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(per_doc)[:-1]])  # a document's first token
    before = np.concatenate([[0], ends.to_numpy()])[first]
    return ids, doc, pc.subtract(ends, pa.array(before).take(doc)), per_doc


def align_texts(encoder: Encoder, texts: pa.Array) -> tuple[pa.RecordBatch, pa.Array]:
    """Sizes and group digest of every text (n_a, n_b, n_groups, n_links, groups_sha256), and per
    text the list of its links as a * 2^32 + b."""
    n = len(texts)
    units = units_of(texts.fill_null(""), encoder.by_word)
    parents = pc.list_parent_indices(units)
    coded = units.flatten().dictionary_encode()
    row_of, lists, good = encoder.encode(coded.dictionary.to_pylist())
    rows = row_of[coded.indices.to_numpy()]
    doc = parents.to_numpy()
    bad = np.zeros(n, bool)
    bad[doc[~good[rows]]] = True
    bad |= pc.equal(pc.binary_length(texts.fill_null("")), 0).to_numpy(zero_copy_only=False)
    left = ~bad[doc]
    rows, parents = pa.array(rows[left]), pa.array(doc[left])
    (a, doc_a, end_a, n_a), (b, doc_b, end_b, n_b) = (
        _tokens(lists[k].take(rows), encoder.lengths[k], parents, n) for k in (0, 1))
    links = pa.table({"doc": doc_a, "end": end_a, "a": a, "i": np.arange(len(a))}).join(
        pa.table({"doc": doc_b, "end": end_b, "b": b, "j": np.arange(len(b))}),
        ["doc", "end"], join_type="inner", use_threads=False)
    i, j = links["i"].to_numpy(), links["j"].to_numpy()
    cut_a, cut_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    cut_a[i] = cut_b[j] = True
    ends = np.flatnonzero(cut_b)
    n_groups = np.bincount(doc_b.to_numpy()[ends], minlength=n)
    # Groups in order, each its A ids and then its B ids.
    in_a, in_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    of_a, of_b = np.bincount(in_a, minlength=len(ends)), np.bincount(in_b, minlength=len(ends))
    place = np.empty(len(a) + len(b), np.int64)
    base = encoder.names_from
    last = np.zeros(len(b), bool)
    last[np.cumsum(n_b)[n_b > 0] - 1] = True
    place[np.arange(len(a)) + (np.cumsum(of_b) - of_b)[in_a]] = a.to_numpy() + base[cut_a.astype(np.int64)]
    place[np.arange(len(b)) + np.cumsum(of_a)[in_b]] = b.to_numpy() + base[2 + cut_b.astype(np.int64) + last]
    joined = pc.binary_join(pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(n_a + n_b)]), pa.int32()), encoder.names.take(pa.array(place))), b"")
    digests = [hashlib.sha256(s.as_buffer()).hexdigest() if k else "" for s, k in zip(joined, n_a.tolist())]
    pairs = (links["a"].to_numpy().astype(np.int64) << 32) | links["b"].to_numpy()
    at = links["doc"].to_numpy()
    n_links = np.bincount(at, minlength=n)
    per_text = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_links)]), pa.int32()),
                                        pa.array(pairs[np.argsort(at, kind="stable")]))
    return pa.RecordBatch.from_pydict({
        "n_a": pa.array(n_a, pa.int64()), "n_b": pa.array(n_b, pa.int64()), "n_groups": pa.array(n_groups, pa.int64()),
        "n_links": pa.array(n_links, pa.int64()), "groups_sha256": pa.array(digests, pa.string())}), per_text


BLOCK = "block bigint, docs binary, pairs array<struct<a:int,b:int,n:bigint>>"


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _block(number: int, parts: list[tuple[pa.RecordBatch, pa.Array]]) -> pa.RecordBatch:
    """A row of BLOCK: distinct pairs, the frequent first, and documents with links as their numbers."""
    links = pa.concat_arrays([p for _, p in parts])
    flat = links.flatten()
    pairs = pa.table({"pair": flat}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by(
        [("count_all", "descending"), ("pair", "ascending")])
    key = pairs["pair"].combine_chunks().to_numpy()
    size = pa.uint16() if len(key) <= 1 << 16 else pa.uint32()
    numbers = pc.index_in(flat, value_set=pa.array(key)).cast(size)
    docs = pa.Table.from_batches([d for d, _ in parts]).append_column(
        "links", pa.LargeListArray.from_arrays(links.offsets.cast(pa.int64()), numbers))
    entries = pa.StructArray.from_arrays([pa.array((key >> 32).astype(np.int32)), pa.array((key & 0xFFFFFFFF).astype(np.int32)),
                                          pairs["count_all"].combine_chunks().cast(pa.int64())], ["a", "b", "n"])
    return pa.RecordBatch.from_pydict({
        "block": pa.array([number], pa.int64()), "docs": pa.array([_packed(docs)], pa.binary()),
        "pairs": pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), entries)})


def _steps(batches: Iterator[pa.RecordBatch], step_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``step_bytes`` of text each."""
    for batch in batches:
        size = pc.binary_length(batch.column("text")).fill_null(0).to_numpy()
        step = np.cumsum(size) // step_bytes
        cuts = np.flatnonzero(np.r_[True, step[1:] != step[:-1], True])
        for s, e in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(s, e - s)


def encode_blocks(documents: DataFrame, byte_tokenizer: str, piece_model: str, block_bytes: int = BLOCK_BYTES,
                  step_bytes: int = STEP_BYTES) -> DataFrame:
    """Written blocks of aligned documents (see BLOCK); numbers of blocks are part of the table."""
    data = []
    for path in (byte_tokenizer, piece_model):
        with open(path, "rb") as f:
            data.append(f.read())
        if len(data[-1]) > MAX_TOKENIZER_BYTES:
            raise ValueError(f"{path} is larger than {MAX_TOKENIZER_BYTES} bytes")
    sent = documents.sparkSession.sparkContext.broadcast(tuple(data))  # at most 2 * MAX_TOKENIZER_BYTES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder = Encoder(*sent.value)
        number = TaskContext.get().partitionId() << 32
        parts, size = [], 0
        for step in _steps(batches, step_bytes):
            text = step.column("text").cast(pa.string())
            done, links = align_texts(encoder, text)
            parts.append((pa.RecordBatch.from_arrays([step.column("doc_id"), *done.columns], ["doc_id", *done.schema.names]),
                          links))
            size += text.nbytes
            if size >= block_bytes:
                yield _block(number, parts)
                number, parts, size = number + 1, [], 0
        if parts:
            yield _block(number, parts)

    return keep(documents.select("doc_id", "text").mapInArrow(pack, BLOCK), "alignment-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, n, best): links of each id pair in the whole corpus; ``best`` if no pair of b has more."""
    counts = keep(blocks.select(F.explode("pairs").alias("p")).groupBy("p.a", "p.b").agg(F.sum("p.n").alias("n")),
                  "alignment-pairs")
    high = counts.groupBy("b").agg(F.max("n").alias("high"))
    return counts.join(high, "b").select("a", "b", "n", (F.col("n") == F.col("high")).alias("best"))


def _sums(block: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of one block with the sums over their links."""
    docs = pa.concat_tables([pa.ipc.open_stream(d.as_buffer()).read_all() for d in block["docs"]])
    count, best = (np.zeros(len(answers), np.int64) for _ in range(2))
    at = answers["number"].to_numpy()
    count[at], best[at] = answers["n"].to_numpy(), answers["best"].to_numpy().astype(np.int64)
    links = docs["links"].combine_chunks()
    offsets, numbers = links.offsets.to_numpy(), links.values.to_numpy()
    for name, of in (("n_best", best), ("count_sum", count)):
        total = np.concatenate([[0], np.cumsum(of[numbers])])
        docs = docs.append_column(name, pa.array(total[offsets[1:]] - total[offsets[:-1]], pa.int64()))
    return docs.drop_columns(["links"])


def align(documents: DataFrame, byte_tokenizer: str, piece_model: str, block_bytes: int = BLOCK_BYTES,
          step_bytes: int = STEP_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every document.

    A is a byte-level BPE file of the ``tokenizers`` library and sees the text after a space; B is a
    ``sentencepiece`` model, which adds the space itself.  A link is a token of A and a token of B
    that end on the same byte; such ends cut both into groups.  ``count_sum`` adds up, over the
    document's links, how often their id pair is linked in all documents; ``n_best`` counts the links
    whose pair is the most frequent of its B id, ties included.

    Null and empty texts, and texts that either tokenizer does not spell back byte by byte, have no
    tokens (zeros, and an empty digest); repeated rows give repeated rows and count again; null ids
    stay null; an empty table gives no rows; other columns are ignored.  Long texts are aligned
    alone and whole.
    """
    blocks = encode_blocks(documents, byte_tokenizer, piece_model, block_bytes, step_bytes)
    entries = blocks.select("block", F.posexplode("pairs").alias("number", "p")).select("block", "number", "p.a", "p.b")
    answers = entries.join(pair_counts(blocks), ["a", "b"]).select(
        F.col("block").alias("of_block"), "number", "n", "best")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return blocks.select("block", "docs").groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(
        lambda block, found: _sums(block, found),
        f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "n_best bigint, count_sum bigint")
