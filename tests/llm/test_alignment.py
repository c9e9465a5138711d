"""Cross-tokenizer alignment against whole-text encoding and plain dictionaries."""

import hashlib
from collections import Counter

import public_tokenizers as public
import pytest

from roadprint.llm import alignment
from roadprint.llm.queries import op12_alignment

A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def brute(rows):
    """Rows (doc_id, text): every text encoded whole, offsets compared in dictionaries."""
    import sentencepiece
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    of_char = alignment.byte_alphabet()
    found, counts = [], Counter()
    for doc_id, text in rows:
        want = b" " + (text or "").encode()
        a = tok.encode(" " + (text or ""), add_special_tokens=False).ids
        b = sp.encode(text or "")
        pa_ = [bytes(of_char[c] for c in tok.id_to_token(i)) for i in a]
        pb = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
              for i, p in ((i, sp.id_to_piece(i)) for i in b)]
        if not text or b"".join(pa_) != want or b"".join(pb) != want:
            a, b, pa_, pb = [], [], [], []
        ends = []
        for parts in (pa_, pb):
            at, out = 0, []
            for p in parts:
                at += len(p)
                out.append(at)
            ends.append(out)
        at_b = dict(zip(ends[1], b))
        links = [(x, at_b[e]) for x, e in zip(a, ends[0]) if e in at_b]
        counts.update(links)
        found.append((doc_id, a, b, ends, links))
    high = {}
    for (_, y), n in counts.items():
        high[y] = max(high.get(y, 0), n)
    out = []
    for doc_id, a, b, ends, links in found:
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            i2, j2 = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        out.append((doc_id, len(a), len(b), len(groups), len(links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
                    sum(counts[p] == high[p[1]] for p in links), sum(counts[p] for p in links)))
    return out


def check(spark, rows, schema="doc_id bigint, text string", **how):
    got = alignment.align(spark.createDataFrame(rows, schema), A, B, **how).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute([r[:2] for r in rows]), key=repr)


@pytest.mark.parametrize("how", [{}, {"block_bytes": 300, "step_bytes": 50}])
def test_texts_of_every_kind(spark, how):
    texts = ["a plain text, with words", "two  spaces and\n\nlines", " leading", "trailing ", "   ", "x", "",
             None, "naïve Élan 東京 🎉🎉 ok", "a mark ▁ of spaces", "literal <s> </s> <unk> <0x41> <|endoftext|> here",
             "tab\tand\x0bmore\x00nul", "nbsp here wide", "word " * 3000 + "end", "x" * 5000, "' s don't  'll",
             "a plain text, with words", "١٢٣ ½ ﬁ ﬀ Å", "line one\nline two\r\nline three"]
    check(spark, list(enumerate(texts)) + [(None, "no id at all"), (1, "a plain text, with words")], **how)


def test_empty_table_and_other_columns(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id bigint, text string"), A, B).count() == 0
    rows = [(1, "some words here", 5, "x"), (2, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, block bigint, links string")
    assert sorted(map(tuple, alignment.align(df, A, B).collect())) == sorted(brute([r[:2] for r in rows]))
    named = alignment.align(df.withColumn("doc_id", df.doc_id.cast("string")), A, B)
    assert named.schema["doc_id"].dataType.simpleString() == "string" and named.count() == 2


def test_units_are_forgotten(spark, monkeypatch):
    """A full store of units starts afresh without a change of results."""
    encoder = alignment.Encoder(open(A, "rb").read(), open(B, "rb").read())
    import pyarrow as pa
    texts = pa.array(["one two three", "two three four five", "six seven eight nine ten"])
    want = [alignment.align_texts(encoder, texts[k:k + 1]) for k in range(3)]
    monkeypatch.setattr(alignment, "UNITS_HELD", 4)
    small = alignment.Encoder(open(A, "rb").read(), open(B, "rb").read())
    got = [alignment.align_texts(small, texts[k:k + 1]) for k in range(3)]
    assert all(w[0].equals(g[0]) and w[1].equals(g[1]) for w, g in zip(want, got)) and len(small.held) <= 5


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_alignment(spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows), key=repr)
