import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lendscope.llm import packing


def test_encoder_equals_the_tokenizers_file(spark, sf_small):
    encode = packing.Encoder()
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    texts += ["a  b", " a", "a ", "x <|endoftext|> y", "a\xa0 b", "\x1c a \x1d b", "don't  'll x", "…  é", "a\tb c", ""]
    for t in texts:
        ids = full.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(encode(t), np.uint16).tolist() == ids


def check(rows, texts, window):
    encode = packing.Encoder()
    by_doc, stream = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        assert 0 < r.length <= window and r.offset + r.length <= window
        for k in range(r.length):
            assert stream.setdefault((r.sequence_id, r.offset + k), r.doc_id) == r.doc_id
    assert len(stream) == sum(r.length for r in rows)
    full = max(s for s, _ in stream)  # every sequence but the last is full, the last has no gap
    last = sorted(o for s, o in stream if s == full)
    assert len(stream) == full * window + len(last) and last == list(range(len(last)))
    for doc, text in texts.items():
        ids = np.append(np.frombuffer(encode(text or ""), np.uint16), packing.END_ID).astype("<u4")
        pieces = sorted(by_doc[doc], key=lambda r: r.start)
        at = 0
        for p in pieces:
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


def test_every_id_lies_in_one_piece(docs_of):
    texts = {i: ("word " * (i * 7 % 50)) + "é漢" * (i % 3) if i % 6 else None for i in range(60)}
    rows = packing.pack(docs_of(list(texts.items())).repartition(5), window=64).collect()
    check(rows, texts, 64)


def test_awkward_rows(awkward):
    rows = packing.pack(awkward).collect()
    assert sum(r.start == 0 for r in rows) == awkward.count()
    assert {r.doc_tokens for r in rows if r.doc_id in (1, 2)} == {1}
    assert sum(r.length for r in rows if r.start >= 0) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert packing.pack(awkward.limit(0)).count() == 0


def test_long_runs_of_blanks_and_line_ends(docs_of):
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.Encoder()
    for text in (" " * 2_000_000, "\n" * 2_000_000, "\t" * 1_200_000 + "x", "a" + " \n" * 700_000 + "b c"):
        ids = full.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), np.uint16).tolist() == ids
    rows = packing.pack(docs_of([(1, " " * 1_200_000 + "end"), (2, "a b")])).collect()
    check(rows, {1: " " * 1_200_000 + "end", 2: "a b"}, packing.WINDOW)
