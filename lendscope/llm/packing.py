"""Packing (operator 9): concatenate and cut.

Pass one turns each text into token ids (plus an end id) and writes them once,
with the document's token offset inside its partition. The partition totals,
one row per task, give by a prefix sum where each partition begins in the one
long token stream. Pass two is a map: each document knows its global start, so
it cuts itself at multiples of the window; a document that crosses a window
leaves one record on each side of the boundary. Only the last window of the
whole stream is short.

Ids are those of the ``tokenizers`` file byte_bpe_50k.json without added special
tokens; they are made from the same vocabulary as ranks, which encodes several
times as fast (a test holds the two against each other); a text that the fast
encoder can't take, with a run of about a million blanks or line ends, is
encoded from the file itself.

Cases: null text counts as empty and gives the end id alone; repeated rows are packed each; a
null id stays null; an empty table gives no rows. Pieces cover each id once.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lendscope.llm.common import batch, staged, str_texts

WINDOW = 2048
END_ID = 1
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256

_IDS = pa.schema([("doc_id", pa.int64()), ("part", pa.int64()), ("at", pa.int64()), ("n", pa.int64()),
                  ("ids", pa.binary())])
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                     ("offset", pa.int64())])


class Encoder:
    """Token ids of a text, packed as 16-bit integers (the vocabulary has fewer
    than 65,536 ids)."""

    def __init__(self, ranks_path: str | None = None):
        import public_tokenizers
        import tiktoken
        with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={SPECIAL: SPECIAL_ID})

    def __call__(self, text: str) -> bytes:
        """The special token's string, where a text holds it, gives its id."""
        try:
            ids = self.bpe.encode(text, allowed_special="all")
        except UnicodeEncodeError:  # a lone surrogate
            return self(text.encode("utf-8", "replace").decode())
        except ValueError:  # a run of about a million blanks is too long for the pattern's matcher
            ids = self.full.encode(text, add_special_tokens=False).ids
        return array("H", ids).tobytes()

    @cached_property
    def full(self):
        """The ``tokenizers`` file itself, slower and without that limit."""
        import public_tokenizers
        from tokenizers import Tokenizer
        return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _tokenise(ranks_path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, at, part = Encoder(ranks_path), 0, TaskContext.get().partitionId()
        end = np.array([END_ID], np.uint16).tobytes()
        for b in batches:
            ids = [encode(t) + end for t in str_texts(b.column(1))]
            n = np.array([len(i) // 2 for i in ids], np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield batch(_IDS, b.column(0), np.full(len(n), part), starts, n, ids)
    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, begin, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids = np.frombuffer(raw, np.uint16).astype("<u4")
                at = 0
                while at < len(ids):
                    seq, off = divmod(begin + at, window)
                    n = min(window - off, len(ids) - at)
                    rows.append((doc, at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids), seq, off))
                    at += n
            if rows:
                yield batch(_PIECES, *zip(*rows))
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         ranks_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    ids = staged(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
                 .mapInArrow(_tokenise(ranks_path), "doc_id long, part long, at long, n long, ids binary"), "tokens")
    totals = ids.groupBy("part").agg(F.sum("n").alias("total"))
    # one row per task of pass one, whatever the number of documents
    offsets = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    return (ids.join(F.broadcast(offsets), "part")
            .select("doc_id", (F.col("before") + F.col("at")).alias("begin"), "ids")
            .mapInArrow(_cut(window), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                      "sequence_id long, offset long"))
