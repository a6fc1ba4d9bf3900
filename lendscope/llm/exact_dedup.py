"""Exact dedup (operator 6): an extendible-hash index on shared files.

Texts are equal when identical after lowering A-Z. Each map batch collapses its
equal texts first, so a text that makes up a third of all rows reaches its owner
as one row per batch. Owner tasks each take a range of the 64-bit text key and
build an extendible-hash index in the shared folder: a directory of 2^depth
slots points at bucket files; a bucket that outgrows its page is split on the
next key bit, and the directory doubles when that bucket already uses all its
bits. Entries with the same key are chained and told apart by their bytes, so a
hash collision never merges two texts. The result is joined back to the rows by
(key, sha256).

Cases: null text counts as empty, and empty texts form one group; of equal texts
the row with the largest id stays; a repeated row (same id) counts in
``group_size`` and each copy is returned; an empty table gives an empty result;
other columns are ignored by the query and kept by ``drop_duplicates``. Texts of any length are
hashed and compared whole.

Recovery: an owner task writes under a folder of its own attempt, so a retry
never meets a half-written bucket.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from lendscope.llm.common import _open, batch, byte_texts, scratch, shuffle_partitions, staged

#: A bucket is split when its entries take more bytes than this (compressed).
PAGE_BYTES = 2 << 20
#: An owner buffers this many bytes before it appends them to bucket files.
BUFFER_BYTES = 16 << 20
_HEAD = "<QqqI"  # key, largest id, rows, bytes of the packed text

#: Dropped rows are sent to every task up to this many (16 bytes each), else joined by key.
BROADCAST_ROWS = 1_000_000

_KEYS = pa.schema([("doc_id", pa.int64()), ("raw_key", pa.int64()), ("text_key", pa.int64()), ("text_sha256", pa.string())])
_TEXTS = pa.schema([("owner", pa.int32()), ("text_key", pa.int64()), ("packed", pa.binary()),
                    ("keep_id", pa.int64()), ("group_size", pa.int64())])
_GROUPS = pa.schema([("text_key", pa.int64()), ("text_sha256", pa.string()), ("keep_id", pa.int64()),
                     ("group_size", pa.int64())])


def _key(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _row_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [t.lower() for t in byte_texts(b.column(1))]  # bytes.lower() lowers A-Z only
        yield batch(_KEYS, b.column(0), b.column(2), [_signed(_key(t)) for t in texts],
                    [hashlib.sha256(t).hexdigest() for t in texts])


def _collapse(owners: int):
    """Equal texts of a batch as one row; the owner is the key's range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            seen: dict[bytes, list[int]] = {}
            for i, t in zip(b.column(0).to_pylist(), byte_texts(b.column(1)), strict=True):
                e = seen.setdefault(t.lower(), [i, 0])
                e[0] = i if e[0] is None or (i is not None and i > e[0]) else e[0]
                e[1] += 1
            keys = [_key(t) for t in seen]
            yield batch(_TEXTS, [k * owners >> 64 for k in keys], [_signed(k) for k in keys],
                        [pack.compress(t) for t in seen], [e[0] for e in seen.values()],
                        [e[1] for e in seen.values()])
    return run


class ExtendibleIndex:
    """Extendible hashing over bucket files under ``uri``.

    ``directory[key's last depth bits]`` is a bucket number; ``depth_of`` a
    bucket's own depth. Entries are appended to their bucket's file; a bucket
    over ``page_bytes`` is split in two, which rewrites only that bucket. Equal
    entries that still wait are folded into one, and a bucket found to hold a
    single key is not looked at again until another key arrives, so a text that
    comes very often costs its inserts and no more."""

    def __init__(self, uri: str, page_bytes: int = PAGE_BYTES, buffer_bytes: int = BUFFER_BYTES):
        self.fs, self.root = _open(uri)
        self.fs.create_dir(self.root, recursive=True)
        self.page_bytes, self.buffer_bytes = page_bytes, buffer_bytes
        self.depth, self.directory = 0, [0]
        self.depth_of, self.size, self.files, self.waiting = [0], [0], [[]], [{}]
        self.single: dict[int, int] = {}  # buckets known to hold one key
        self.buffered = self.flushes = 0

    def insert(self, key: int, keep: int, rows: int, packed: bytes) -> None:
        b = self.directory[key & ((1 << self.depth) - 1)]
        self._wait(b, key, keep, rows, packed)
        if self.single.get(b, key) != key:
            del self.single[b]
        if self.size[b] > self.page_bytes and self.depth_of[b] < 64 and b not in self.single:
            self._split(b)
        if self.buffered > self.buffer_bytes:
            self.flush()

    def _wait(self, b: int, key: int, keep: int, rows: int, packed: bytes) -> None:
        held = self.waiting[b].get((key, packed))
        if held is not None:
            held[0], held[1] = max(held[0], keep), held[1] + rows
            return
        self.waiting[b][key, packed] = [keep, rows]
        n = struct.calcsize(_HEAD) + len(packed)
        self.size[b] += n
        self.buffered += n

    def flush(self) -> None:
        """Append what waits to its buckets' files: one file a flush, its buckets side by side."""
        full = [b for b, entries in enumerate(self.waiting) if entries]
        if full:
            name, at = f"{self.root}/{self.flushes:06d}", 0
            with self.fs.open_output_stream(name) as out:
                for b in full:
                    raw = b"".join(struct.pack(_HEAD, key, keep, rows, len(packed)) + packed
                                   for (key, packed), (keep, rows) in self.waiting[b].items())
                    out.write(raw)
                    self.files[b].append((name, at, len(raw)))
                    self.waiting[b], at = {}, at + len(raw)
            self.flushes += 1
        self.buffered = 0

    def entries(self, b: int) -> list[tuple[int, int, int, bytes]]:
        found = []
        for piece in self.files[b]:
            raw, at = self._read(*piece), 0
            while at < len(raw):
                key, keep, rows, n = struct.unpack_from(_HEAD, raw, at)
                at += struct.calcsize(_HEAD) + n
                found.append((key, keep, rows, raw[at - n:at]))
        return found + [(key, keep, rows, packed) for (key, packed), (keep, rows) in self.waiting[b].items()]

    def _read(self, name: str, at: int, n: int) -> bytes:
        with self.fs.open_input_file(name) as src:
            return src.read_at(n, at)

    def _split(self, b: int) -> None:
        found = self.entries(b)
        if len({e[0] for e in found}) == 1:  # a chain of one key can't be split
            self.single[b] = found[0][0]
            return
        bit = self.depth_of[b]
        if bit == self.depth:  # directory doubling
            self.directory += self.directory
            self.depth += 1
        self.depth_of[b] += 1
        new = len(self.depth_of)
        self.depth_of.append(bit + 1)
        self.size.append(0), self.files.append([]), self.waiting.append({})
        for slot in range(len(self.directory)):
            if self.directory[slot] == b and slot >> bit & 1:
                self.directory[slot] = new
        self.buffered -= sum(struct.calcsize(_HEAD) + len(packed) for _, packed in self.waiting[b])
        self.size[b], self.files[b], self.waiting[b] = 0, [], {}
        for key, keep, rows, packed in found:
            self._wait(new if key >> bit & 1 else b, key, keep, rows, packed)
        for half in (b, new):
            if self.size[half] > self.page_bytes and self.depth_of[half] < 64:
                self._split(half)

    def groups(self) -> Iterator[tuple[int, bytes, int, int]]:
        """(key, text, largest id, rows) of each distinct text, bucket by bucket:
        entries of one key form a chain and are compared by their bytes."""
        unpack = zstandard.ZstdDecompressor()
        for b in range(len(self.depth_of)):
            chains: dict[int, list[list]] = {}
            for key, keep, rows, packed in self.entries(b):
                chain = chains.setdefault(key, [])
                text = None
                for e in chain:
                    if e[0] != packed:
                        text = unpack.decompress(packed) if text is None else text
                        if unpack.decompress(e[0]) != text:
                            continue
                    e[1], e[2] = max(e[1], keep), e[2] + rows
                    break
                else:
                    chain.append([packed, keep, rows])
            for key, chain in chains.items():
                for packed, keep, rows in chain:
                    yield key, unpack.decompress(packed), keep, rows


_NO_ID = -(1 << 63)  # a null id is smaller than any other


def _own(base: str, page_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for b in batches:
            index = index or ExtendibleIndex(f"{base}/{uuid.uuid4().hex}", page_bytes)
            for key, packed, keep, rows in zip(*(b.column(i).to_pylist() for i in range(1, 5)), strict=True):
                index.insert(key & ((1 << 64) - 1), _NO_ID if keep is None else keep, rows, packed)
        if index is None:
            return
        rows = []
        for key, text, keep, n in index.groups():
            rows.append((_signed(key), hashlib.sha256(text).hexdigest(), None if keep == _NO_ID else keep, n))
            if len(rows) == 5000:
                yield batch(_GROUPS, *zip(*rows))
                rows = []
        if rows:
            yield batch(_GROUPS, *zip(*rows))
    return run


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     page_bytes: int = PAGE_BYTES) -> DataFrame:
    """One row per distinct text: text_key, text_sha256, keep_id, group_size."""
    spark = docs.sparkSession
    owners = shuffle_partitions(spark)
    pairs = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    texts = pairs.mapInArrow(_collapse(owners),
                             "owner int, text_key long, packed binary, keep_id long, group_size long")
    return texts.repartitionById(owners, F.col("owner")).mapInArrow(  # a task for each owner
        _own(scratch(spark, "exact"), page_bytes),
        "text_key long, text_sha256 string, keep_id long, group_size long")


def _decisions(docs: DataFrame, id_col: str, text_col: str, page_bytes: int) -> DataFrame:
    text = F.col(text_col).cast("string")
    keys = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text, F.xxhash64(text).alias("raw_key"))
            .mapInArrow(_row_keys, "doc_id long, raw_key long, text_key long, text_sha256 string"))
    return (keys.join(duplicate_groups(docs, id_col, text_col, page_bytes), ["text_key", "text_sha256"])
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 page_bytes: int = PAGE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    return _decisions(docs, id_col, text_col, page_bytes).select("doc_id", "keep_id", "group_size", "kept",
                                                                 "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one per distinct text.

    Decisions are made on narrow rows; the texts themselves move only where the
    list of dropped rows has more than ``broadcast_rows`` entries. Rows that
    repeat id and text are rare: only they are de-duplicated by a shuffle."""
    made = staged(_decisions(docs, id_col, text_col, PAGE_BYTES), "exact-decisions")
    row = ["doc_id", "raw_key"]
    gone = staged(made.where(~F.col("kept")).select(*row).distinct(), "exact-gone")
    twice = staged(made.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1")
                   .select("doc_id").distinct(), "exact-twice")
    text = F.col(text_col).cast("string")

    def joined(df: DataFrame, other: DataFrame, how: str) -> DataFrame:
        other = other.select([F.col(c).alias(f"_dup_{c}") for c in other.columns])
        same = df[id_col].cast("long").eqNullSafe(F.col("_dup_doc_id"))
        if "_dup_raw_key" in other.columns:
            same = same & (F.xxhash64(df[text_col].cast("string")) == F.col("_dup_raw_key"))
        return df.join(F.broadcast(other) if other.count() <= broadcast_rows else other, same, how)

    kept = joined(docs, gone, "left_anti")
    if twice.isEmpty():
        return kept
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    once = (joined(kept, twice, "left_semi").withColumn("_dup_text", F.sha2(lower, 256))
            .dropDuplicates([id_col, "_dup_text"]).drop("_dup_text"))
    return joined(kept, twice, "left_anti").unionByName(once)
