"""Benchmark decontamination (operator 13): broadcast hash set.

A benchmark item's words are cut into windows of ``gram`` consecutive words (an
item of fewer words is one window). The distinct windows with the items that
hold them, sorted by hash, are broadcast, where their count and bytes are within
``broadcast_windows`` and ``broadcast_bytes``; a larger set is range-sorted into
files in the shared folder that the workers memory-map. Documents are scanned in
one pass without a shuffle: rolling window hashes of every length that occurs
meet a bit table first, then the sorted hashes, and every hit is verified on the
words themselves, so a hash collision counts for nothing. Words inside a
verified window are hit.

``contamination`` reports per document, ``decontaminate`` removes the hit spans
or the documents that have one, and keeps all other columns as they are.

Cases: a null or wordless text has no words and no hits, a null or wordless item
no windows; an item without an id still marks words but is no item of the list;
items that repeat count once by id; rows that repeat are scanned each; an empty
benchmark hits nothing, an empty table gives no rows. Texts are read whole, a
long one in blocks; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendscope.llm.common import batch, byte_texts, mapped, put_file, scratch, staged
from lendscope.llm.words import ALNUM, LOWER, hash_words, mix

GRAM = 10
#: Bounds of the broadcast form: distinct (window, item) pairs and their bytes.
BROADCAST_WINDOWS = 1_000_000
BROADCAST_BYTES = 128 << 20
#: Bytes of one file of the mapped form, before the hashes.
FILE_BYTES = 64 << 20
#: Texts of a batch are hashed in groups of about this many bytes.
CHUNK = 4 << 20
_BITS = 22

_WINDOWS = pa.schema([("hash", pa.int64()), ("n", pa.int32()), ("words", pa.binary()), ("item", pa.string())])
_SET = pa.schema([("hash", pa.int64()), ("words", pa.large_binary()), ("item", pa.large_string())])
_INDEX = pa.schema([("uri", pa.string()), ("first", pa.int64()), ("last", pa.int64())])
_REPORT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                     ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.list_(pa.int64())))])


def word_bounds(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word of a lowered text."""
    inside = np.zeros(len(low) + 2, np.int8)
    inside[1:-1] = ALNUM[low]
    edges = np.flatnonzero(np.diff(inside))
    return edges[0::2], edges[1::2]


def _rolling(h: np.ndarray, room: np.ndarray, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, hashes of the n words from each word on, whether n words are left there) for n = 1 .. gram."""
    acc = np.zeros(len(h), np.uint64)
    for n in range(1, min(gram, len(h)) + 1):
        acc = mix(acc[: len(h) - n + 1] * np.uint64(3) + h[n - 1:])
        yield n, acc, room[: len(acc)] >= n


def _item_windows(gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), byte_texts(b.column(1)), strict=True):
                low = LOWER[np.frombuffer(text, np.uint8)]
                raw = low.tobytes()
                words = [raw[s:e] for s, e in zip(*(x.tolist() for x in word_bounds(low)), strict=True)]
                n = min(gram, len(words))
                if n == 0:
                    continue
                h = hash_words([raw], ALNUM)[0]
                acc = list(_rolling(h, np.arange(len(h), 0, -1), n))[-1][1].view(np.int64)
                for at in range(0, len(acc), 20_000):
                    part = acc[at:at + 20_000]
                    yield batch(_WINDOWS, part, np.full(len(part), n, np.int32),
                                [b" ".join(words[i:i + n]) for i in range(at, at + len(part))], [item] * len(part))
    return run


class WindowSet:
    """Windows sorted by hash: in memory, or files that are mapped when met.
    Built in the task, from the plain values that were broadcast."""

    def __init__(self, lengths: list[int], table: pa.Table | None = None, files: list[tuple[str, int, int]] = ()):
        self.lengths, self.table, self.files = frozenset(lengths), table, list(files)
        self.bits, self.shards, self.windows = None, {}, lru_cache(1 << 14)(self._windows)
        if table is not None:
            self.bits = np.zeros(1 << _BITS, bool)
            self.bits[table["hash"].to_numpy().view(np.uint64) >> np.uint64(64 - _BITS)] = True

    def _shard(self, k: int) -> tuple:
        """(hashes, words, items) of file ``k``, or of the whole set."""
        if k not in self.shards:
            t = self.table
            if t is None:
                t = pa.ipc.open_file(pa.py_buffer(mapped(self.files[k][0]))).read_all()
            self.shards[k] = (t["hash"].to_numpy(), t["words"], t["item"])
        return self.shards[k]

    def maybe(self, hashes: np.ndarray, ok: np.ndarray) -> np.ndarray:
        """Places whose hash is in the set."""
        if self.table is not None:
            at = np.flatnonzero(self.bits[hashes >> np.uint64(64 - _BITS)] & ok)
            known = self._shard(0)[0]
            if not len(known):
                return at[:0]
            h = hashes[at].view(np.int64)
            return at[known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h]
        at = np.flatnonzero(ok)
        at = at[np.argsort(hashes[at].view(np.int64), kind="stable")]
        h, found = hashes[at].view(np.int64), []
        for k, (_, first, last) in enumerate(self.files):
            lo, hi = np.searchsorted(h, first, "left"), np.searchsorted(h, last, "right")
            if hi > lo:
                known = self._shard(k)[0]
                here = h[lo:hi]
                found.append(at[lo:hi][known[np.minimum(np.searchsorted(known, here), len(known) - 1)] == here])
        return np.unique(np.concatenate(found)) if found else at[:0]

    def _windows(self, h: int) -> dict[bytes, frozenset]:
        """The windows of hash ``h`` and their items."""
        found: dict[bytes, set] = {}
        ends = [f[2] for f in self.files]
        k = 0 if self.table is not None else bisect.bisect_left(ends, h)
        while k < max(len(self.files), 1) and (self.table is not None or self.files[k][1] <= h):
            known, words, items = self._shard(k)
            for i in range(int(np.searchsorted(known, h, "left")), int(np.searchsorted(known, h, "right"))):
                found.setdefault(words[i].as_py(), set()).add(items[i].as_py())
            k += 1
        return {w: frozenset(i - {None}) for w, i in found.items()}


def _verified(text: bytes, hits: list[tuple[int, int, int]], known: WindowSet) -> tuple[list, set, list]:
    """Spans of hit words, the items they come from, and the spans' bytes."""
    low = LOWER[np.frombuffer(text, np.uint8)]
    raw = low.tobytes()
    starts, ends = word_bounds(low)
    items, spans = set(), []
    for at, n, h in sorted(hits):
        windows = known.windows(h)
        here = b" ".join(raw[s:e] for s, e in zip(starts[at:at + n].tolist(), ends[at:at + n].tolist(), strict=True))
        if here not in windows:
            continue
        items |= windows[here]
        if spans and at <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], at + n)
        else:
            spans.append([at, at + n])
    return spans, items, [(int(starts[a]), int(ends[b - 1])) for a, b in spans]


def _chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > CHUNK:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def scan(texts: list[bytes], known: WindowSet) -> Iterator[tuple[int, list, set, list]]:
    """Per text: words, hit spans in words, items, the spans in bytes."""
    gram = max(known.lengths, default=0)
    for group in _chunks(texts):
        h, offsets = hash_words(group, ALNUM)
        sizes = np.diff(offsets)
        room = np.repeat(offsets[1:], sizes) - np.arange(len(h))
        hits: dict[int, list] = {}
        for n, acc, ok in _rolling(h, room, gram):
            if n in known.lengths:
                at = known.maybe(acc, ok)
                owner = np.searchsorted(offsets, at, "right") - 1
                for i, p, x in zip(owner.tolist(), (at - offsets[owner]).tolist(), acc[at].view(np.int64).tolist(),
                                   strict=True):
                    hits.setdefault(i, []).append((p, n, x))
        for i, (text, n) in enumerate(zip(group, sizes.tolist(), strict=True)):
            yield (n, *(_verified(text, hits[i], known) if i in hits else ([], set(), [])))


def _report(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WindowSet(*shared.value)
        for b in batches:
            found = list(scan(byte_texts(b.column(1)), known))
            yield batch(_REPORT, b.column(0), [f[0] for f in found], [sum(e - s for s, e in f[1]) for f in found],
                        [sorted(f[2]) for f in found], [f[1] for f in found])
    return run


def _remove(shared, text_col: int, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WindowSet(*shared.value)
        for b in batches:
            col = b.column(text_col)
            found = list(scan(byte_texts(col), known))
            if not spans:
                yield b.filter(pa.array([not f[1] for f in found], pa.bool_()))
                continue
            if any(f[1] for f in found):
                texts = col.cast(pa.binary()).to_pylist()
                for i, f in enumerate(found):
                    for s, e in reversed(f[3]):
                        texts[i] = texts[i][:s] + texts[i][e:]
                col = pa.array(texts, pa.binary()).cast(col.type)
                b = pa.RecordBatch.from_arrays([col if j == text_col else c for j, c in enumerate(b.columns)],
                                               schema=b.schema)
            yield b
    return run


def _store(base: str):
    """One sorted file per task, and its place in the index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        rows = pa.Table.from_batches([b.select(_SET.names).cast(_SET) for b in batches], _SET)
        if rows.num_rows:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_file(sink, _SET) as out:
                out.write_table(rows.combine_chunks())
            uri = f"{base}/{TaskContext.get().partitionId():06d}.arrow"
            put_file(uri, [sink.getvalue()])
            yield batch(_INDEX, [uri], rows["hash"][:1].to_pylist(), rows["hash"][-1:].to_pylist())
    return run


def window_set(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", gram: int = GRAM,
               broadcast_windows: int = BROADCAST_WINDOWS, broadcast_bytes: int = BROADCAST_BYTES,
               file_bytes: int = FILE_BYTES):
    """Broadcast arguments of a ``WindowSet``: the benchmark's windows themselves
    within the bounds, else the index of the mapped files (one row per file)."""
    spark = benchmark.sparkSession
    pairs = staged(benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
                   .mapInArrow(_item_windows(gram), "hash long, n int, words binary, item string").distinct(),
                   "bench-windows")
    size = pairs.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("words") + F.coalesce(F.length("item"), F.lit(0)))
                     .alias("bytes"), F.collect_set("n").alias("lengths")).first()
    if size.rows <= broadcast_windows and (size.bytes or 0) <= broadcast_bytes:
        table = pairs.select(_SET.names).toArrow().cast(_SET).sort_by("hash").combine_chunks()
        return spark.sparkContext.broadcast((size.lengths, table, []))
    order = ["hash", "words", "item"]
    files = (pairs.repartitionByRange(int(size.bytes // file_bytes) + 1, *order).sortWithinPartitions(*order)
             .mapInArrow(_store(scratch(spark, "bench-set")), "uri string, first long, last long").collect())
    return spark.sparkContext.broadcast((size.lengths, None, sorted(map(tuple, files), key=lambda f: f[1:])))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  gram: int = GRAM, **bounds) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted ids of the
    benchmark items met) and spans ([first word, end] of each hit run)."""
    known = window_set(benchmark, gram=gram, **bounds)
    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(_report(known), "doc_id long, n_words long, n_hit long, items array<string>, "
                                        "spans array<array<long>>"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", text_col: str = "text",
                  gram: int = GRAM, **bounds) -> DataFrame:
    """``docs`` without what the benchmark holds, all columns kept: ``spans`` cuts
    each run of hit words (from its first to its last byte) out of the text,
    ``documents`` drops every document with a hit."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove: 'spans' or 'documents', not {remove!r}")
    plain = [f"_c{i}" for i in range(len(docs.columns))]  # clashing names don't matter inside
    known = window_set(benchmark, gram=gram, **bounds)
    out = docs.toDF(*plain)
    return out.mapInArrow(_remove(known, docs.columns.index(text_col), remove == "spans"), out.schema).toDF(*docs.columns)


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The report with the list of items as a digest."""
    found = contamination(docs, benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
