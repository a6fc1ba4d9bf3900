"""Embedding near-dedup (operator 4): HNSW graphs per shard.

Equal vectors are collapsed first (one node, with its number of copies). The
distinct vectors are dealt by id hash to shards; each shard builds a navigable
small-world graph and audits itself: vectors moved off the shard's own ones by
a cosine between the threshold and one must find them again, and the beam is
doubled until ``AUDIT_RECALL`` of them do. Then every vector queries every
shard, in blocks, over the memory-mapped graphs; a beam full of links is widened
until it isn't. Candidates are verified by cosine in double precision, and
components are united over the verified links.

Shards grow with the input up to ``SHARD_ROWS`` vectors; their number is at
least ``MIN_SHARDS``.

Cases: a vector that is null, empty, zero, or holds a null or non-finite
component links with nothing and is its own component; vectors of different lengths never
link; a row repeated exactly counts once; a null id links with nothing; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lendscope.llm import hnsw
from lendscope.llm.common import batch, mapped, put_file, scratch, shuffle_partitions, staged
from lendscope.llm.components import components
from lendscope.llm.words import mix

THRESHOLD = 0.9
MIN_SHARDS = 8
SHARD_ROWS = 200_000
#: Bytes of a shard's vectors in double precision; a task holds a few times as much
SHARD_BYTES = 128 << 20
FIRST_BEAM = 24
AUDITS = 400
AUDIT_RECALL = 0.995
#: Room for 32-bit rounding when candidates are searched
SLACK = 1e-4

#: The beam of a shard whose audit failed
EXACT = -1
_SCAN = 4096

_VECTORS = pa.schema([("vec_id", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("dim", pa.int32()),
                      ("unit", pa.binary())])
_SHARD = pa.schema([("dim", pa.int32()), ("uri", pa.string()), ("rows", pa.int64()), ("ef", pa.int64()),
                    ("audit_recall", pa.float64())])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for i, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            x = None if v.as_py() is None else v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            with np.errstate(all="ignore"):
                top = np.abs(x).max(initial=0.0) if x is not None else 0.0
                ok = i is not None and top > 0 and np.isfinite(x).all()
                unit = x / top if ok else None  # first to a moderate scale, so no square overflows
            if not ok:
                rows.append((i, None, None, None, None))
                continue
            unit = unit / np.sqrt(unit @ unit)
            p = xxhash.xxh3_128_intdigest(x.tobytes())
            hi, lo = np.array([p >> 64, p & ((1 << 64) - 1)], np.uint64).view(np.int64).tolist()
            rows.append((i, hi, lo, len(unit), unit.tobytes()))
        if rows:
            yield batch(_VECTORS, *zip(*rows))


def _audit(graph: hnsw.Graph, threshold: float) -> tuple[int, float]:
    """The beam width at which moved copies of sampled nodes find their node, and that recall."""
    n, d = graph.x.shape
    ef, rng = min(FIRST_BEAM, n), np.random.default_rng(n)
    at = np.unique(np.linspace(0, n - 1, min(n, AUDITS)).astype(int))
    cos = rng.uniform(threshold, 1.0, len(at))[:, None]
    noise = rng.standard_normal((len(at), d))
    noise -= (noise * graph.x[at]).sum(1, keepdims=True) * graph.x[at]
    size = np.linalg.norm(noise, axis=1, keepdims=True)
    q = cos * graph.x[at] + np.sqrt(1 - cos ** 2) * np.divide(noise, size, out=np.zeros_like(noise), where=size > 0)
    q = (q / np.linalg.norm(q, axis=1, keepdims=True)).astype(np.float32)
    while True:
        found = graph.within(q, threshold - SLACK, ef)
        recall = float(np.mean([a in f for a, f in zip(at, found, strict=True)]))
        if recall >= AUDIT_RECALL or ef >= n:
            return ef, recall
        ef = min(n, ef * 2)


def _build(base: str, threshold: float):
    def run(key, table):
        dim, shard = key[0].as_py(), key[1].as_py()
        ids = table.column("rep").to_numpy()
        x = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(len(ids), dim)
        by_id = np.argsort(ids)
        ids, x = ids[by_id], x[by_id]
        graph, order = hnsw.build(x, mix(ids.astype(np.uint64)))
        ef, recall = _audit(graph, threshold)
        if recall < AUDIT_RECALL:  # not even at full width: this shard is scanned exactly
            ef = EXACT
        arrays = [ids[order], x[order], graph.x, *graph.layers]
        parts = []
        for a in arrays:
            buf = io.BytesIO()
            np.save(buf, np.ascontiguousarray(a))
            parts.append(buf.getvalue())
        sizes = np.array([len(arrays), *map(len, parts)], np.int64)
        uri = f"{base}/dim={dim}/shard={shard}"
        put_file(uri, [sizes, *parts])
        return pa.Table.from_batches([batch(_SHARD, [dim], [uri], [len(ids)], [ef], [recall])])
    return run


def _load(uri: str) -> tuple[np.ndarray, np.ndarray, hnsw.Graph]:
    raw = mapped(uri)
    n = int(raw[:8].view(np.int64)[0])
    sizes = raw[8:8 + 8 * n].view(np.int64)
    arrays, at = [], 8 + 8 * n
    for s in sizes:
        head = io.BytesIO(raw[at:at + min(int(s), 4096)].tobytes())
        version = np.lib.format.read_magic(head)
        shape, _, dtype = np.lib.format.read_array_header_1_0(head) if version == (1, 0) else \
            np.lib.format.read_array_header_2_0(head)
        body = raw[at + head.tell():at + int(s)]
        arrays.append(np.frombuffer(body, dtype).reshape(shape))
        at += int(s)
    ids, exact, x, *layers = arrays
    return ids, exact, hnsw.Graph(x, layers, [len(a) for a in layers])


def _scan(exact: np.ndarray, block: np.ndarray, threshold: float) -> list[np.ndarray]:
    """For each vector of ``block`` the rows of ``exact`` within the threshold, by brute force."""
    found = [[] for _ in block]
    for at in range(0, len(exact), _SCAN):
        row, hit = np.nonzero(block @ exact[at:at + _SCAN].T >= threshold - SLACK)
        cuts = np.searchsorted(row, np.arange(len(block) + 1))
        for i in range(len(block)):
            found[i].append(hit[cuts[i]:cuts[i + 1]] + at)
    return [np.concatenate(f) if f else np.zeros(0, np.int64) for f in found]


def _query(shards: list[tuple[int, str, int]], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rep, dims = b.column(0).to_numpy(), b.column(1).to_numpy()
            units = b.column(2).to_pylist()
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                q = np.frombuffer(b"".join(units[i] for i in mine), np.float64).reshape(len(mine), dim)
                for d, uri, ef in shards:
                    if d != dim:
                        continue
                    ids, exact, graph = _load(uri)
                    for at in range(0, len(mine), 2 * hnsw.BATCH):
                        block = q[at:at + 2 * hnsw.BATCH]
                        found = (_scan(exact, block, threshold) if ef == EXACT else
                                 graph.within(block.astype(np.float32), threshold - SLACK, ef))
                        row = np.repeat(np.arange(len(block)), [len(f) for f in found])
                        hit = np.concatenate(found)
                        cos = np.einsum("ij,ij->i", block[row], exact[hit])
                        a, o = rep[mine[at + row]], ids[hit]
                        ok = (cos >= threshold) & (a != o)
                        if ok.any():
                            yield batch(_LINKS, a[ok], o[ok])
    return run


def embedding_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         threshold: float = THRESHOLD, min_shards: int = MIN_SHARDS,
                         shard_rows: int = SHARD_ROWS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    units = staged(vectors.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>"))
                   .mapInArrow(_units, "vec_id long, hi long, lo long, dim int, unit binary"), "units")
    print_of = ["hi", "lo"]
    # equal vectors are one node, named by its place in the written table
    nodes = staged(units.where(F.col("hi").isNotNull()).groupBy(*print_of)
                   .agg(F.min("vec_id").alias("least"), F.count_distinct("vec_id").alias("n"), F.first("dim").alias("dim"),
                        F.first("unit").alias("unit")).withColumn("rep", F.monotonically_increasing_id()), "nodes")
    size = nodes.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.length("unit")), F.lit(0)).alias("bytes")).first()
    n_shards = max(min_shards, -(-size["rows"] // shard_rows), -(-size["bytes"] // shard_bytes))
    distinct = staged(nodes.select("rep", "dim", "unit").repartition(max(n_shards, shuffle_partitions(spark)), "rep"),
                      "vectors")
    shard = F.pmod(F.xxhash64("rep"), F.lit(n_shards)).cast("int")
    built = (distinct.withColumn("shard", shard).groupBy("dim", "shard")
             .applyInArrow(_build(scratch(spark, "graphs"), threshold),
                           "dim int, uri string, rows long, ef long, audit_recall double").collect())
    graphs = [(r["dim"], r["uri"], r["ef"]) for r in built]  # a row a shard
    links = staged(distinct.repartition(2 * shuffle_partitions(spark), "rep").select("rep", "dim", "unit")
                   .mapInArrow(_query(graphs, threshold), "a long, b long"), "embedding-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    size = nodes.select(F.col("rep").alias("b"), F.col("n").alias("m"))
    degree = both.join(size, "b").groupBy("a").agg(F.sum("m").alias("others"))
    comp = components(links)
    placed = (nodes.select(*print_of, "rep", "least", "n").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    heads = placed.groupBy("component").agg(F.min("least").alias("head"))
    of_node = (placed.join(degree.withColumnRenamed("a", "rep"), "rep", "left").join(heads, "component")
               .select(*print_of, (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
                       F.col("head").alias("component")))
    return (units.select("vec_id", *print_of).join(of_node, print_of, "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
