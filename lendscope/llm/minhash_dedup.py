"""MinHash near-dedup (operator 3): DartMinHash.

A text is its multiset of five-word shingles (a shorter text: one shingle of
all its words), and similarity is the weighted Jaccard of two multisets. Darts
are thrown at each element's area (weight x rank), in regions of unit area that
depend on the element alone; darts under the text's weight and rank bound are
hashed to the signature's coordinates, and each coordinate keeps its earliest
dart. Two texts agree on a coordinate with a probability equal to their
similarity. Texts that agree on all rows of some band meet in a bucket.

Texts with the same multiset are collapsed first, so copies cost one row (a
node). In a bucket not all pairs are formed. First every member meets the
bucket's smallest one. Where members of a bucket then still lie in different
components, those outside its first member's component (the strays) are held
against all members of other components: in a small bucket as pairs, in a large
one block against block inside a task, with no row per pair. What is compared
there is a histogram of element hashes, which bounds the overlap from above; only
pairs whose bound allows ``threshold`` leave the task. A first pass emits the
``NEAREST`` best of each stray, which joins most of them, and names the strays that
had more; for these a second emits every pair left over between components, so no
link between components is lost (all pairs of the others came with the first). Every
link is verified on the whole multisets; a node's multiset is sent once for each
block of pairs that it leads.

Result: one row per document with its class, the smallest id it is linked to
over any path. Cases: null counts as empty; a text without words links with
nothing, not even with another one; an id that comes with several texts has a
class for each of them, and where those are in one class, the text whose node comes
first is the one kept; repeated rows get the same class; a null id links with
nothing and gets no class; an empty table gives no rows; other columns are kept
by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lendscope.llm.common import LOOKUP_ROWS, batch, byte_texts, lookup, staged
from lendscope.llm.components import components
from lendscope.llm.words import ALNUM, hash_words, mix, windows

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 28
ROWS = 6
#: Buckets of up to this many members compare as pairs, larger ones block by block
SMALL = 16
#: Members of a block of a large bucket, about
BLOCK = 1024
#: Pairs that a stray gives in the first pass, per block
NEAREST = 8
#: Pairs that one copy of a node's multiset serves
PAIRS_PER_COPY = 512
BROADCAST_ROWS = 1_000_000
#: A histogram's cell that holds this many, or more
FULL = (1 << 16) - 1
_POISSON = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])

_SIGS = pa.schema([("doc_id", pa.int64()), ("raw_key", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()),
                   ("total", pa.int64()), ("bands", pa.list_(pa.int64())), ("cells", pa.binary())])
_SETS = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("elements", pa.binary())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))


def multiset(texts: list[bytes], k: int = SHINGLE) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted shingle hashes, counts) of each text."""
    h, offsets = hash_words(texts, ALNUM)
    g, o = windows(h, offsets, k)
    out = []
    for i in range(len(texts)):
        s = g[o[i]:o[i + 1]]
        if not len(s) and offsets[i + 1] > offsets[i]:
            few = h[offsets[i]:offsets[i + 1]]
            s = windows(few, np.array([0, len(few)]), len(few))[0]
        out.append(np.unique(s, return_counts=True))
    return out


def _darts(doc, elem, weight, theta):
    """Darts (doc, id, rank) under each element's weight and its text's rank bound.

    Region (nu, rho) covers weights [2^nu - 1, 2^(nu+1) - 1) and ranks
    [2^rho - 1, 2^(rho+1) - 1); it is cut into unit areas, each with a Poisson(1)
    number of darts from hashes of (element, region, area, number)."""
    found = []
    for nu in range(int(np.log2(weight.max() + 1)) + 1):
        for rho in range(int(np.log2(theta.max() + 1)) + 1):
            w0, r0 = 2.0 ** nu - 1, 2.0 ** rho - 1
            use = np.flatnonzero((weight > w0) & (theta > r0))
            if not len(use):
                continue
            # 2^rho strips of weight times 2^nu strips of rank, each of area 1
            dw, dr = 2.0 ** (nu - rho), 2.0 ** (rho - nu)
            nw = np.minimum(np.ceil((weight[use] - w0) / dw), 2 ** rho).astype(np.int64)
            nr = np.minimum(np.ceil((theta[use] - r0) / dr), 2 ** nu).astype(np.int64)
            cells = nw * nr
            row = np.repeat(use, cells)
            at = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells)
            per = np.repeat(nr, cells)
            iw, ir = at // per, at % per
            seed = mix(elem[row] + np.uint64(((nu * 64 + rho + 1) * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)))
            seed = mix(seed + (iw.astype(np.uint64) << np.uint64(32)) + ir.astype(np.uint64))
            count = np.searchsorted(_POISSON, _unit(seed))
            row, iw, ir = np.repeat(row, count), np.repeat(iw, count), np.repeat(ir, count)
            j = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            dart = mix(np.repeat(seed, count) + (j.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
            rank = r0 + (ir + _unit(mix(dart ^ np.uint64(0x5851F42D4C957F2D)))) * dr
            ok = rank < theta[row]
            if nu or rho or (weight[use] < 1).any():
                w = w0 + (iw + _unit(mix(dart ^ np.uint64(0x2545F4914F6CDD1D)))) * dw
                ok &= w < weight[row]
            found.append((doc[row[ok]], dart[ok], rank[ok]))
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """DartMinHash signatures, one row of ``k`` dart ids per non-empty multiset."""
    sig = np.zeros((len(sets), k), np.uint64)
    total = np.array([c.sum() for _, c in sets], float)
    t = k * np.log(k) + 2 * k
    open_ = np.flatnonzero(total > 0)
    while len(open_):
        theta = t / total[open_]
        size = np.array([len(sets[i][0]) for i in open_])
        local = np.repeat(np.arange(len(open_)), size)
        doc, dart, rank = _darts(local, np.concatenate([sets[i][0] for i in open_]),
                                 np.concatenate([sets[i][1] for i in open_]).astype(float), theta[local])
        slot = doc * k + (dart % np.uint64(k)).astype(np.int64)
        order = np.lexsort((dart, rank, slot))
        slot, dart = slot[order], dart[order]
        first = np.concatenate([[True], slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, bool)
        full = np.zeros((len(open_), k), np.uint64)
        full.reshape(-1)[slot[first]] = dart[first]
        hits = np.zeros(len(open_) * k, bool)
        hits[slot[first]] = True
        done = hits.reshape(len(open_), k).all(1)
        sig[open_[done]] = full[done]
        open_ = open_[~done]  # a coordinate without a dart: throw further
        t *= 2
    return sig


def _prints(sets: list) -> np.ndarray:
    """128-bit prints of multisets, as two signed longs each."""
    prints = [xxhash.xxh3_128_intdigest(e.tobytes() + c.astype("<i8").tobytes()) for e, c in sets]
    half = (1 << 64) - 1
    return np.array([[p >> 64, p & half] for p in prints], np.uint64).reshape(-1, 2).view(np.int64)


def histogram(elements: np.ndarray, counts: np.ndarray) -> bytes:
    """Counts by the leading bits of the element hashes, two bytes a cell
    (65,535: that many or more), two to four cells an element: mostly empty, so they compress
    well, and the bound on an overlap is tight. More cells fold into fewer."""
    total = int(counts.sum())
    bits = min(14, max(6, total.bit_length() + 1))
    cells = np.bincount((elements >> np.uint64(64 - bits)).astype(np.int64), weights=counts, minlength=1 << bits)
    return np.minimum(cells, FULL).astype("<u2").tobytes()


def _sign(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                sets = multiset(byte_texts(part.column(2)))
                sig = signatures(sets, bands * rows).reshape(len(sets), bands, rows)
                key = np.zeros((len(sets), bands), np.uint64)
                for r in range(rows):
                    key = mix(key * np.uint64(3) + sig[:, :, r] + np.arange(bands, dtype=np.uint64))
                whole = _prints(sets)
                keys = [k.tolist() if len(s[0]) else None for k, s in zip(key.view(np.int64), sets, strict=True)]
                yield batch(_SIGS, part.column(0), part.column(1), whole[:, 0], whole[:, 1],
                            [int(c.sum()) for _, c in sets], keys, [histogram(*s) for s in sets])
    return run


def packed(elements: np.ndarray, counts: np.ndarray) -> bytes:
    """A multiset as bytes; counts only where some element is repeated."""
    once = bool((counts == 1).all())
    head = np.array([len(elements)], "<u8").tobytes()
    return head + elements.astype("<u8").tobytes() + (b"" if once else counts.astype("<u4").tobytes())


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = int(np.frombuffer(raw, "<u8", 1)[0])
    elements = np.frombuffer(raw, "<u8", k, 8)
    return elements, (np.frombuffer(raw, "<u4", k, 8 + 8 * k).astype(np.int64) if len(raw) > 8 + 8 * k
                      else np.ones(k, np.int64))


def _element_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 200):
            sets = multiset(byte_texts(b.slice(at, 200).column(0)))
            whole = _prints(sets)
            yield batch(_SETS, whole[:, 0], whole[:, 1], [packed(*s) for s in sets])


def weighted_jaccard(a: bytes, b: bytes) -> float:
    (x, n), (y, m) = unpacked(a), unpacked(b)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    least = float(np.minimum(n[i], m[j]).sum())
    return least / (float(n.sum()) + float(m.sum()) - least)


def _folded(cells: np.ndarray, size: int) -> np.ndarray:
    """Histograms (last axis) with neighbouring cells added up to ``size`` cells."""
    if cells.shape[-1] == size:
        return cells
    return cells.reshape(*cells.shape[:-1], size, -1).sum(-1, dtype=np.uint32)


class Members:
    """Nodes of a block, by size, with their histograms as matrices."""

    def __init__(self, node: np.ndarray, total: np.ndarray, group: np.ndarray, cells: list[bytes]):
        order = np.argsort(total, kind="stable")
        self.node, self.total, self.group = node[order], total[order], group[order]
        width = np.array([len(cells[i]) // 2 for i in order])
        # ascending sizes have ascending widths: each width is a run of rows
        self.runs = [(int(np.searchsorted(width, w, "left")), int(np.searchsorted(width, w, "right")), int(w))
                     for w in np.unique(width)]
        self.matrix = [np.frombuffer(b"".join(cells[order[i]] for i in range(lo, hi)), "<u2").reshape(-1, w)
                       for lo, hi, w in self.runs]
        self.folds: dict[tuple[int, int], np.ndarray] = {}

    def _matrix(self, k: int, size: int) -> np.ndarray:
        if (k, size) not in self.folds:
            self.folds[k, size] = _folded(self.matrix[k], size)
        return self.folds[k, size]

    def within_reach(self, node: int, total: int, group: int, cells: np.ndarray, threshold: float,
                     most: int | None) -> np.ndarray:
        """Nodes of other groups whose histogram allows the threshold, the best ``most``."""
        found, bounds = [], []
        lo = int(np.searchsorted(self.total, total * threshold - 1e-6, "left"))
        hi = int(np.searchsorted(self.total, total / threshold + 1e-6, "right"))
        for k, (start, end, width) in enumerate(self.runs):
            i, j = max(lo, start), min(hi, end)
            if i >= j:
                continue
            size = min(width, len(cells))
            bound = overlap_bound(self._matrix(k, size)[i - start:j - start], _folded(cells, size))
            least = np.minimum(self.total[i:j], total)
            full = (cells == FULL).any() & (self.matrix[k][i - start:j - start] == FULL).any(1)
            bound = np.where(full, least, np.minimum(bound, least))
            share = bound / (self.total[i:j] + total - bound)
            ok = (share >= threshold - 1e-9) & (self.group[i:j] != group) & (self.node[i:j] != node)
            found.append(self.node[i:j][ok])
            bounds.append(share[ok])
        if not found:
            return np.zeros(0, np.int64)
        found, bounds = np.concatenate(found), np.concatenate(bounds)
        if most is not None and len(found) > most:
            found = found[np.argsort(-bounds, kind="stable")[:most]]
        return found


def overlap_bound(many: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.minimum(many, one).sum(-1, dtype=np.int64)


def _plausible(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x, y, n, m, p, q in zip(*(c.to_pylist() for c in b.columns), strict=True):
                p, q = np.frombuffer(p, "<u2"), np.frombuffer(q, "<u2")
                size, least = min(len(p), len(q)), min(n, m)
                bound = least
                if not ((p == FULL).any() and (q == FULL).any()):
                    bound = min(least, int(overlap_bound(_folded(p, size), _folded(q, size))))
                if bound >= (threshold - 1e-9) * (n + m - bound):
                    rows.append((x, y))
            if rows:
                yield batch(_PAIRS, *zip(*rows))
    return run


def plausible(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sizes and histograms allow the threshold."""
    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("total").alias(f"n{name}"), F.col("cells").alias(f"c{name}"))
    # a few nodes lead very many pairs: these are dealt by ``b`` last, evenly
    sized = (pairs.join(side("a"), "a").join(side("b"), "b")
             .where(F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(threshold - 1e-9)))
    return sized.select("a", "b", "na", "nb", "ca", "cb").mapInArrow(_plausible(threshold), "a long, b long")


def _verify(threshold: float):
    def run(pairs: pa.Table, leads: pa.Table) -> pa.Table:
        rows = []
        if leads.num_rows:
            lead = leads["whole"][0].as_py()
            for x, y, e in zip(*(pairs[c].to_pylist() for c in ("a", "b", "elements")), strict=True):
                if weighted_jaccard(lead, e) >= threshold:
                    rows.append((x, y))
        return pa.Table.from_batches([batch(_PAIRS, *(zip(*rows) if rows else ([], [])))], _PAIRS)
    return run


def verified(pairs: DataFrame, sets: DataFrame, threshold: float, small: bool = False) -> DataFrame:
    """The pairs (a, b) with a similarity of ``threshold`` or more. ``a`` leads: its
    multiset is sent once for each ``PAIRS_PER_COPY`` of its pairs. ``small``: few pairs."""
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_COPY).cast("int").alias("copies"))
    copy = F.pmod(F.xxhash64("b"), F.col("copies")).cast("int")
    follow = (pairs.join(lookup(many, small), "a").withColumn("copy", copy).select("a", "b", "copy")
              .join(sets.select(F.col("node").alias("b"), "elements"), "b"))
    lead = (many.select("a", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
            .join(sets.select(F.col("node").alias("a"), "elements"), "a").toDF("lead", "nth", "whole"))
    return (follow.groupBy("a", "copy").cogroup(lead.groupBy("lead", "nth"))
            .applyInArrow(_verify(threshold), "a long, b long"))


def _against(threshold: float, most: int | None):
    def run(strays: pa.Table, members: pa.Table) -> pa.Table:
        cols = lambda t, r="": (t[f"{r}node"].to_numpy(), t[f"{r}total"].to_numpy(),
                                t[f"{r}component"].to_numpy(), t[f"{r}cells"].to_pylist())
        out_a, out_b = [], []
        if strays.num_rows and members.num_rows:
            block = Members(*cols(members, "r_"))
            for node, total, group, cells in zip(*cols(strays), strict=True):
                other = block.within_reach(node, total, group, np.frombuffer(cells, "<u2"), threshold, most)
                out_a.append(np.minimum(other, node))
                out_b.append(np.maximum(other, node))
                if most is not None and len(other) >= most:  # perhaps not all: a pair with itself says so
                    out_a.append(np.array([node]))
                    out_b.append(np.array([node]))
        a = np.concatenate(out_a) if out_a else np.zeros(0, np.int64)
        b = np.concatenate(out_b) if out_b else np.zeros(0, np.int64)
        return pa.Table.from_batches([batch(_PAIRS, a, b)], _PAIRS)
    return run


def _stray_pairs(members: DataFrame, nodes: DataFrame, comp: DataFrame, threshold: float, few_links: bool,
                 tried: DataFrame, cut: DataFrame | None = None) -> DataFrame | None:
    """Plausible pairs (a, b) of strays with members of other components of their
    bucket, none of them ``tried``, and a pair (a, a) of each stray that may have more;
    None without strays. With ``cut``, the strays named there: all their pairs in large buckets."""
    bucket = ["band", "key"]
    most = NEAREST if cut is None else None
    of = lambda node, name: lookup(comp.select(F.col("node").alias(node), F.col("component").alias(name)), few_links)
    placed = (members.where("n > 2" if cut is None else F.col("n") > SMALL)  # of two, the pair has been compared
              .join(of("node", "component"), "node", "left").join(of("pivot", "main"), "pivot", "left")
              .select(*bucket, "n", "node", F.coalesce("component", "node").alias("component"),
                      F.coalesce("main", "pivot").alias("main")))
    placed = staged(placed, "placed")
    strays = placed.where("component <> main")
    if cut is not None:
        strays = strays.join(lookup(cut, few_links), "node", "left_semi")
    n_strays = strays.count()
    if not n_strays:
        return None
    few, tried = n_strays <= LOOKUP_ROWS, lookup(tried, tried.count() <= LOOKUP_ROWS)
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    open_ = (strays.where(F.col("n") > SMALL).groupBy(*bucket).agg(F.count(F.lit(1)).alias("n_strays"), F.max("n").alias("n_all"))
             .select(*bucket, blocks("n_strays").alias("i_n"), blocks("n_all").alias("j_n")))
    held = (placed.join(lookup(open_, few), bucket).join(nodes.select("node", "total", "cells"), "node"))
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    what = [*bucket, "i", "j", "node", "total", "component", "cells"]
    left = held.where("component <> main")
    if cut is not None:
        left = left.join(lookup(cut, few_links), "node", "left_semi")
    left = left.withColumn("i", part("i_n")).withColumn("j", span("j_n")).select(*what)
    right = held.withColumn("j", part("j_n")).withColumn("i", span("i_n")).select(*what)
    unit = [*bucket, "i", "j"]
    right = right.toDF(*[f"r_{c}" for c in what])
    near = (left.groupBy(*unit).cogroup(right.groupBy(*[f"r_{c}" for c in unit]))
            .applyInArrow(_against(threshold, most), "a long, b long"))
    if cut is not None:
        return near.distinct().join(tried, ["a", "b"], "left_anti")
    one = strays.where(F.col("n") <= SMALL).select(*bucket, F.col("node").alias("a"), "component")
    other = placed.where(F.col("n") <= SMALL).select(*bucket, F.col("node").alias("b"), F.col("component").alias("other"))
    pairs = (other.join(lookup(one, few), bucket).where("component <> other")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return plausible(pairs, nodes, threshold).unionByName(near).distinct().join(tried, ["a", "b"], "left_anti")


def _classes(docs: DataFrame, id_col: str, text_col: str, threshold: float, bands: int, rows: int,
             broadcast_rows: int) -> DataFrame:
    """doc_id, raw_key, class_id, kept of each row."""
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("raw_key"), text.alias("text"))
    signed = staged(texts.mapInArrow(_sign(bands, rows), "doc_id long, raw_key long, hi long, lo long, total long, "
                                                         "bands array<long>, cells binary"), "signatures")
    usable = F.col("bands").isNotNull() & F.col("doc_id").isNotNull()
    # texts with one multiset: one node, named by its place in the written table
    one = signed.where(usable).groupBy("hi", "lo").agg(F.min("doc_id").alias("rep"), F.first("total").alias("total"),
                                                       F.first("bands").alias("bands"), F.first("cells").alias("cells"))
    nodes = staged(one.withColumn("node", F.monotonically_increasing_id()), "nodes")
    bucket = ["band", "key"]
    spread = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = (spread.groupBy(*bucket).agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n"))
              .where("n > 1"))
    members = staged(spread.join(shared, bucket), "buckets")
    sized = nodes.select("node", "total", "cells")

    def links_of(pairs: DataFrame) -> DataFrame:
        """The verified ones of written pairs; their texts are read for it."""
        few = pairs.count() <= LOOKUP_ROWS // 2
        ids = pairs.select(F.explode(F.array("a", "b")).alias("node"))
        wanted = staged(nodes.select("node", "hi", "lo", "rep").join(lookup(ids if few else ids.distinct(), few), "node", "left_semi"),
                        "wanted")
        reps = wanted.select(F.col("rep").alias("doc_id"))
        reps = F.broadcast(reps) if wanted.count() <= broadcast_rows else reps
        sets = (texts.join(reps, "doc_id", "left_semi").select("text").mapInArrow(_element_sets, "hi long, lo long, elements binary")
                .join(lookup(wanted.select("hi", "lo", "node"), few), ["hi", "lo"]).dropDuplicates(["node"]).select("node", "elements"))
        sets = sets if few else staged(sets, "multisets", "none")
        return staged(verified(pairs, sets, threshold, few), "verified")

    pairs = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    tried = staged(plausible(pairs, sized, threshold), "plausible")
    links = links_of(tried)
    comp, few = components(links), links.count() <= LOOKUP_ROWS // 2
    cut = None
    for again in (False, True):
        found = None if again and not cut.count() else _stray_pairs(members, sized, comp, threshold, few, tried, cut)
        if found is None:
            break
        found = staged(found, "plausible")
        cut = found.where("a = b").select(F.col("a").alias("node"))
        found = found.where("a <> b")
        tried = tried.unionByName(found)
        if not found.count():
            continue
        found = links_of(found)
        if found.count():
            links = links.unionByName(found)
            comp, few = components(links), links.count() <= LOOKUP_ROWS // 2
    # a class has the smallest id of its nodes, and the first node with it is the one that stays
    placed = nodes.select("node", "rep").join(lookup(comp, few), "node")
    heads = placed.groupBy("component").agg(F.min(F.struct("rep", "node")).alias("head"))
    head_of = comp.join(lookup(heads, few), "component").select("node", "head")
    class_of = (nodes.select("node", "hi", "lo", "rep").join(lookup(head_of, few), "node", "left")
                .select("hi", "lo", F.coalesce("head.rep", "rep").alias("class"),
                        F.coalesce(F.col("head.node") == F.col("node"), F.lit(True)).alias("first")))
    return (signed.select("doc_id", "raw_key", F.when(usable, F.col("hi")).alias("hi"), "lo")
            .join(class_of, ["hi", "lo"], "left")
            .select("doc_id", "raw_key", F.coalesce("class", "doc_id").alias("class_id"),
                    F.coalesce(F.col("first") & (F.col("doc_id") == F.col("class")), F.lit(True)).alias("_first"),
                    F.col("class").isNull().alias("_alone"))
            .select("doc_id", "raw_key", "class_id", (F.col("_alone") | F.col("_first")).alias("kept")))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                           broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, kept (the text of its class that stays)."""
    return _classes(docs, id_col, text_col, threshold, bands, rows, broadcast_rows).drop("raw_key")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: one text per class."""
    made = _classes(docs, id_col, text_col, THRESHOLD, BANDS, ROWS, BROADCAST_ROWS)
    gone = staged(made.where(~F.col("kept")).select(F.col("doc_id").alias("_gone_id"), F.col("raw_key").alias("_gone_key"))
                  .distinct(), "near-gone")
    other = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return docs.join(other, (docs[id_col].cast("long") == other["_gone_id"])
                     & (F.xxhash64(docs[text_col].cast("string")) == other["_gone_key"]), "left_anti")
