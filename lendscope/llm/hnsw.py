"""Hierarchical navigable small-world graph over unit vectors, in numpy.

Nodes are numbered by falling level, so layer l holds the nodes ``0..n_l - 1``
and node 0 is the entry point. Nodes are inserted in batches: a batch searches
the graph built so far, compares its own members, picks diverse neighbours and
links back. Searches run over many queries at once, one beam a query.
"""

from __future__ import annotations

import numpy as np

M = 12
BATCH = 256
EXPAND = 3


def _diverse(sims: np.ndarray, ids: np.ndarray, x: np.ndarray, m: int) -> np.ndarray:
    """Up to ``m`` of ``ids`` (by falling ``sims``), each nearer to the node than
    to those already chosen; places left are filled with the nearest others.
    Rows of ``ids`` padded with -1."""
    rows, width = ids.shape
    v = x[np.maximum(ids, 0)]
    between = np.einsum("rid,rjd->rij", v, v)
    chosen = np.zeros((rows, width), bool)
    count = np.zeros(rows, np.int64)
    for j in range(width):
        near = (np.where(chosen, between[:, j, :], -2.0)).max(1)
        ok = (ids[:, j] >= 0) & (count < m) & (near < sims[:, j])
        chosen[:, j] = ok
        count += ok
    rank = np.where(ids < 0, 2 * width + 1, np.where(chosen, 0, width) + np.arange(width))
    order = np.argsort(rank, axis=1, kind="stable")[:, :m]
    out = np.take_along_axis(ids, order, 1)
    return np.pad(out, ((0, 0), (0, max(0, m - width))), constant_values=-1)


class Graph:
    def __init__(self, x: np.ndarray, layers: list[np.ndarray], sizes: list[int]):
        self.x, self.layers, self.sizes = x, layers, sizes

    def beam(self, q: np.ndarray, entry: np.ndarray, layer: int, ef: int, n: int):
        """The ``ef`` nearest nodes found on a layer: (ids, sims), by falling similarity."""
        links, b = self.layers[layer], len(q)
        ids = np.full((b, ef), -1, np.int64)
        sims = np.full((b, ef), -2.0, np.float32)
        k = min(ef, entry.shape[1])
        ids[:, :k] = entry[:, :k]
        sims[:, :k] = np.where(ids[:, :k] >= 0, np.einsum("bkd,bd->bk", self.x[np.maximum(ids[:, :k], 0)], q), -2.0)
        done = ids < 0
        seen = np.zeros((b, n + 1), bool)  # the last column is a place for -1
        np.put_along_axis(seen, ids[:, :k], True, 1)
        live = np.arange(b)
        while len(live):
            waiting = np.where(done[live], -3.0, sims[live])
            e = min(EXPAND, ef)
            at = np.argpartition(-waiting, e - 1, axis=1)[:, :e] if e < ef else np.tile(np.arange(ef), (len(live), 1))
            use = np.take_along_axis(waiting, at, 1) > -3.0
            more = use.any(1)
            live, at, use = live[more], at[more], use[more]
            if not len(live):
                break
            cur = np.where(use, np.take_along_axis(ids[live], at, 1), -1)
            flags = done[live]
            np.put_along_axis(flags, at, True, 1)
            nb = np.where(cur[:, :, None] >= 0, links[np.maximum(cur, 0)], -1).reshape(len(live), -1)
            nb = np.where(nb < n, nb, -1)
            nb = np.where(seen[live[:, None], nb], -1, nb)
            nb = np.sort(nb, axis=1)
            nb[:, 1:][nb[:, 1:] == nb[:, :-1]] = -1
            seen[live[:, None], nb] = True
            near = np.einsum("bkd,bd->bk", self.x[np.maximum(nb, 0)], q[live])
            near = np.where(nb >= 0, near, -2.0).astype(np.float32)
            all_ids = np.concatenate([ids[live], nb], 1)
            all_sims = np.concatenate([sims[live], near], 1)
            all_done = np.concatenate([flags, nb < 0], 1)
            top = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef]
            ids[live] = np.take_along_axis(all_ids, top, 1)
            sims[live] = np.take_along_axis(all_sims, top, 1)
            done[live] = np.take_along_axis(all_done, top, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def descend(self, q: np.ndarray, to: int, n: int) -> np.ndarray:
        entry = np.zeros((len(q), 1), np.int64)
        for layer in range(len(self.layers) - 1, to, -1):
            entry = self.beam(q, entry, layer, 4, min(n, self.sizes[layer]))[0]
        return entry

    def search(self, q: np.ndarray, ef: int):
        n = len(self.x)
        return self.beam(q, self.descend(q, 0, n), 0, min(ef, n), n)

    def within(self, q: np.ndarray, least: float, ef: int) -> list[np.ndarray]:
        """Per query the nodes found with a similarity of ``least`` or more. A beam
        that is full of such nodes is widened, up to the whole shard."""
        n, out = len(self.x), [np.zeros(0, np.int64)] * len(q)
        todo, ef = np.arange(len(q)), min(ef, n)
        while len(todo):
            left = []
            for at in range(0, len(todo), BATCH):
                rows = todo[at:at + BATCH]
                ids, sims = self.search(q[rows], ef)
                good = (sims >= least) & (ids >= 0)
                full = good.all(1) & (ef < n)
                for r, i, g, f in zip(rows, ids, good, full, strict=True):
                    out[r] = i[g]
                left.append(rows[full])
            todo, ef = np.concatenate(left), min(n, ef * 4)
        return out


def build(x: np.ndarray, seed_hash: np.ndarray, ef: int = 48, m: int = M) -> tuple[Graph, np.ndarray]:
    """The graph of unit vectors ``x`` and the order of its nodes (node i is row
    ``order[i]``). ``seed_hash`` (64-bit hashes of the rows' ids) draws the levels."""
    u = ((seed_hash >> np.uint64(11)).astype(float) + 1) / (1 << 53)
    level = np.minimum((-np.log(u) / np.log(m)).astype(int), 12)
    order = np.lexsort((seed_hash, -level))
    x, level = np.ascontiguousarray(x[order], np.float32), level[order]
    n = len(x)
    sizes = [int((level >= k).sum()) for k in range(int(level.max(initial=0)) + 1)]
    g = Graph(x, [np.full((s, 2 * m if k == 0 else m), -1, np.int32) for k, s in enumerate(sizes)], sizes)
    at = 1
    while at < n:
        end = min(n, at + min(BATCH, at))
        q = x[at:end]
        own = q @ q.T
        np.fill_diagonal(own, -2.0)
        entry = np.zeros((end - at, 1), np.int64)
        for layer in range(len(sizes) - 1, -1, -1):
            upto = min(at, sizes[layer])  # nodes of this layer that are in the graph
            here = max(0, min(end, sizes[layer]) - at)  # batch members of this layer
            found, sims = g.beam(q, entry, layer, ef if here else 4, upto)
            entry = found
            if not here:
                continue
            links, width = g.layers[layer], g.layers[layer].shape[1]
            k = min(width, here)
            mates = np.argsort(-own[:here, :here], axis=1)[:, :k]
            mate_sims = np.take_along_axis(own[:here, :here], mates, 1)
            ids = np.concatenate([found[:here], np.where(mate_sims > -2.0, mates + at, -1)], 1)
            s = np.concatenate([sims[:here], mate_sims], 1)
            best = np.argsort(-s, axis=1, kind="stable")[:, :2 * width]
            picked = _diverse(np.take_along_axis(s, best, 1), np.take_along_axis(ids, best, 1), x, m)
            links[at:at + here, :m] = picked
            _link_back(x, links, np.repeat(np.arange(at, at + here), m), picked.reshape(-1))
        at = end
    return g, order


def _link_back(x: np.ndarray, links: np.ndarray, new: np.ndarray, old: np.ndarray) -> None:
    """Link ``old`` nodes back to ``new`` ones; a full node keeps a diverse choice."""
    ok = old >= 0
    new, old = new[ok], old[ok]
    order = np.lexsort((new, old))
    new, old = new[order], old[order]
    nodes, begin, count = np.unique(old, return_index=True, return_counts=True)
    width, most = links.shape[1], int(count.max(initial=0))
    for at in range(0, len(nodes), 2048):
        some, c, b = nodes[at:at + 2048], count[at:at + 2048], begin[at:at + 2048]
        col = np.arange(most)
        extra = np.where(col < c[:, None], new[np.minimum(b[:, None] + col, len(new) - 1)], -1)
        ids = np.concatenate([links[some].astype(np.int64), extra], 1)
        ids = -np.sort(-ids, axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        sims = np.where(ids >= 0, np.einsum("rkd,rd->rk", x[np.maximum(ids, 0)], x[some]), -2.0)
        best = np.argsort(-sims, axis=1, kind="stable")[:, :width + 16]
        ids, sims = np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)
        links[some] = _diverse(sims, ids, x, width)
