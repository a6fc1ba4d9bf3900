"""Merkle dataset manifest (operator 12): cogrouped subtree exchange.

Each row is a leaf: a digest of its fields, made by built-in functions, so a text
is read once and never shuffled. The leaves of a group (language) are numbered
in order over range partitions, and ``FAN ** LEVELS`` consecutive ones are a
superblock. First every superblock is reduced to one node, and the few nodes are
joined upwards level by level to the group's subroot, and the subroots to the
root; each level keeps its runs of up to ``FAN`` children. Then the exchange: the
outer nodes that a superblock needs (the runs on its way up) are cogrouped with
its leaves, and one function finishes the reduction inside, joins the proofs and
folds the leaf that each row claims to have up to the root. No task holds more
than one superblock and its path, whatever the share of one group.

H is sha256 in lowercase hex over its inputs joined; a field is ``-`` if null,
else its bytes in UTF-8, ``:`` and the value. A run of fewer than ``FAN`` nodes,
even of one, becomes its H while more than one node remains; a lone leaf is its
group's subroot, and a lone subroot the root.

Cases: a null group comes first and is a group of its own; a null id comes first
in its group; rows of one id are ordered by their leaves, repeated rows are leaves
of their own (equal ones are interchangeable); null and empty texts differ; a
null text can't be tampered with, nor a row without an id; an empty table gives no rows. Other columns, whatever their
names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendscope.llm.common import staged

FAN = 8
#: A superblock has FAN ** LEVELS leaves.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(fields: Sequence[Column]) -> Column:
    parts = []
    for f in fields:
        value = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _numbered(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``idx``, the place in its key by ``order``, and ``n``, the
    key's rows. Range partitions are sorted and written with the place inside;
    a key's earlier partitions give its offset, so no key meets in one task.
    Equal rows may be dealt over several partitions by their row number."""
    placed = staged(rows.withColumn("_row", F.monotonically_increasing_id())
                    .repartitionByRange(key, *order, "_row").sortWithinPartitions(key, *order).drop("_row")
                    .withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()),
                    "merkle-order")
    counts = placed.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(key)
    # one row for each partition that a key reaches
    offsets = counts.select(key, "_part", "_first", F.sum("_n").over(whole).alias("n"),
                            (F.sum("_n").over(whole.orderBy("_part")) - F.col("_n")).alias("_before"))
    return (placed.join(offsets, [key, "_part"])
            .withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_part", "_at", "_first", "_before"))


def _fold_up(level: list[bytes], steps: int | None, fan: int) -> tuple[list[list[bytes]], list[bytes]]:
    """Runs (joined digests) of each level and the last level's nodes; without
    ``steps`` as long as more than one node remains."""
    runs = []
    while len(level) > 1 if steps is None else len(runs) < steps:
        runs.append([b"".join(level[i:i + fan]) for i in range(0, len(level), fan)])
        level = [hashlib.sha256(r).hexdigest().encode() for r in runs[-1]]
    return runs, level


def _reduce(fan: int, levels: int):
    def run(leaves: pd.DataFrame) -> pd.DataFrame:
        first = leaves.iloc[0]
        digests = [d.encode() for d in leaves.sort_values("idx")["leaf"]]
        _, top = _fold_up(digests, levels if first["n"] > fan ** levels else None, fan)
        return pd.DataFrame({"key": [first["key"]], "idx": [first["block"]], "digest": [top[0].decode()],
                             "n": [-(-first["n"] // fan ** levels)]})
    return run


def _ascend(nodes: DataFrame, fan: int) -> tuple[DataFrame, DataFrame]:
    """Reduce (key, idx, digest, n) to one node a key. Returns the tops (key,
    digest) and each first node's way up (key, idx, path of (run, pos)).
    One round a level; a level has at most an eighth of the nodes below."""
    now = staged(nodes, "merkle-nodes")
    ways = now.select("key", "idx", F.col("idx").alias("_at"),
                      F.expr("cast(array() as array<struct<run: string, pos: int>>)").alias("path"))
    while not now.where("n > 1").isEmpty():
        runs = staged(now.where("n > 1").groupBy("key", F.expr(f"idx div {fan}").alias("up"))
                      .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))),
                                                    lambda x: x["digest"]), "").alias("run"), F.first("n").alias("n")),
                      "merkle-runs")
        ways = (ways.withColumn("up", F.expr(f"_at div {fan}")).join(runs.drop("n"), ["key", "up"], "left")
                .withColumn("path", F.when(F.col("run").isNull(), F.col("path")).otherwise(
                    F.concat("path", F.array(F.struct("run", F.expr(f"cast(_at % {fan} as int)").alias("pos"))))))
                .withColumn("_at", F.col("up")).drop("up", "run"))
        ways = staged(ways, "merkle-ways")
        now = staged(now.where("n <= 1").unionByName(
            runs.select("key", F.col("up").alias("idx"), F.sha2("run", 256).alias("digest"),
                        F.expr(f"(n + {fan - 1}) div {fan}").alias("n"))), "merkle-nodes")
    return now.select("key", "digest"), ways.drop("_at")


def _exchange(fan: int, levels: int, with_proofs: bool):
    def run(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves, o = leaves.sort_values("idx"), outer.iloc[0]
        whole = [d.encode() for d in leaves["leaf"]]
        inside, _ = _fold_up(whole, levels if leaves["n"].iloc[0] > fan ** levels else None, fan)
        above = [(r["run"].encode(), r["pos"]) for r in [*o["path"], *o["root_path"]]]
        digest, folded, proofs = [], [], []
        for i, claimed in enumerate(leaves["claimed"]):
            now, at, path = claimed.encode() if claimed else whole[i], i, []
            for runs in inside:
                path.append((runs[at // fan], at % fan))
                at //= fan
            sides = hashlib.sha256()
            for run_, pos in path + above:
                left, right = run_[:64 * pos], run_[64 * pos + 64:]
                sides.update(left)
                sides.update(right)
                now = hashlib.sha256(left + now + right).hexdigest().encode()
                if with_proofs:
                    proofs += [(left + right).decode()]
            digest.append(sides.hexdigest())
            folded.append(now.decode())
        out = pd.DataFrame({"id": leaves["id"].array, "leaf": leaves["leaf"].array, "subroot": o["subroot"],
                            "proof_sha256": digest, "folded_root": folded})
        if with_proofs:
            step = len(inside) + len(above)
            out["proof"] = [proofs[i * step:(i + 1) * step] for i in range(len(out))]
        return out
    return run


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
             claimed: Sequence[Column] | None = None, claims: Column | None = None, with_proofs: bool = False,
             fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified. Where ``claims`` holds, the leaf of the ``claimed``
    fields (the data as someone hands it over) is folded with the proof, else
    the own leaf. ``with_proofs`` adds ``proof``, the siblings of each level."""
    own = leaf([F.col(f) for f in fields])
    other = F.when(claims, leaf(claimed)) if claimed is not None else F.lit(None).cast("string")
    group = F.col(group_col).cast("string")
    # the id travels as text, the group as a text that is never null and sorts like it
    leaves = staged(docs.select(F.col(id_col).cast("long").alias("order"), F.col(id_col).cast("string").alias("id"),
                                F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("key"),
                                own.alias("leaf"), other.alias("claimed")), "merkle-leaves")
    blocks = staged(_numbered(leaves, "key", ["order", "leaf"]).drop("order")
                    .withColumn("block", F.expr(f"idx div {fan ** levels}")), "merkle-blocks")
    nodes = (blocks.drop("id", "claimed").groupBy("key", "block")
             .applyInPandas(_reduce(fan, levels), "key string, idx long, digest string, n long"))
    subroots, ways = _ascend(nodes, fan)
    ranked = _numbered(subroots.withColumn("group", F.lit(0)), "group", ["key"])
    tops, root_ways = _ascend(ranked.select(F.lit("").alias("key"), "idx", "digest", "n"), fan)
    top = tops.first()  # one value
    tails = ranked.select("key", "idx", F.col("digest").alias("subroot")).join(
        root_ways.select("idx", F.col("path").alias("root_path")), "idx").drop("idx")
    outer = ways.withColumnRenamed("idx", "block").join(tails, "key")
    schema = "id string, leaf string, subroot string, proof_sha256 string, folded_root string"
    folded = (blocks.groupBy("key", "block").cogroup(outer.groupBy("key", "block"))
              .applyInPandas(_exchange(fan, levels, with_proofs), schema + (", proof array<string>" if with_proofs else "")))
    root = F.lit(top.digest if top else None).cast("string")
    found = folded.select(F.col("id").cast("long").alias("doc_id"), "leaf", "subroot", root.alias("root"),
                          "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"),
                          *(["proof"] if with_proofs else []))
    return found


def tamper_report(docs: DataFrame) -> DataFrame:
    """The manifest checked against a copy in which the text of every row whose
    id has a crc32 divisible by 3 was lower-cased (A-Z only)."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest(docs, claimed=[F.translate("text", _UPPER, _LOWER) if f == "text" else F.col(f) for f in FIELDS],
                    claims=F.coalesce(hit, F.lit(False)))
