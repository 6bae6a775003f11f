"""Shards by a k-d tree over document metadata.

Every document is a point: rank of its source, rank of its language, its length (logarithm of characters) and rank of its id, with its bytes
as weight. From one node for the whole corpus on, every node heavier than ``target_bytes`` is split at the
weighted median of its widest dimension (width relative to the whole corpus; ties go to the first dimension), until
every leaf is within the target.

The text is read once, for its bytes; the points, some tens of bytes each, are written to the shared folder. As long as a node has more
than ``task_rows`` points it is split level by level and distributed, in two aggregations: extents and weight of each node, then weight by bin of the
split dimension (``bins`` a node). The median falls in one bin; that bin's rows are binned again until the bin holds one value, so the
split is the exact weighted median. Splits are joined back by node: a broadcast while the written table of splits is small, else a shuffle
of points, never of texts. The subtree of a node of at most ``task_rows`` points is finished in one task, by the same rule in numpy.

A split puts values up to the median left and the rest right; where the median is the greatest value, it goes right
alone. A node whose points all coincide can't be split: it is a leaf beyond the target, as is a single document that large (``oversize``). Null sources,
languages and ids rank 0, before all others; null texts weigh 0 and still belong to a shard. Ranks are of the
distinct values in order, so ids are of any type with an order, and large ones are told apart. Repeated rows share a point and a shard. An
empty table gives no shards.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.columns import col, kind
from loomwork.operators.dedup import dense_ids
from loomwork.workspace import Workspace

DIMS = ("d0", "d1", "d2", "d3")


def _ranked(rows: DataFrame, column: str, out: str, ws: Workspace) -> DataFrame:
    """``rows`` with the rank of ``column`` among its distinct values: a small table, joined by value."""
    values = rows.select(F.col(column).alias("__v")).distinct().filter("__v is not null")
    ranks = ws.save(dense_ids(values, ["__v"], "__r").select("__v", (F.col("__r") + 1).cast("double").alias(out)))
    return rows.join(ranks, F.col(column) == F.col("__v"), "left").drop("__v").withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))


def points(docs: DataFrame, ws: Workspace, doc_id: str, text: str, source: str, lang: str) -> DataFrame:
    size, chars = F.coalesce(F.octet_length(col(text)), F.lit(0)).cast("long"), F.coalesce(F.length(col(text)), F.lit(0))
    rows = ws.save(docs.select(col(doc_id).alias("doc_id"), col(source).cast("string").alias("source"), col(lang).cast("string").alias("lang"), size.alias("bytes"), F.log2(F.lit(1.0) + chars).alias("d2")))
    rows = _ranked(_ranked(_ranked(rows, "source", "d0", ws), "lang", "d1", ws), "doc_id", "d3", ws)
    return ws.save(rows.select("doc_id", "bytes", *DIMS))


def _value(dim: Column) -> Column:
    got = F.col(DIMS[0])
    for i, d in enumerate(DIMS[1:], 1):
        got = F.when(dim == i, F.col(d)).otherwise(got)
    return got


def _medians(rows: DataFrame, ws: Workspace, bins: int) -> DataFrame:
    """node, dim, cut for ``rows`` of node, dim, lo, hi, weight (of the node), bytes and value v: cut is the least
    value up to which at least half of the node's weight lies."""
    state = rows.groupBy("node").agg(F.first("dim").alias("dim"), F.first("lo").alias("lo"), F.first("hi").alias("hi"), (F.first("weight") / 2).alias("need"))
    state = ws.save(state)
    inside, found = rows.select("node", "v", "bytes"), []
    while True:
        open_ = inside.join(state, "node").filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        width = F.col("hi") - F.col("lo")
        at = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("lo")) / width * bins), F.lit(bins - 1))).otherwise(0)
        hist = open_.groupBy("node", at.alias("bin")).agg(F.sum("bytes").alias("w"), F.min("v").alias("a"), F.max("v").alias("b"), F.first("need").alias("need"), F.first("dim").alias("dim"))
        before = Window.partitionBy("node").orderBy("bin")
        run = hist.withColumn("upto", F.sum("w").over(before)).withColumn("ahead", F.col("upto") - F.col("w"))
        hit = ws.save(run.filter((F.col("upto") >= F.col("need")) & ((F.col("ahead") < F.col("need")) | ((F.col("bin") == 0) & (F.col("need") <= 0)))).groupBy("node").agg(F.min_by(F.struct("dim", "a", "b", F.col("need") - F.col("ahead")), "bin").alias("x")).select("node", F.col("x.dim").alias("dim"), F.col("x.a").alias("lo"), F.col("x.b").alias("hi"), F.col("x.col4").alias("need")))
        found.append(hit.filter("lo = hi").select("node", "dim", F.col("lo").alias("cut")))
        state = hit.filter("lo < hi")
        if state.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _finished(target: int, spread: list[float]):
    """The leaves of the subtree of one node: by the same rule, in numpy."""

    def run(rows: pa.Table) -> pa.Table:
        size = rows.column("bytes").to_numpy()
        point = [rows.column(d).to_numpy() for d in DIMS]
        shard, weights = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64)
        todo = [(rows.column("node")[0].as_py(), np.arange(len(size)))]
        while todo:
            node, own = todo.pop()
            weight = int(size[own].sum())
            widths = [(p[own].max() - p[own].min()) / s for p, s in zip(point, spread)]
            dim = int(np.argmax(widths))
            if weight <= target or widths[dim] == 0:
                shard[own], weights[own] = node, weight
                continue
            v = point[dim][own]
            order = np.argsort(v, kind="stable")
            cut = v[order[np.searchsorted(np.cumsum(size[own][order]), weight / 2)]]
            right = v >= cut if cut == v.max() else v > cut
            todo += [(node * 2, own[~right]), (node * 2 + 1, own[right])]
        return pa.table({"doc_id": rows.column("doc_id"), "shard": shard, "shard_bytes": weights, "oversize": weights > target})

    return run


def shard(docs: DataFrame, target_bytes: int = 8 << 20, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", bins: int = 1024, task_rows: int = 1_000_000) -> DataFrame:
    """Columns doc_id, shard (the leaf: 1 is the root, the children of k are 2k and 2k + 1), shard_bytes, oversize: one row
    for each row of ``docs``."""
    ws = Workspace(docs.sparkSession, "kdtree")
    pts = points(docs, ws, doc_id, text, source, lang)
    now = pts.withColumn("node", F.lit(1).cast("long"))
    extents = [x for i, d in enumerate(DIMS) for x in (F.min(d).alias(f"lo{i}"), F.max(d).alias(f"hi{i}"))]
    root = pts.agg(*extents).first()
    spread = [((root[f"hi{i}"] or 0) - (root[f"lo{i}"] or 0)) or 1.0 for i in range(len(DIMS))]
    schema = f"doc_id {kind(pts, 'doc_id').simpleString()}, shard long, shard_bytes long, oversize boolean"
    leaves = []
    while True:
        nodes = now.groupBy("node").agg(F.sum("bytes").alias("weight"), F.count("*").alias("rows"), *extents)
        widths = [(F.col(f"hi{i}") - F.col(f"lo{i}")) / spread[i] for i in range(len(DIMS))]
        widest = F.greatest(*widths)
        dim = F.lit(len(DIMS) - 1)
        for i in reversed(range(len(DIMS) - 1)):
            dim = F.when(widths[i] == widest, i).otherwise(dim)
        nodes = nodes.withColumn("widest", widest).withColumn("dim", dim)
        pick = lambda side: F.element_at(F.array(*[F.col(f"{side}{i}") for i in range(len(DIMS))]), F.col("dim") + 1)
        nodes = ws.save(nodes.select("node", "weight", "rows", "dim", pick("lo").alias("lo"), pick("hi").alias("hi"), ((F.col("weight") > target_bytes) & (F.col("widest") > 0)).alias("split")))
        ends = nodes.filter("not split")
        leaves.append(now.join(ends.select("node", "weight"), "node").select("doc_id", F.col("node").alias("shard"), F.col("weight").alias("shard_bytes"), (F.col("weight") > target_bytes).alias("oversize")))
        small = nodes.filter((F.col("rows") <= task_rows) & F.col("split")).select("node")
        leaves.append(ws.save(now.join(small, "node").groupBy("node").applyInArrow(_finished(target_bytes, spread), schema)))
        parts = nodes.filter((F.col("rows") > task_rows) & F.col("split")).drop("rows", "split")
        if parts.isEmpty():
            break
        rows = now.join(parts, "node")
        cuts = ws.save(_medians(rows.withColumn("v", _value(F.col("dim"))).select("node", "dim", "lo", "hi", "weight", "bytes", "v"), ws, bins))
        cuts = ws.save(cuts.join(parts.select("node", "hi"), "node").select("node", "dim", "cut", (F.col("cut") == F.col("hi")).alias("top")))
        v = _value(F.col("dim"))
        right = F.when(F.col("top"), v >= F.col("cut")).otherwise(v > F.col("cut"))
        moved = now.join(cuts, "node").withColumn("node", F.col("node") * 2 + right.cast("long"))
        now = ws.save(moved.select("doc_id", "bytes", *DIMS, "node"))
    return functools.reduce(DataFrame.unionByName, leaves)


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", **params) -> None:
    """Write ``docs`` as one folder of Parquet a shard. Documents are told apart by id, which must be unique."""
    of = shard(docs, doc_id=doc_id, **params).select(F.col("doc_id").alias("__lw_i"), F.col("shard").alias("__lw_shard"))
    joined = docs.join(of, col(doc_id).eqNullSafe(F.col("__lw_i"))).drop("__lw_i")
    joined.repartition("__lw_shard").write.partitionBy("__lw_shard").parquet(path)
