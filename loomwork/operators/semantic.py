"""Embeddings: pooling of windows, exact nearest neighbours by blocks, and semantic deduplication."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.functions.text import let, split_tokens
from loomwork.operators.dedup import _roots, representatives
from loomwork.operators.graph import connected_components
from loomwork.workspace import Workspace


def mean_pool(df: DataFrame, owner: str, vector: str, out: str = "embedding") -> DataFrame:
    """The mean of each owner's vectors, of length 1. Summed by dimension, so that partial sums combine before the shuffle."""
    parts = df.select(owner, F.posexplode(vector).alias("__i", "__v")).groupBy(owner, "__i").agg(F.avg("__v").alias("__m"))
    lists = parts.groupBy(owner).agg(F.array_sort(F.collect_list(F.struct("__i", "__m"))).alias("__l"))
    return lists.select(owner, _of_length_one(F.col("__l.__m")).alias(out))


def _of_length_one(v: Column) -> Column:
    """A vector by its norm, which is taken once and not for each element."""
    norm = lambda m: F.sqrt(F.aggregate(m, F.lit(0.0), lambda a, x: a + x * x))
    return let(v, lambda m: let(norm(m), lambda n: F.when(n > 0, F.transform(m, lambda x: x / n)).otherwise(m)))


def embed(df: DataFrame, doc_id: str, text: str, encoder: Callable[[], Callable[[list[str]], np.ndarray]], size: int = 350, stride: int = 300, keep_tail: bool = True, batch: int = 128) -> DataFrame:
    """doc_id, embedding: windows of tokens, encoded in batches across documents, pooled by document. All tokens count;
    without ``keep_tail`` those after the last full window don't (parity with the reference).

    Windows are cut, encoded and pooled where the text is. Only documents of several rows move, summed by dimension. ``encoder`` makes the
    encoder once a task: a model is injected, none is shipped."""

    def cut(x: str | None) -> list[str]:
        t = split_tokens(x) if x else []
        more = len(t) - size
        last = 0 if more <= 0 else -(-more // stride) if keep_tail else more // stride
        return [" ".join(t[i * stride : i * stride + size]) for i in range(last + 1)] if t else []

    def pooled(mean: bool):
        @F.pandas_udf("struct<v:array<double>,n:long>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            encode = encoder()
            for s in batches:
                wins = [cut(x) for x in s]
                flat = [w for x in wins for w in x]
                got = [np.asarray(v, dtype=float) for i in range(0, len(flat), batch) for v in encode(flat[i : i + batch])]
                out, at = [], 0
                for x in wins:
                    v = np.cumsum(got[at : at + len(x)], axis=0)[-1] if x else None
                    at += len(x)
                    if mean and x:
                        v = v / len(x)
                        norm = np.sqrt(np.cumsum(v * v)[-1])
                        v = v / norm if norm > 0 else v
                    out.append(v)
                yield pd.DataFrame({"v": pd.Series(out, dtype=object), "n": [len(x) for x in wins]})

        return run

    rows = df.select(F.col(doc_id).alias("d"), F.col(text).alias("t"))
    one = lambda part: part.select("d", pooled(True)("t").alias("e")).filter("e.n > 0").select(F.col("d").alias(doc_id), F.col("e.v").alias("embedding"))
    repeated = Workspace(df.sparkSession, "embed").save(rows.groupBy("d").count().filter("count > 1").select(F.col("d").alias("r")))
    if repeated.isEmpty():
        return one(rows)
    same = F.col("d").eqNullSafe(F.col("r"))
    parts = rows.join(repeated, same, "left_semi").select("d", pooled(False)("t").alias("e")).filter("e.n > 0").select("d", "e.n", F.posexplode("e.v").alias("i", "v"))
    lists = parts.groupBy("d", "i").agg((F.sum("v") / F.sum("n")).alias("m")).groupBy("d").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("l"))
    return one(rows.join(repeated, same, "left_anti")).unionByName(lists.select(F.col("d").alias(doc_id), _of_length_one(F.col("l.m")).alias("embedding")))


def hashed_encoder(dims: int = 64) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """A deterministic stand-in for a model: hashed word counts, by md5, so that any engine can repeat them. For tests; its vectors are no
    model output."""
    from hashlib import md5

    def make():
        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dims))
            for i, t in enumerate(texts):
                words = " ".join(split_tokens(t)).encode().split()
                h = np.frombuffer(b"".join([md5(w).digest()[:4] for w in words]), ">u4").astype(np.int64)
                n = np.bincount(h % dims + np.where(h >> 31, 0, dims), minlength=2 * dims)
                out[i] = n[:dims] - n[dims:]
            return out

        return encode

    return make


#: Rows of a block that are compared at a time: what a task holds is this many by the rows of a block, a few times.
STEP = 64


def _vectors(df: DataFrame, vec_id: str, vector: str, blocks: int | None) -> tuple[DataFrame, int]:
    """id, v, b (the block), and the number of blocks: by default so many that a block holds about 20,000 vectors."""
    base = df.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v")).filter("v is not null")
    blocks = blocks or max(1, -(-base.count() // 20_000))
    return base.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), blocks


def _unit(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors, without zero vectors."""
    m = np.stack(rows.v.to_list()) if len(rows) else np.zeros((0, 1))
    n = np.linalg.norm(m, axis=1)
    return rows.id.to_numpy()[n > 0], m[n > 0] / n[n > 0][:, None]


def cosine_topk(df: DataFrame, vec_id: str, vector: str, k: int = 1, threshold: float = -1.0, blocks: int | None = None, queries: DataFrame | None = None) -> DataFrame:
    """id, neighbour, similarity, rank: the k nearest others of every row of ``queries`` (default: the table itself) by exact cosine, ties
    to the least id.

    This is the exact search: the work is queries times rows. Both sides fall into blocks by hash; each pair of blocks is one task's matrix
    product, so a task's memory is bound by the blocks (about 20,000 vectors each) and the shuffle sends each row once to every block
    of queries. Each task returns k candidates a query. Zero and null vectors are left out."""
    base, blocks = _vectors(df, vec_id, vector, blocks if queries is not None else blocks or max(4, -(-df.count() // 20_000)))
    asked, asking = _vectors(queries, vec_id, vector, None) if queries is not None else (base, blocks)
    as_query = asked.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(F.col("b").alias("x"), F.col("o").alias("y"), "id", "v", F.lit(True).alias("q"))
    as_other = base.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(asking - 1)))).select(F.col("o").alias("x"), F.col("b").alias("y"), "id", "v", F.lit(False).alias("q"))
    kind = base.schema["id"].dataType

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        (a, x), (b, y) = (_unit(rows[rows.q == side].sort_values("id", kind="stable")) for side in (True, False))
        out = [pd.DataFrame({"id": a[:0], "neighbour": b[:0], "similarity": pd.Series(dtype=float)})]
        for i in range(0, len(a) if len(b) else 0, STEP):
            # rounded, so that equal vectors tie whatever the block sizes
            s = np.round(x[i : i + STEP] @ y.T, 9)
            s[a[i : i + STEP][:, None] == b[None, :]] = -np.inf
            top = np.argsort(-s, axis=1, kind="stable")[:, :k]
            sim = np.take_along_axis(s, top, axis=1)
            keep = (np.isfinite(sim) & (sim >= threshold)).ravel()
            out.append(pd.DataFrame({"id": np.repeat(a[i : i + STEP], top.shape[1])[keep], "neighbour": b[top].ravel()[keep], "similarity": sim.ravel()[keep]}))
        return pd.concat(out)

    schema = T.StructType([T.StructField("id", kind), T.StructField("neighbour", kind), T.StructField("similarity", T.DoubleType())])
    found = as_query.unionByName(as_other).groupBy("x", "y").applyInPandas(best, schema)
    w = Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def cosine_pairs(df: DataFrame, vec_id: str, vector: str, threshold: float, blocks: int | None = None, forest: bool = False) -> DataFrame:
    """a < b, similarity: all pairs from ``threshold`` on, exactly, by blocks. With ``forest`` a task makes of its pairs a star a component: columns a, b, as
    many rows as vectors at most, and the same components."""
    base, blocks = _vectors(df, vec_id, vector, blocks or max(4, -(-df.count() // 20_000)))
    spread = base.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(F.least("b", "o").alias("x"), F.greatest("b", "o").alias("y"), "id", "v", "b")
    kind = base.schema["id"].dataType

    def near(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = int(rows.x.iloc[0]), int(rows.y.iloc[0])
        (a, p), (b, q) = (_unit(rows[rows.b == blk]) for blk in (x, y))
        out = [pd.DataFrame({"a": a[:0], "b": b[:0], "similarity": pd.Series(dtype=float)})]
        ids, shift = (a, 0) if x == y else (np.concatenate([a, b]), len(a))
        root = np.arange(len(ids))
        for i in range(0, len(a) if len(b) else 0, STEP):
            s = np.round(p[i : i + STEP] @ q.T, 9)
            r, c = np.nonzero(s >= threshold)
            if forest:
                u, v = root[i + r], root[shift + c]
                u, v = np.divmod(np.unique((u * len(ids) + v)[u != v]), len(ids))
                if len(u):
                    root = _roots(len(ids), [(np.arange(len(ids)), root), (u, v)])
                continue
            u, v = a[i + r], b[c]
            ok = u < v if x == y else u != v
            out.append(pd.DataFrame({"a": np.minimum(u, v)[ok], "b": np.maximum(u, v)[ok], "similarity": s[r, c][ok]}))
        if forest:
            kept = np.flatnonzero(root != np.arange(len(ids)))
            return pd.DataFrame({"a": ids[root[kept]], "b": ids[kept]})
        return pd.concat(out)

    if forest:
        return spread.groupBy("x", "y").applyInPandas(near, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))
    return spread.groupBy("x", "y").applyInPandas(near, T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("similarity", T.DoubleType())]))


def semantic_dedup(df: DataFrame, doc_id: str, text: str, vector: str, threshold: float = 0.95, mode: str = "all_pairs", blocks: int | None = None) -> DataFrame:
    """component, doc_id, n: the longest text (or, without a text column, the least id) of each group of near vectors. ``all_pairs`` links each row to
    all others from the threshold on, ``top1`` to its nearest only (parity with the reference; a group may fall apart and keep several)."""
    ws = Workspace(df.sparkSession, "semantic")
    if mode == "top1":
        near = cosine_topk(df, doc_id, vector, 1, threshold, blocks).select(F.col("id").alias("a"), F.col("neighbour").alias("b"))
    else:
        near = cosine_pairs(df, doc_id, vector, threshold, blocks, forest=True)
    labels = connected_components(ws.save(near), "a", "b")
    return representatives(df if text else df.withColumn("__t", F.lit("")), doc_id, text or "__t", labels)
