"""Near-duplicate embeddings by cross-polytope hashing.

A vector is normalised, padded to a power of two and rotated at random three times over (signs, then fast Hadamard transform);
its hash is the axis of the cross-polytope that is nearest, the coordinate of greatest size with its sign. ``k`` such hashes make
a bucket of one of ``tables`` tables; a vector is also listed in the buckets that change one hash to an axis nearly as near (squared
difference of the coordinates up to ``reach`` / dimension), so the number of probes follows the doubt. ``k`` grows with the logarithm of the
number of vectors, so that a bucket has about ``per_bucket`` of them or fewer. There are as many tables as find 0.97 of the pairs right at the
threshold, by the share that one table finds of random pairs at that cosine.

Each listing carries 64 signs of one more rotation. Members of a bucket are candidates only if they differ in few of them: in no more than 4.5
deviations above the mean of pairs at the threshold, which those tables' count allows for. Buckets of up to ``most`` listings give all such
pairs, at most most / 2 a listing. A larger bucket (many copies of one vector) links its members to the least of them, and after components are
known to those of other components than its largest one: pairs within a component would change nothing, so the groups are the components of all
candidate pairs. All candidates are verified by exact cosine; only vectors that have one are joined.

Null, empty and zero vectors, and vectors with nulls, NaN or infinities, are never duplicates. Vectors of different length are
compared as if padded with zeros. Rows equal in id and vector are one; equal vectors form one node before hashing.
The member with the least id stays, null ids last (then least hash of the vector). Ids are of any type with an order. Other columns are never
looked at, whatever their names and types.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.columns import col
from loomwork.operators.graph import connected_components
from loomwork.workspace import Workspace

_BLOCK = 128


@functools.lru_cache(maxsize=16)
def _small(d: int) -> np.ndarray:
    h = np.ones((1, 1), dtype=np.float32)
    while len(h) < d:
        h = np.block([[h, h], [h, -h]])
    return (h / math.sqrt(d)).astype(np.float32)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, length a power of two: factors of up to 128 coordinates at a time."""
    n, d = x.shape
    if d <= _BLOCK:
        return x @ _small(d)
    a = d // _BLOCK
    y = (x.reshape(-1, _BLOCK) @ _small(_BLOCK)).reshape(n, a, _BLOCK).transpose(0, 2, 1).reshape(-1, a)
    return hadamard(np.ascontiguousarray(y)).reshape(n, _BLOCK, a).transpose(0, 2, 1).reshape(n, d)


@functools.lru_cache(maxsize=4096)
def _signs(d: int, seed: int, which: int) -> np.ndarray:
    return np.random.default_rng((seed, which, d)).choice(np.array([-1.0, 1.0], dtype=np.float32), (3, d))


def rotated(x: np.ndarray, seed: int, which: int) -> np.ndarray:
    for s in _signs(x.shape[1], seed, which):
        x = hadamard(x * s)
    return x


def listings(x: np.ndarray, k: int, tables: int, reach: float, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket number of every listing, the home buckets among them."""
    d = x.shape[1]
    near = min(d, 4)
    rows, keys, every = [], [], np.arange(len(x))
    for t in range(tables):
        axes, gaps = [], []
        for j in range(k):
            y = rotated(x, seed, 1 + t * k + j)
            size = np.abs(y)
            top = np.argpartition(-size, near - 1, axis=1)[:, :near]
            best = np.take_along_axis(size, top, axis=1)
            order = np.argsort(-best, axis=1, kind="stable")
            top, best = np.take_along_axis(top, order, axis=1), np.take_along_axis(best, order, axis=1)
            axes.append((top * 2 + (np.take_along_axis(y, top, axis=1) < 0)).astype(np.int64))
            gaps.append((best[:, :1] - best[:, 1:]) ** 2)
        home = np.full(len(x), t, dtype=np.int64)
        for j in range(k):
            home = home * (2 * d) + axes[j][:, 0]
        rows.append(every)
        keys.append(home)
        for j in range(k):
            r, c = np.nonzero(gaps[j] <= reach / d)
            rows.append(r)
            keys.append(home[r] + (axes[j][r, c + 1] - axes[j][r, 0]) * (2 * d) ** (k - 1 - j))
    return np.concatenate(rows), np.concatenate(keys)


def sketches(x: np.ndarray, seed: int = 5) -> np.ndarray:
    """64 signs of each row as a number."""
    d = x.shape[1]
    bits = np.concatenate([rotated(x, seed + 1, i) >= 0 for i in range(-(-64 // d))], axis=1)[:, :64]
    return np.packbits(bits, axis=1).view(">i8").ravel().astype(np.int64)


def signs_apart(threshold: float) -> int:
    """The greatest number of differing signs of a candidate."""
    p = math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    return min(64, math.floor(64 * p + 4.5 * math.sqrt(64 * p * (1 - p))))


def tables_for(d: int, k: int, reach: float, threshold: float, recall: float = 0.97, seed: int = 5) -> int:
    """Tables that find ``recall`` of the pairs right at the threshold: a table's share is measured on random pairs of that
    cosine, over four tables. ValueError where it finds none of them."""
    r, c, met, n = np.random.default_rng((seed, d, k)), min(1.0, max(-1.0, threshold)), 0, 2048
    for _ in range(0, n, 512):
        x, z = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in r.standard_normal((2, 512, d)))
        z -= (x * z).sum(axis=1, keepdims=True) * x
        y = c * x + math.sqrt(1 - c * c) * z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
        x, y = x.astype(np.float32), y.astype(np.float32)
        listed = [set(zip(*(v.tolist() for v in listings(w, k, 4, reach, seed)))) for w in (x, y)]
        alike = np.bitwise_count((sketches(x, seed) ^ sketches(y, seed)).astype(np.uint64)) <= signs_apart(threshold)
        met += len({(row, key // (2 * d) ** k) for row, key in listed[0] & listed[1] if alike[row]})
    if not met:
        raise ValueError(f"no table of {k} hashes in {d} dimensions finds pairs at a cosine of {threshold}: give tables, or a larger per_bucket")
    return 1 if met == 4 * n else math.ceil(math.log(1 - recall) / math.log(1 - met / (4 * n)))


def _unit(w: np.ndarray) -> np.ndarray:
    n = np.sqrt((w * w).sum(axis=1, keepdims=True))
    good = np.isfinite(n) & (n > 0)
    return np.where(good, w / np.where(good, n, 1), 0)


def _padded(vectors: list, d: int) -> np.ndarray:
    """Unit vectors of length d of vectors of finite numbers."""
    out = np.zeros((len(vectors), d))
    lengths = {len(v) for v in vectors}
    if len(lengths) == 1:
        out[:, : lengths.pop()] = np.stack(vectors)
    else:
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
    return _unit(out)


def _from_arrow(lists: pa.Array, d: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    return _padded(np.split(flat, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))[:-1]), d) if len(lists) else np.zeros((0, d))


def cosine(a, b):
    """Exact cosine of two array columns, for pairs that are few beside the table."""

    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series) -> pd.Series:
        d = max((len(v) for s in (a, b) for v in s), default=1) or 1
        out = [(_padded(list(a[i : i + 4096]), d) * _padded(list(b[i : i + 4096]), d)).sum(axis=1) for i in range(0, len(a), 4096)]
        return pd.Series(np.concatenate(out) if out else [], dtype=float)

    return exact(a, b)


class NearEmbeddings:
    """Groups of near-duplicate vectors; ``groups`` has vec_id, vh, group_id, group_size, keep."""

    def __init__(self, vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9, tables: int | None = None, reach: float = 0.03, per_bucket: float = 4, most: int = 32, seed: int = 5):
        self.ws = ws = Workspace(vectors.sparkSession, "embeddings")
        self.threshold = threshold
        kind = "array<float>" if vectors.schema[embedding].dataType.simpleString() == "array<float>" else "array<double>"
        e = col(embedding).cast(kind)
        usable = F.coalesce(e.isNotNull() & (F.size(e) > 0) & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0), F.lit(False))
        every = vectors.select(col(vec_id).alias("vec_id"), e.alias("e"), F.xxhash64(F.transform(e.cast("array<double>"), lambda v: v + F.lit(0.0))).alias("vh"), usable.alias("ok"))
        rows = ws.save(every.select("vec_id", "vh", "ok", F.size("e").alias("d")))
        self.nodes = ws.save(every.filter("ok").groupBy(F.col("vh").alias("node")).agg(F.first("e").alias("e")))
        shape = rows.agg(F.count("*").alias("n"), F.max("d").alias("d")).first()
        d = 1 << max(1, math.ceil(math.log2(max(2, shape.d or 0))))
        self.k = k = min(max(1, math.ceil(math.log(max(2, shape.n / per_bucket)) / math.log(2 * d))), int(54 // math.log2(2 * d)))
        self.tables = tables = tables or tables_for(d, k, reach, threshold, seed=seed)

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, 2048):
                    part = batch.slice(i, 2048)
                    x = _from_arrow(part.column(1), d).astype(np.float32)
                    at, keys = listings(x, k, tables, reach, seed)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part.column(0).to_numpy()[at]), pa.array(sketches(x, seed)[at])], names=["b", "node", "s"])

        self.lists = lists = ws.save(self.nodes.select("node", "e").mapInArrow(listed, "b long, node long, s long"))
        self.near = F.bit_count(F.col("sa").bitwiseXOR(F.col("sz"))) <= signs_apart(threshold)
        large = ws.save(lists.groupBy("b").agg(F.count("*").alias("n"), F.min(F.struct("node", "s")).alias("h")).filter(F.col("n") > most))
        first = self._verified(ws.save(self._pairs(lists.join(large, "b", "left_anti"))))
        hot = ws.save(lists.join(large.select("b", F.col("h.node").alias("a"), F.col("h.s").alias("sa")), "b"))
        star = ws.save(hot.withColumnRenamed("s", "sz").filter((F.col("node") > F.col("a")) & self.near).select("a", F.col("node").alias("z")).distinct().join(first, ["a", "z"], "left_anti"))
        first = ws.save(first.unionByName(self._verified(star)))
        label = ws.save(connected_components(first, "a", "z"))
        of = ws.save(hot.join(label, "node", "left").select("b", "node", "s", F.coalesce("component", "node").alias("c")))
        main = of.groupBy("b", "c").agg(F.count("*").alias("n")).groupBy("b").agg(F.max_by("c", F.struct("n", "c")).alias("main"), F.count("*").alias("m")).filter("m > 1").select("b", "main")
        open_ = ws.save(of.join(main, "b"))
        x, y = (open_.select("b", "main", F.col("node").alias(p), F.col("c").alias(f"c{p}"), F.col("s").alias(f"s{p}")) for p in "az")
        across = x.drop("main").join(y.filter("cz <> main"), "b").filter((F.col("ca") != F.col("cz")) & self.near)
        rest = ws.save(across.select(F.least("a", "z").alias("a"), F.greatest("a", "z").alias("z")).distinct().join(star, ["a", "z"], "left_anti").join(first, ["a", "z"], "left_anti"))
        self.edges = ws.save(first.unionByName(self._verified(rest)))
        label = ws.save(connected_components(self.edges, "a", "z"))
        self.groups = ws.save(self._groups(rows, label))
        ws.drop(hot, star, of, open_, rest, large)

    def _pairs(self, lists: DataFrame) -> DataFrame:
        x, y = (lists.select("b", F.col("node").alias(p), F.col("s").alias(f"s{p}")) for p in "az")
        return x.join(y, "b").filter((F.col("a") < F.col("z")) & self.near).select("a", "z").distinct()

    def _verified(self, pairs: DataFrame) -> DataFrame:
        ends = self.ws.save(pairs.select(F.col("a").alias("node")).union(pairs.select("z")).distinct())
        wanted = self.ws.save(self.nodes.join(ends, "node", "left_semi"))
        of = {p: wanted.select(F.col("node").alias(p), F.col("e").alias(f"e{p}")) for p in "az"}
        both = pairs.join(of["a"], "a").join(of["z"], "z")
        out = self.ws.save(both.withColumn("cosine", cosine(F.col("ea"), F.col("ez"))).filter(F.col("cosine") >= self.threshold).select("a", "z", "cosine"))
        self.ws.drop(ends, wanted)
        return out

    @staticmethod
    def _groups(rows: DataFrame, label: DataFrame) -> DataFrame:
        docs = rows.groupBy("vec_id", "vh", "ok").agg(F.count("*").alias("copies"))
        inside = docs.join(label.withColumnRenamed("node", "vh"), "vh", "left").withColumn("c", F.when(F.col("ok"), F.coalesce("component", "vh")))
        key = F.struct(F.col("vec_id").isNull(), F.col("vec_id"), F.col("vh"))
        first = inside.filter("c is not null").groupBy("c").agg(F.min(key).alias("k"), F.sum("copies").alias("group_size"))
        got = inside.join(first, "c", "left")
        alone = F.col("c").isNull()
        return got.select("vec_id", "vh", F.when(alone, F.col("vec_id")).otherwise(F.col("k.vec_id")).alias("group_id"), F.when(alone, F.col("copies")).otherwise(F.col("group_size")).alias("group_size"), (alone | (key == F.col("k"))).alias("keep"))

    def all_pairs(self) -> DataFrame:
        """Every verified pair of nodes that shares a bucket: as many rows as there are pairs, so quadratic in the size of a group."""
        return self._verified(self.ws.save(self._pairs(self.lists)))

    def close(self) -> None:
        self.ws.close()


def near_embeddings(vectors: DataFrame, **params) -> DataFrame:
    """Columns vec_id, group_id, group_size, keep: one row for each distinct (id, vector)."""
    return NearEmbeddings(vectors, **params).groups.select("vec_id", "group_id", "group_size", "keep")
