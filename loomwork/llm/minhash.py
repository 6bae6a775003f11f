"""Near-duplicate detection with bottom-k sketches from one hash function.

A text's shingles are its runs of ``n`` words (lower case, letters and digits; each character in scripts without spaces), hashed to 64
bits; its sketch is the ``k`` least. Texts with one shingle set form one node (exact copies never meet pairwise). Then:

1. Inverted lists of retained values. A pair whose union sketch can reach the estimate ``t_est`` shares at least
   ceil(t_est * s) values of either sketch of s values, so under one total order (rarest value first) the two meet
   in the list of one of the first s - ceil(t_est * s) + 1 values of each. Only those are listed: values of
   passages that many documents share come last and fall away without loss. The sketch of a text of up to k shingles is its whole set; of
   one so short that its partners are whole too no estimate is needed, and ``threshold`` takes the place of t_est.
2. First pass: each list links its members to its least node. Second pass: in the lists of three and more that still hold more than
   one component, all pairs across components of sets not too unlike in size. Pairs within a component would change nothing, so the components
   are those of all candidate pairs, while a group of thousands of copies costs a star instead of a square.
3. Each candidate pair of whole sketches has its exact Jaccard similarity from them. Any other is estimated from the union sketch and, if the
   estimate suffices, verified by the exact similarity of the shingle sets. Pairs of at least ``threshold`` are edges; groups are the
   connected components.

What moves: ids, hashes and sketches. Texts are read once. The shingle sets are written beside the sketches where the texts lie, as 40-bit hashes
(5 bytes a shingle; two sets of m shingles have about m**2 / 2**40 false matches). Only sets of nodes with a pair to verify are read again: the
file that has each is known, so requests go to the files, a task a file, and no set is shuffled that isn't needed. (Where Arrow doesn't know
the store of the shared folder, the sets are joined instead.) ``kept`` joins the rows to drop with the documents: a broadcast while
they are few, beyond that the one shuffle of texts.

Nodes and values are 64-bit hashes: among m distinct shingle sets about m**2 / 2**65 pairs of nodes collide.

Null texts and texts without words are never duplicates; a text of fewer than n words has one shingle, all its
words. Rows equal in id and text are one document. The member with the least (id, text hash) stays, null ids last. Ids are of any type with
an order. An empty table gives an empty result. Other columns are never looked at, whatever their names and types.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.columns import col, cols, kind
from loomwork.llm.textkernels import encode, mix64, shingle_sets
from loomwork.operators.graph import connected_components
from loomwork.workspace import Workspace, openable, opened


def set_hash(s: np.ndarray) -> int:
    """One 64-bit hash of a sorted set of 64-bit values."""
    h = mix64(s + np.arange(len(s), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return int(mix64(np.array([h.sum(dtype=np.uint64) + np.uint64(len(s))]))[0].view(np.int64))


def _signatures(n: int, k: int, short: float):
    """Rows doc_id, th, node, n, sketch, set; no set for a text of up to ``short`` shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = encode(batch.column(2).to_pylist(), lower=True)
            nodes, counts, sizes, values, sets = [], [], [], [], []
            for s in shingle_sets(texts, n):
                nodes.append(set_hash(s) if len(s) else None)
                counts.append(len(s))
                sets.append(_packed(s) if len(s) > short else None)
                signed = s.view(np.int64)
                # the k least as signed numbers: the negative ones, sorted last as unsigned, come first
                split = int(np.searchsorted(s, np.uint64(1 << 63)))
                least = np.concatenate((signed[split:], signed[:split]))[:k]
                sizes.append(len(least))
                values.append(least)
            flat = np.concatenate(values) if values else np.zeros(0, np.int64)
            sketch = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(counts, pa.int32()), sketch, pa.array(sets, pa.binary())], names=["doc_id", "th", "node", "n", "sketch", "set"])

    return run


def _packed(s: np.ndarray) -> bytes:
    """The upper 40 bits of sorted shingle hashes, in 5 bytes each."""
    return np.unique(s >> np.uint64(24)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()


def _looked_up(folder: str):
    """Rows node, set for requests (file, node): every file of ``folder`` that is asked for is read once, a row group at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[str, list] = {}
        for batch in batches:
            names, nodes = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
            at = names.indices.to_numpy()
            for i, name in enumerate(names.dictionary.to_pylist()):
                wanted.setdefault(name, []).append(nodes[at == i])
        for name, parts in wanted.items():
            left = np.concatenate(parts)
            with opened(f"{folder}/{name}") as source:
                file = pq.ParquetFile(source)
                for g in range(file.num_row_groups):
                    if not len(left):
                        break
                    rows = file.read_row_group(g, columns=["node", "set"])
                    rows = rows.filter(pc.is_in(rows.column("node"), value_set=pa.array(left)))
                    found, first = np.unique(rows.column("node").to_numpy(), return_index=True)
                    left = np.setdiff1d(left, found)
                    yield from rows.take(pa.array(first)).to_batches(max_chunksize=512)

    return run


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, 3:] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.view(">u8").ravel().astype(np.uint64)


def exact_jaccard(a: str, b: str):
    """The Jaccard similarity of two columns of packed sets; ``a`` repeats where a node has many pairs."""

    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series) -> pd.Series:
        out, held, held_set = [], None, None
        for x, y in zip(a, b):
            if x != held:
                held, held_set = x, _unpacked(x)
            other = _unpacked(y)
            total = len(held_set) + len(other)
            union = len(np.unique(np.concatenate((held_set, other))))
            out.append((total - union) / union if union else 0.0)
        return pd.Series(out, dtype=float)

    return exact(a, b)


class NearDuplicates:
    """``docs`` split into groups of near duplicates. ``groups`` has the columns doc_id, th (hash of the text),
    copies (rows equal in id and text), worded (has words), group_id (the least doc_id), group_size (rows), keep. It reads tables of the
    shared folder, which ``close`` deletes."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.6, n: int = 3, k: int = 64, slack: float = 2.5, lookup: bool = True):
        self.lookup = lookup
        self.ws = ws = Workspace(docs.sparkSession, "minhash")
        self.n, self.k, self.threshold = n, k, threshold
        self.t_est = max(1 / k, threshold - slack * math.sqrt(threshold * (1 - threshold) / k))
        keyed = docs.select(col(doc_id).alias("doc_id"), F.xxhash64(col(text)).alias("th"), col(text).alias("text"))
        of = kind(docs, doc_id).simpleString()
        self.short = k * threshold  # the partners of so short a text are whole in their sketches, as it is itself
        self.sig = sig = ws.save(keyed.mapInArrow(_signatures(n, k, self.short), f"doc_id {of}, th long, node long, n int, sketch array<long>, set binary"))
        self.nodes = nodes = ws.save(sig.filter("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")))
        lists = ws.save(self._lists(nodes))
        self.edges = self._edges(lists)
        label = ws.save(connected_components(self.edges, "a", "b"))
        self.groups = ws.save(self._groups(sig, label))
        ws.drop(sig, nodes, lists, label)

    def _lists(self, nodes: DataFrame) -> DataFrame:
        """Inverted lists (v, node) of the first values of each sketch, rarest first, without values of one node."""
        e = nodes.select("node", F.explode("sketch").alias("v"))
        shared = e.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1")
        s = F.size("sketch")
        t = F.when(F.col("n") <= F.lit(self.short), F.lit(self.threshold)).otherwise(F.lit(self.t_est))
        # values of one node come before the shared ones: they are s less the node's rows
        sizes = nodes.select("node", (s - F.ceil(t * s - 1e-9) + 1).cast("int").alias("most"), s.alias("s"))
        own = Window.partitionBy("node")
        ranked = e.join(shared, "v").select("node", "v", F.row_number().over(own.orderBy("df", "v")).alias("r"), F.count("*").over(own).alias("held"))
        return ranked.join(sizes, "node").filter(F.col("r") <= F.col("most") - (F.col("s") - F.col("held"))).select("v", "node")

    def _sets(self, pairs: DataFrame) -> DataFrame:
        """node, set: of the ends of these pairs."""
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        folder = self.sig._loomwork_path
        if not self.lookup or not openable(folder):
            return self.ws.save(self.sig.select("node", "set").join(ends, "node", "left_semi").groupBy("node").agg(F.first("set").alias("set")))
        # rows of one node have one set: that of the first file will do
        where = self.sig.select("node", F.col("_metadata.file_name").alias("file")).join(ends, "node", "left_semi").groupBy("node").agg(F.min("file").alias("file"))
        requests = where.select("file", "node").repartition(len(self.sig.inputFiles()) or 1, "file")
        return self.ws.save(requests.mapInArrow(_looked_up(folder), "node long, set binary"))

    def _verified(self, pairs: DataFrame) -> DataFrame:
        ends = {x: self.nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab"}
        both = pairs.join(ends["a"], "a").join(ends["b"], "b")
        # a similarity of t needs sets whose sizes differ by that factor at most
        both = both.filter(F.least("na", "nb") >= F.lit(self.threshold) * F.greatest("na", "nb"))
        sure = F.greatest("na", "nb") <= self.k
        share = F.size(F.array_intersect("sa", "sb")) / F.size(F.array_union("sa", "sb"))
        union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, self.k)
        near = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union)) / F.size(union)
        scored = both.select("a", "b", sure.alias("sure"), F.when(sure, share).otherwise(near).alias("j"))
        close = self.ws.save(scored.filter(F.col("j") >= F.when(F.col("sure"), self.threshold).otherwise(self.t_est)))
        short = close.filter("sure").select("a", "b", F.col("j").alias("jaccard"))
        long = close.filter("not sure").select("a", "b")
        sets = self._sets(long)
        of = {x: sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}")) for x in "ab"}
        exact = long.join(of["b"], "b").join(of["a"], "a").withColumn("jaccard", exact_jaccard("set_a", "set_b"))
        out = self.ws.save(short.unionByName(exact.filter(F.col("jaccard") >= self.threshold).select("a", "b", "jaccard")))
        self.ws.drop(close, sets)
        return out

    def _edges(self, lists: DataFrame) -> DataFrame:
        ws = self.ws
        hubs = ws.save(lists.groupBy("v").agg(F.min("node").alias("a"), F.count("*").alias("c")).filter("c > 1"))
        star = ws.save(lists.join(hubs.select("v", "a"), "v").filter("node > a").select("a", F.col("node").alias("b")).distinct())
        first = self._verified(star)
        label = ws.save(connected_components(first, "a", "b"))
        # the pair of a list of two is verified already
        of = lists.join(hubs.filter("c > 2").select("v"), "v", "left_semi").join(label, "node", "left").select("v", "node", F.coalesce("component", "node").alias("c"))
        of = ws.save(of)
        # members of a list's largest component meet those of others only
        main = of.groupBy("v", "c").agg(F.count("*").alias("m")).groupBy("v").agg(F.max_by("c", F.struct("m", "c")).alias("main"), F.count("*").alias("cs")).filter("cs > 1").select("v", "main")
        open_ = ws.save(of.join(main, "v").join(self.nodes.select("node", "n"), "node"))
        x, y = (open_.select("v", "main", F.col("node").alias(p), F.col("c").alias(f"c{p}"), F.col("n").alias(f"n{p}")) for p in "ab")
        alike = F.least("na", "nb") >= F.lit(self.threshold) * F.greatest("na", "nb")
        across = x.drop("main").join(y.filter("cb <> main"), "v").filter("ca <> cb").filter(alike)
        rest = ws.save(across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(star, ["a", "b"], "left_anti"))
        second = self._verified(rest)
        edges = ws.save(first.unionByName(second))
        ws.drop(hubs, star, label, of, open_, rest, first, second)
        return edges

    @staticmethod
    def _groups(sig: DataFrame, label: DataFrame) -> DataFrame:
        """One row for each distinct (id, text)."""
        docs = sig.groupBy("doc_id", "th", "node").agg(F.count("*").alias("copies"))
        inside = docs.join(label, "node", "left").select("doc_id", "th", "copies", F.coalesce("component", "node").alias("c"))
        key = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("th"))
        first = inside.filter("c is not null").groupBy("c").agg(F.min(key).alias("k"), F.sum("copies").alias("group_size"))
        got = inside.join(first, "c", "left")
        alone = F.col("c").isNull()
        return got.select(
            "doc_id", "th", "copies", (~alone).alias("worded"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("k.doc_id")).alias("group_id"),
            F.when(alone, F.col("copies")).otherwise(F.col("group_size")).alias("group_size"),
            (alone | (key == F.col("k"))).alias("keep"),
        )

    def kept(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """The rows of ``docs`` that stay: one of each group, columns as they are. Of rows equal in id and text one
        stays (the least in its columns' order as text); rows without words all stay. One join decides for both."""
        of = self.groups.filter("not keep or (worded and copies > 1)").select(F.col("doc_id").alias("__lw_i"), F.col("th").alias("__lw_h"), F.col("keep").alias("__lw_again"))
        same = col(doc_id).eqNullSafe(F.col("__lw_i")) & (F.xxhash64(col(text)) == F.col("__lw_h"))
        if of.filter("__lw_again").isEmpty():
            return docs.join(of, same, "left_anti")
        marked = docs.join(of, same, "left").filter("__lw_again is null or __lw_again")
        once = marked.filter("__lw_again is null").select(*cols(docs))
        least = F.min_by(F.struct(*cols(docs)), F.struct(*[c.cast("string") for c in cols(docs)]))
        several = marked.filter("__lw_again").groupBy("__lw_i", "__lw_h").agg(least.alias("__lw_r"))
        return once.unionByName(several.select(*[F.col("__lw_r").getField(c).alias(c) for c in docs.columns]))

    def close(self) -> None:
        self.ws.close()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """Columns doc_id, group_id, group_size, keep: one row for each distinct (id, text) of ``docs``."""
    return NearDuplicates(docs, doc_id, text, **params).groups.select("doc_id", "group_id", "group_size", "keep")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """``docs`` with one row of each group of near duplicates."""
    return NearDuplicates(docs, doc_id, text, **params).kept(docs, doc_id, text)
