"""Hierarchical residual packing of documents into bins of fixed length.

Every partition packs its items by best fit, longest first. Bins of at least ``full`` of the capacity are emitted at
once; the underfull ones become items themselves and are merged up a tree, ``fan_in`` partitions a round, by best fit
again, until one partition is left. Only underfull bins move, and of them only ids and lengths; each round is
written to the shared folder.

Best fit leaves at most one bin of a task half full or less; all others are beyond half, so none of them fits another, and a merge needs one of
those few small bins. Bins that cannot be of use above are therefore emitted where they are: those whose room is less than the least
other bin's fill, and of the bins beyond half all but the ``SPARE * fan_in`` with the most room, more than there are small bins to come from
the siblings of SPARE levels. What a task gets is bound by fan_in alone, the root's too, and no merge is lost.

The length of a document is its number of words (runs of anything but white space; characters in scripts without spaces), or of tokens, if
the path of a vocabulary for ``tokenizers`` is given. A document longer than the capacity is split into pieces of the capacity,
each a full bin, and a rest. Documents of length 0 (null, empty, blank) have nothing to pack and are in no bin. Every
row is an item of its own, repeated rows too; a null id is listed as null. Ids are of any type with an order. Ties go by id and start. Which
items share a bin depends on the partitions; that every item is in one bin once, and no bin beyond the capacity, does not.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.columns import col, kind
from loomwork.llm.textkernels import spans
from loomwork.workspace import Workspace

_WORD = ~np.isin(np.arange(256), (9, 10, 11, 12, 13, 28, 29, 30, 31, 32))
#: Levels of the tree that the bins kept for later merges suffice for: fan_in ** 8 partitions.
SPARE = 8


def _schema(kind: str) -> str:
    return f"bin_id long, part int, fill int, done boolean, doc_ids array<{kind}>, starts array<long>, lengths array<int>"


class BestFit:
    """Open bins by what is left in them: a bit set finds the tightest bin that an item fits."""

    def __init__(self, capacity: int):
        self.capacity, self.bits, self.open = capacity, 0, {}
        self.bins: list[list] = []
        self.fill: list[int] = []

    def add(self, size: int, item) -> None:
        above = self.bits >> size
        if above:
            left = size + (above & -above).bit_length() - 1
            stack = self.open[left]
            at = stack.pop()
            if not stack:
                self.bits ^= 1 << left
            self.bins[at].append(item)
            self.fill[at] += size
        else:
            at, left = len(self.bins), self.capacity
            self.bins.append([item])
            self.fill.append(size)
        left -= size
        if left:
            if not self.bits >> left & 1:
                self.bits |= 1 << left
                self.open.setdefault(left, [])
            self.open[left].append(at)


def _word_counts(texts: pa.Array) -> np.ndarray:
    """Words of each text, from Arrow's own buffer."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, dtype=np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    out = np.zeros(len(texts), dtype=np.int64)
    step = 256
    for a in range(0, len(texts), step):
        o = offsets[a : a + step + 1]
        # a word that runs over the border of two texts counts in both: each text starts a word anew, unless one begins there anyhow
        part = raw[o[0] : o[-1]]
        start, _ = spans(part, "space")
        rel = o - o[0]
        n = np.diff(np.searchsorted(start, rel))
        inner = rel[1:-1]
        ok = (inner > 0) & (inner < len(part)) & (rel[2:] > inner)
        joined = np.zeros(len(inner), dtype=bool)
        at = inner[ok]
        word = _WORD[part] if len(at) else None
        if len(at):
            begins = np.zeros(len(part), dtype=bool)
            begins[start] = True
            joined[ok] = word[at] & word[at - 1] & ~begins[at]
        n[1:] += joined
        out[a : a + step] = n
    return out


def _counter(tokenizer: str | None):
    if tokenizer is None:
        return _word_counts
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    t.encode_special_tokens = True
    return lambda texts: np.array([len(x.ids) for x in t.encode_batch(["" if x is None else x for x in texts.to_pylist()], add_special_tokens=False)], dtype=np.int64)


def _done(fill: np.ndarray, capacity: int, least: int, spare: int) -> np.ndarray:
    """Which bins of a task need not go up: nearly full ones, and of those beyond half all but the roomiest ``spare``."""
    done = fill >= least
    large = np.flatnonzero(~done & (2 * fill > capacity))
    done[large[np.argsort(fill[large], kind="stable")[spare:]]] = True
    return done


def _bins(first_id: int, part: int, fill: np.ndarray, done: np.ndarray, lists: list[pa.Array]) -> list[pa.Array]:
    return [pa.array(np.arange(len(fill), dtype=np.int64) + first_id), pa.array(np.full(len(fill), part, np.int32)), pa.array(fill.astype(np.int32)), pa.array(done), *lists]


_NAMES = ["bin_id", "part", "fill", "done", "doc_ids", "starts", "lengths"]


def _local(capacity: int, least: int, spare: int, tokenizer: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), _counter(tokenizer)
        items: list[tuple] = []
        of = pa.int64()
        for batch in batches:
            of = batch.schema.field(0).type
            for i, n in zip(batch.column(0).to_pylist(), count(batch.column(1)).tolist()):
                for start in range(0, n, capacity):
                    items.append((i, start, min(capacity, n - start)))
        items.sort(key=lambda x: (-x[2], x[0] is None, x[0] if x[0] is not None else 0, x[1]))
        fit = BestFit(capacity)
        for x in items:
            fit.add(x[2], x)
        if fit.bins:
            fill = np.array(fit.fill, dtype=np.int64)
            at = pa.array(np.concatenate(([0], np.cumsum([len(b) for b in fit.bins]))).astype(np.int32))
            flat = [[x[k] for b in fit.bins for x in b] for k in range(3)]
            lists = [pa.ListArray.from_arrays(at, pa.array(v, t)) for v, t in zip(flat, (of, pa.int64(), pa.int32()))]
            yield pa.RecordBatch.from_arrays(_bins(part << 32, part, fill, _done(fill, capacity, least, spare), lists), names=_NAMES)

    return run


def _merge(capacity: int, least: int, spare: int, level: int, last: bool):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        fills, ids = rows.column("fill").to_numpy(), rows.column("bin_id").to_numpy()
        fit = BestFit(capacity)
        for i in np.lexsort((ids, -fills)).tolist():
            fit.add(int(fills[i]), i)
        part, fill = int(rows.column("__g")[0].as_py()), np.array(fit.fill, dtype=np.int64)
        order = pa.array([i for b in fit.bins for i in b], pa.int64())
        ends = np.cumsum([len(b) for b in fit.bins])
        lists = []
        for name in _NAMES[4:]:
            taken = rows.column(name).combine_chunks().take(order)
            taken = taken.chunk(0) if isinstance(taken, pa.ChunkedArray) else taken
            at = np.concatenate(([0], np.cumsum(pc.list_value_length(taken).to_numpy(zero_copy_only=False))))[np.concatenate(([0], ends))]
            lists.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), taken.flatten()))
        done = np.ones(len(fill), dtype=bool) if last else _done(fill, capacity, least, spare)
        return pa.Table.from_arrays(_bins((level << 56) | (part << 32), part, fill, done, lists), names=_NAMES)

    return run


def pack(docs: DataFrame, capacity: int = 2048, full: float = 0.98, fan_in: int = 16, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row a bin: bin_id, fill, n_items, and the lists doc_ids, starts and lengths of its pieces, in words."""
    ws, least, spare = Workspace(docs.sparkSession, "pack"), int(np.ceil(full * capacity)), SPARE * fan_in
    schema = _schema(kind(docs, doc_id).simpleString())
    now = ws.save(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")).mapInArrow(_local(capacity, least, spare, tokenizer), schema))
    out, level = [now.filter("done")], 0
    while True:
        level += 1
        left = now.filter("not done")
        two = [r.fill for r in left.select("fill").orderBy("fill").limit(2).collect()]
        if not two:
            break
        # a bin that doesn't fit the least other one fits none
        other = F.when(F.col("fill") == two[0], two[-1] if len(two) > 1 else capacity + 1).otherwise(two[0])
        dead = F.col("fill") + other > capacity
        out.append(left.filter(dead))
        left = left.filter(~dead)
        top = left.agg(F.max("part").alias("m")).first().m
        if top is None:
            break
        grouped = left.withColumn("__g", F.floor(F.col("part") / fan_in).cast("int")).groupBy("__g")
        now = ws.save(grouped.applyInArrow(_merge(capacity, least, spare, level, top < fan_in), schema))
        out.append(now.filter("done"))
    bins = functools.reduce(DataFrame.unionByName, out)
    return bins.select("bin_id", "fill", F.size("doc_ids").alias("n_items"), "doc_ids", "starts", "lengths")
