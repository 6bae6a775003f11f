"""A quality classifier: ridge regression on random Fourier features of document statistics, calibrated.

Every text gets statistics of its characters, words and lines. Standardised, they go through ``features`` random
Fourier features, which approximate a Gaussian kernel. Each partition of the labelled documents sums its part of the
normal equations; the parts are added in a tree and solved for ridge weights. On a fifth of the labelled documents,
held out by a hash of the id, isotonic regression (pool adjacent violators over the histogram of scores) turns scores
into probabilities. All labelled documents are used, and all documents are scored.

A standardised statistic counts as no more than 8 deviations, so that an outlier keeps its side and doesn't turn the cosines at random. Scores
are calibrated in 4,000 bins from -1 to 2 (labels are 0 and 1); those beyond have the probability of the outermost bin.

Null texts count as empty. Labelled rows with a null id or label are left out, labels of documents that don't
exist too; a document labelled several times counts each time; rows of one id are scored each by their own text.
Without labels of both classes nothing can be learned: score and probability are null and every row is kept. Ties in
score get one probability. Only id, text and label are looked at; ids are of any type.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.columns import col
from loomwork.llm.rules import _SALT, _per_text, repeated
from loomwork.llm.textkernels import chunks, encode, gram_hashes, spans, span_hashes
from loomwork.workspace import Workspace

NAMES = ("log_words", "log_chars", "word_length", "upper", "digit", "punctuation", "symbol", "non_ascii", "line_length", "lines_per_word", "unique_words", "capital_words", "dup_words3", "sentence_ends", "entropy", "long_words", "symbol_words")
_SETS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "punctuation": b".,;:!?'\"()-", "symbol": b"#$%&*|<>{}[]\\/^~@_=+`", "newline": b"\n"}
_IN = {k: np.isin(np.arange(256), list(v)) for k, v in _SETS.items()}
_BINS, _LOW, _HIGH = 4000, -1.0, 2.0


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of NAMES for each text."""
    out = np.zeros((len(texts), len(NAMES)))
    for a, b in chunks(texts, max_texts=1024):
        raw = np.frombuffer(b"\n".join(texts[a:b]) + b"\n", dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts[a:b]])
        at = np.concatenate(([0], ends))
        start, end = spans(raw, "space")
        bounds = np.concatenate(([0], np.searchsorted(start, ends)))
        words = np.diff(bounds)
        of = np.repeat(np.arange(b - a), words)
        share = {k: _per_text(t[raw], at) for k, t in _IN.items()}
        chars = np.maximum(_per_text((raw & 0xC0) != 0x80, at) - 1, 1)
        length = end - start
        w = np.maximum(words, 1)
        salt = of.astype(np.uint64) * _SALT
        h = span_hashes(raw, start, end)
        order = np.lexsort((h, of)) if len(h) else np.zeros(0, dtype=int)
        fresh = np.ones(len(h), dtype=bool)
        fresh[1:] = (h[order][1:] != h[order][:-1]) | (of[order][1:] != of[order][:-1])
        m = max(len(h) - 2, 0)
        grams = gram_hashes(h, 3)
        ok = of[:m] == of[2:] if m else np.zeros(0, dtype=bool)
        dup = np.zeros(len(h), dtype=bool)
        dup[np.flatnonzero(ok)[repeated(grams[ok] + salt[:m][ok])]] = True
        counts = np.bincount(np.repeat(np.arange(b - a), np.diff(at)) * 256 + raw, minlength=(b - a) * 256).reshape(b - a, 256).astype(float)
        p = counts / counts.sum(axis=1, keepdims=True)
        lines = share["newline"]
        stops = np.isin(raw, (46, 33, 63))
        symbolic = _IN["symbol"][raw[start]] | _IN["symbol"][raw[np.maximum(end - 1, 0)]] if len(start) else np.zeros(0, dtype=bool)
        out[a:b] = np.stack(
            [
                np.log1p(words), np.log1p(chars), _per_text(length, bounds) / w, share["upper"] / chars, share["digit"] / chars,
                share["punctuation"] / chars, share["symbol"] / chars, _per_text(raw > 127, at) / chars, np.log1p(chars / np.maximum(lines, 1)), lines / w,
                _per_text(fresh, bounds) / w, _per_text(_IN["upper"][raw[start]], bounds) / w, _per_text(dup, bounds) / w, _per_text(stops, at) / w,
                -(p * np.log(np.where(p > 0, p, 1))).sum(axis=1), _per_text(length > 15, bounds) / w, _per_text(symbolic, bounds) / w,
            ],
            axis=1,
        )
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray | None = None  # probability of each bin of the score

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate((np.sqrt(2 / len(self.phase)) * np.cos(z @ self.omega + self.phase), np.ones((len(x), 1))), axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.weights


def bin_of(score: np.ndarray) -> np.ndarray:
    return np.clip(((score - _LOW) / (_HIGH - _LOW) * _BINS).astype(int), 0, _BINS - 1)


def isotonic(hits: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The non-decreasing fit to hits / n, weighted by n, and for bins without rows linear between its neighbours."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(n):
        blocks.append([hits[i], n[i], i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            h, m, _, j = blocks.pop()
            blocks[-1][0] += h
            blocks[-1][1] += m
            blocks[-1][3] = j
    if not blocks:
        return np.full(len(n), np.nan)
    xs = np.array([x for b in blocks for x in (b[2], b[3])])
    ys = np.array([b[0] / b[1] for b in blocks for _ in (0, 1)])
    return np.interp(np.arange(len(n)), xs, ys)


def _vector(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, len(NAMES)), batch.column(1).to_numpy(zero_copy_only=False).astype(float)


def _sums(make):
    """A mapInArrow function that adds ``make`` (x, y) over a partition and emits one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = make(*_vector(batch))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.astype(np.float64).tobytes()], pa.binary())], names=["part", "s"])

    return run


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    total = sum(np.frombuffer(s, dtype=np.float64) for s in rows.s)
    return pd.DataFrame({"part": [int(rows.part.iloc[0]) // 16], "s": [total.tobytes()]})


def tree_sum(rows: DataFrame, make, ws: Workspace) -> np.ndarray | None:
    """The sum over all partitions, sixteen at a time, so that no task and no driver holds many parts."""
    now = ws.save(rows.mapInArrow(_sums(make), "part int, s binary"))
    while (n := now.count()) > 16:
        spread = now.withColumn("g", F.floor(F.col("part") / 16))
        now = ws.save(spread.groupBy("g").applyInPandas(lambda g: _add(g[["part", "s"]]), "part int, s binary"))
    if not n:
        return None
    return sum(np.frombuffer(r.s, dtype=np.float64) for r in now.orderBy("part").collect())


def fit(labelled: DataFrame, ws: Workspace, features: int = 256, gamma: float | None = None, ridge: float = 1e-3, seed: int = 11) -> Model | None:
    """``labelled`` has the columns x (statistics), y (0 or 1) and fold (0 for calibration)."""
    d = len(NAMES)
    train = labelled.filter("fold <> 0").select("x", "y")
    moments = tree_sum(train, lambda x, y: np.concatenate((x.sum(axis=0), (x * x).sum(axis=0), [len(x), y.sum()])), ws)
    if moments is None or moments[-1] in (0, moments[-2]):
        return None
    n = moments[-2]
    mean = moments[:d] / n
    scale = np.sqrt(np.maximum(moments[d : 2 * d] / n - mean**2, 1e-12))
    rng = np.random.default_rng(seed)
    model = Model(mean, scale, rng.standard_normal((d, features)) * np.sqrt(2 * (gamma or 0.5 / d)), rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1))

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.lift(x)
        return np.concatenate(((z.T @ z).ravel(), z.T @ y))

    sums = tree_sum(train, normal, ws)
    k = features + 1
    a = sums[: k * k].reshape(k, k) + ridge * n / k * np.eye(k)
    model.weights = np.linalg.solve(a, sums[k * k :])

    def histogram(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        b = bin_of(model.score(x))
        return np.concatenate((np.bincount(b, y, _BINS), np.bincount(b, minlength=_BINS)))

    held = tree_sum(labelled.filter("fold = 0").select("x", "y"), histogram, ws)
    held = held if held is not None else tree_sum(train, histogram, ws)
    model.knots = isotonic(held[:_BINS], held[_BINS:])
    return model


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = 0.5, **fitting) -> DataFrame:
    """Columns doc_id, score, probability, keep: one row for each row of ``docs``. The text is read once; statistics
    (a few numbers a document) are written to the shared folder, and only they are joined with the labels."""
    ws = Workspace(docs.sparkSession, "classifier")

    @F.pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series(list(statistics(encode(texts))))

    table = ws.save(docs.select(col(doc_id).alias("doc_id"), stats(col(text)).alias("x")))
    known = labels.select(col(doc_id).alias("doc_id"), col(label).cast("double").alias("y")).filter("doc_id is not null and y is not null")
    labelled = ws.save(table.join(known, "doc_id").select("x", "y", F.pmod(F.xxhash64("doc_id"), F.lit(5)).alias("fold")))
    model = fit(labelled, ws, **fitting)
    if model is None:
        none = F.lit(None).cast("double")
        return table.select("doc_id", none.alias("score"), none.alias("probability"), F.lit(True).alias("keep"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, probability double")
    def judge(x: pd.Series) -> pd.DataFrame:
        m = held.value
        s = m.score(np.stack(x.to_list())) if len(x) else np.zeros(0)
        return pd.DataFrame({"score": s.round(9), "probability": m.knots[bin_of(s)]})

    got = table.select("doc_id", judge("x").alias("j")).select("doc_id", "j.score", "j.probability")
    return got.withColumn("keep", F.col("probability") >= threshold)
