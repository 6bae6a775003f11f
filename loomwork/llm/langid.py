"""Language identification by nearest centroid, with rejection by distance.

A text becomes a TF-IDF vector of its letter n-grams (1 to 3 bytes of lower-cased UTF-8, everything that is no
letter being one space), hashed to ``dims`` features, with logarithmic term frequency, normalised to length 1.
Each language has several centroids, from spherical k-means over a bounded labelled sample. A text belongs to the
language of the nearest centroid by cosine and is rejected where its distance is more than ``slack`` times that within which 99 % of the
sample's texts of like length lie, measured against centroids that have not seen them (short texts lie farther from any centroid).

The bounded sample for fitting is about ``per_language`` texts of each of the ``max_languages`` most frequent labels, drawn by a hash of the text over
the whole table, each distinct text once. The table needs a column of labels, unless a model is given.

Null texts and texts without letters are rejected. Rows with a null label are not trained on; labels of fewer than
``min_docs`` texts are not learned. Ties go to the first language in alphabetical order. Repeated rows are judged
alike. Columns other than the text are passed through, whatever their names and types.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.columns import col
from loomwork.llm.textkernels import chunks, encode

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("cosine", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
_BUCKETS = 14


def gram_matrix(texts: list[bytes], dims: int) -> np.ndarray:
    """Counts of hashed letter n-grams, one row a text. Texts are lower-cased already."""
    out = np.zeros((len(texts), dims), dtype=np.float32)
    for a, b in chunks(texts, max_texts=256):
        raw = np.frombuffer(b"\n".join(texts[a:b]) + b"\n", dtype=np.uint8)
        of = np.repeat(np.arange(b - a), [len(t) + 1 for t in texts[a:b]])
        x = _FOLD[raw]
        keep = np.ones(len(x), dtype=bool)
        keep[1:] = (x[1:] != 32) | (x[:-1] != 32) | (of[1:] != of[:-1])
        x, of = x[keep].astype(np.uint32), of[keep]
        flat = np.zeros((b - a) * dims, dtype=np.int64)
        code = np.zeros(len(x), dtype=np.uint32)
        for n in (1, 2, 3):
            m = len(x) - n + 1
            if m <= 0:
                break
            code = (code[:m] << np.uint32(8)) | x[n - 1 :]
            ok = of[:m] == of[n - 1 :]
            if n == 1:
                ok &= x != 32
            h = ((code + np.uint32(n << 28)) * np.uint32(0x9E3779B1)) >> np.uint32(8)
            flat += np.bincount((of[:m] * dims + h % dims)[ok], minlength=len(flat))
        out[a:b] = flat.reshape(b - a, dims)
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(norm == 0, 1, norm)


def _bucket(grams: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(grams, 1)).astype(int), 0, _BUCKETS - 1)


@dataclass
class Model:
    dims: int
    languages: list[str]
    owner: np.ndarray  # the language of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray  # least cosine by length bucket

    def judge(self, texts) -> pd.DataFrame:
        encoded = encode(texts, lower=True)
        lang, cosine, rejected = [], [], []
        for a in range(0, len(encoded), 512):
            counts = gram_matrix(encoded[a : a + 512], self.dims)
            total = counts.sum(axis=1)
            sims = _unit(np.log1p(counts) * self.idf) @ self.centroids.T.astype(float) if len(self.owner) else np.zeros((len(counts), 0))
            best = sims.argmax(axis=1) if len(self.owner) else np.zeros(len(counts), dtype=int)
            top = sims[np.arange(len(sims)), best] if len(self.owner) else np.zeros(len(counts))
            who = self.owner[best] if len(self.owner) else np.zeros(len(counts), dtype=int)
            known = (total > 0) & (len(self.owner) > 0)
            lang += [self.languages[w] if k else None for w, k in zip(who, known)]
            cosine += np.where(known, top, np.nan).astype(float).tolist()
            rejected += (~known | (top < (self.floor[_bucket(total)] if len(self.owner) else 2))).tolist()
        return pd.DataFrame({"lang": pd.Series(lang, dtype=object), "cosine": pd.Series(cosine, dtype=float), "rejected": pd.Series(rejected, dtype=bool)})


def _centroids(v: np.ndarray, clusters: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means."""
    k = min(clusters, len(v))
    c = v[rng.choice(len(v), k, replace=False)]
    for _ in range(12):
        at = (v @ c.T).argmax(axis=1)
        c = _unit(np.stack([v[at == i].mean(axis=0) if (at == i).any() else c[i] for i in range(k)]))
    return c


def _floors(cos: np.ndarray, sizes: np.ndarray, slack: float) -> np.ndarray:
    """The least cosine by length bucket: one less ``slack`` times the distance that 99 % of the bucket's texts keep to. Buckets of fewer than
    50 texts take the next longer bucket's less 15 %, as shorter texts lie farther; the longest take the next shorter one's."""
    out = np.full(_BUCKETS, np.nan)
    limit = lambda near: max(0.0, 1 - slack * (1 - np.quantile(near, 0.01)))
    for b in range(_BUCKETS):
        if (sizes == b).sum() >= 50:
            out[b] = limit(cos[sizes == b])
    if np.isnan(out).all() and len(cos):
        out[int(np.median(sizes))] = limit(cos)
    for b in range(1, _BUCKETS):
        if np.isnan(out[b]):
            out[b] = out[b - 1]
    for b in reversed(range(_BUCKETS - 1)):
        if np.isnan(out[b]):
            out[b] = out[b + 1] * 0.85
    return out


def train(langs: list[str], texts: list[str], dims: int, clusters: int, min_docs: int, slack: float, seed: int) -> Model:
    order = np.argsort(np.array([f"{a}\0{b}" for a, b in zip(langs, texts)], dtype=object), kind="stable")  # whatever order the rows came in
    labels = np.array(langs, dtype=object)[order]
    counts = gram_matrix(encode([texts[i] for i in order], lower=True), dims)
    ok = counts.sum(axis=1) > 0
    labels, counts = labels[ok], counts[ok]
    names = sorted(x for x in set(labels) if (labels == x).sum() >= min_docs)
    n = len(labels)
    idf = (np.log((1 + n) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    v = _unit(np.log1p(counts) * idf)
    rng = np.random.default_rng(seed)
    owner, centroids = [], []
    distances, lengths = [np.zeros(0)], [np.zeros(0, dtype=int)]
    for j, name in enumerate(names):
        own = v[labels == name]
        sizes = _bucket(counts[labels == name].sum(axis=1))
        # distances of texts that centroids have not seen: four folds, each against centroids of the other three
        fold = np.arange(len(own)) % 4
        cos = np.zeros(len(own))
        for f in range(4):
            seen = own[fold != f] if (fold != f).any() else own
            cos[fold == f] = (own[fold == f] @ _centroids(seen, clusters, rng).T).max(axis=1) if (fold == f).any() else 0
        c = _centroids(own, clusters, rng)
        owner += [j] * len(c)
        centroids.append(c)
        distances.append(cos)
        lengths.append(sizes)
    floor = _floors(np.concatenate(distances), np.concatenate(lengths), slack)
    return Model(dims, names, np.array(owner, dtype=int), np.concatenate(centroids) if centroids else np.zeros((0, dims), np.float32), idf, floor)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 1000, dims: int = 2048, clusters: int = 4, min_docs: int = 5, slack: float = 1.4, seed: int = 7, max_languages: int = 1000) -> Model:
    """Learn centroids from about ``per_language`` distinct labelled texts of each language (all, where there are fewer),
    chosen by a hash of the text over the whole table. One task trains; only the model reaches the driver."""
    known = docs.select(col(lang).alias("l"), col(text).alias("t")).filter("l is not null and t is not null")
    counts = known.groupBy("l").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).orderBy(F.desc("n"), "l").limit(max_languages)
    sizes = {r.l: r.n for r in counts.collect()}
    share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, per_language / n))])[F.col("l")] if sizes else F.lit(0.0)
    # copies of a drawn text are drawn with it: they combine before they move
    drawn = known.withColumn("h", F.xxhash64("t", F.lit(seed))).filter(F.pmod("h", F.lit(1 << 24)) < share * (1 << 24))
    sample = drawn.groupBy("l", "h").agg(F.first("t").alias("t"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"m": [pickle.dumps(train(list(rows.l), list(rows.t), dims, clusters, min_docs, slack, seed))]})

    got = sample.groupBy(F.lit(0).alias("g")).applyInPandas(lambda rows: build(rows), "m binary").collect()
    return pickle.loads(got[0].m) if got else train([], [], dims, clusters, min_docs, slack, seed)


def judged(docs: DataFrame, model: Model, text: str = "text", out: str = "__lw_lang") -> DataFrame:
    """``docs`` with a struct column ``out``: lang, cosine, rejected. Only the text goes to Python."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        return held.value.judge(texts)

    return docs.withColumn(out, judge(col(text)))


def identify(docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **fitting) -> DataFrame:
    """Columns doc_id, lang, cosine, rejected, one row for each row of ``docs``."""
    model = model or fit(docs, text, lang, **fitting)
    got = judged(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")), model)
    return got.select("doc_id", F.col("__lw_lang.lang").alias("lang"), F.round("__lw_lang.cosine", 6).alias("cosine"), F.col("__lw_lang.rejected").alias("rejected"))


def keep_identified(docs: DataFrame, model: Model | None = None, text: str = "text", lang: str = "lang", **fitting) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns as they are."""
    model = model or fit(docs, text, lang, **fitting)
    return judged(docs, model, text).filter(~F.col("__lw_lang.rejected")).drop("__lw_lang")
