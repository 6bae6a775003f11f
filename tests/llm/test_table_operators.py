"""Mixing, packing, sharding, embeddings, WARC and the pipeline against brute force and the edge cases they declare."""

import gzip
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomwork.llm import embeddings, minhash, mixing, packing, sharding, warc
from loomwork.llm.settings import MIX

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    long = "alpha beta gamma delta " * 60_000
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (None, "one two three", "en", None, 13), (4, "one two three", "en", "a", 13), (4, "one two three", "en", "a", 13), (5, long, "en", "b", len(long)), (6, "word", "fr", "b", 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("bin_id", "fill", "epoch", "w", "cap", "node", "bytes", "d0", "__v", "part"):
        df = df.withColumn(c, F.lit("x"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- mixing ----


def brute_epochs(sizes, weights, budget, cap):
    """Clamp and redistribute until nothing changes."""
    live = {s for s, n in sizes.items() if n and weights[s]}
    want = int(sum(sizes.values()) * budget)
    clamped = set()
    while True:
        left = want - sum(cap * sizes[s] for s in clamped)
        free = live - clamped
        total = sum(weights[s] for s in free)
        share = {s: left * weights[s] / total for s in free} if total else {}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return {s: cap if s in clamped else share[s] / sizes[s] if s in share else 0 for s in sizes}
        clamped |= over


@pytest.mark.parametrize("seed", range(4))
def test_epochs_match_redistribution(spark, seed):
    r = random.Random(seed)
    sizes = {f"s{i}": r.choice([0, 1, 50, 400, 3000]) for i in range(12)}
    weights = {f"s{i}": r.choice([0, 1, 2, 9]) for i in range(12)}
    budget, cap = r.choice([0.3, 1.0, 2.5]), r.choice([1, 3])
    df = spark.createDataFrame([(i, "x" * n, "en", s, n) for i, (s, n) in enumerate(sizes.items())], SCHEMA)
    got = {x.source: x.epochs for x in mixing.epochs(df, weights, 1, budget, cap).collect()}
    want = brute_epochs(sizes, weights, budget, cap)
    assert got == pytest.approx(want)


def test_mix_repeats_whole_and_fractional(docs):
    got = Counter(r.doc_id for r in mixing.mix(docs, **MIX).collect())
    e = {r.source: r.epochs for r in mixing.epochs(docs, **{k: v for k, v in MIX.items() if k != "seed"}).collect()}
    for r in docs.collect():
        assert got[r.doc_id] in (int(e[r.source]), int(e[r.source]) + 1)
    again = Counter(r.doc_id for r in mixing.mix(docs.repartition(5), **MIX).collect())
    other = Counter(r.doc_id for r in mixing.mix(docs, **{**MIX, "seed": 3}).collect())
    assert got == again and got != other


def test_the_rate_of_fractional_draws(spark):
    """Of 4,000 documents of a source with 1.4 epochs about 40 % come twice, and the copies keep every column."""
    df = spark.range(4000).select(F.col("id").alias("my.id"), F.lit("ten chars!").alias("t.t"), F.lit("a").alias("s.s"), F.create_map(F.lit(1), F.lit(2)).alias("m"))
    got = mixing.mix(df, {"a": 1}, budget=1.4, max_epochs=2, source="s.s", text="t.t", doc_id="my.id")
    assert got.columns == df.columns
    n = Counter(r["my.id"] for r in got.collect())
    assert set(n.values()) == {1, 2} and abs(sum(c == 2 for c in n.values()) / 4000 - 0.4) < 0.03


def test_mix_of_odd_rows(spark, odd):
    got = mixing.mix(odd, {"a": 1, "b": 1}, default_weight=1, budget=1.0, max_epochs=2)
    assert got.columns == odd.columns
    ids = Counter(r.doc_id for r in got.collect())
    assert ids[4] in (2, 4) and set(ids) <= {1, 2, 3, 4, 5, 6, None}
    assert mixing.mix(empty(spark), {}).count() == 0
    assert mixing.mix(odd, {"a": 1, "b": 1}, epoch="pass").columns == [*odd.columns, "pass"]


# ---- packing ----


def check_bins(bins, want, capacity):
    seen = Counter()
    for b in bins:
        assert b.fill == sum(b.lengths) <= capacity and b.n_items == len(b.doc_ids)
        seen.update(zip(b.doc_ids, b.starts, b.lengths))
    assert seen == want
    assert len({b.bin_id for b in bins}) == len(bins)


def pieces(rows, capacity):
    out = Counter()
    for r in rows:
        n = len((r.text or "").split())  # no unspaced scripts in these
        out.update((r.doc_id, s, min(capacity, n - s)) for s in range(0, n, capacity))
    return out


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_packing_places_every_piece_once(docs, parts):
    bins = packing.pack(docs.repartition(parts), capacity=300, fan_in=4).collect()
    want = pieces(docs.collect(), 300)
    check_bins(bins, want, 300)
    least = -(-sum(n for (_, _, n), c in want.items() for _ in range(c)) // 300)
    assert len(bins) <= 1.1 * least + 2  # bins merge whole, so parts of five documents each leave some room
    assert sum(b.fill < 150 for b in bins) <= 1


def test_packing_of_odd_rows(spark, odd):
    bins = packing.pack(odd, capacity=1000).collect()
    check_bins(bins, pieces(odd.collect(), 1000), 1000)
    assert packing.pack(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, 0), (2, " ", None, None, 1)], SCHEMA)
    assert packing.pack(blank).count() == 0


def test_words_do_not_run_over_the_border_of_texts(spark):
    import pyarrow as pa

    from tests.llm.test_text_operators import plain_words

    texts = ["a b", "c", "", None, "d ", " e", "é ü", "x" * 10, "漢字", "字x", "x字", "ไทย", "𠀀"] * 100
    random.Random(1).shuffle(texts)
    assert packing._word_counts(pa.array(texts)).tolist() == [len(plain_words(t)) for t in texts]
    assert packing._word_counts(pa.array(texts)[5:50]).tolist() == [len(plain_words(t)) for t in texts[5:50]]


def test_bins_that_fit_nothing_leave_where_they_are(spark):
    """Documents of 60 % of the capacity can't share a bin: they leave from many tasks, and so do nearly all with a few small ones among them."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 60).alias("text")).repartition(16)
    bins = packing.pack(df, capacity=100, fan_in=4).collect()
    assert len(bins) == 4000 and {b.bin_id >> 56 for b in bins} == {0} and len({b.bin_id >> 32 for b in bins}) == 16
    few = spark.range(4000, 4003).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 30).alias("text"))
    bins = packing.pack(df.unionByName(few), capacity=100, fan_in=4).collect()
    assert len(bins) in (4000, 4001) and sum(b.n_items for b in bins) == 4003  # the small ones may share a bin
    level = Counter(b.bin_id >> 32 for b in bins)
    assert max(n for k, n in level.items() if k >> 24) <= 4 * (packing.SPARE * 4 + 1)


def test_packing_of_string_ids(spark):
    rows = [("b", "one two three"), (None, "one two"), ("a", "x"), ("b", "one two three")]
    bins = packing.pack(spark.createDataFrame(rows, "`my.id` string, `t.t` string").repartition(3), capacity=4, doc_id="my.id", text="t.t").collect()
    assert Counter(i for b in bins for i in b.doc_ids) == Counter(["a", "b", "b", None]) and all(b.fill <= 4 for b in bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_is_best_fit(sizes):
    fit, fills = packing.BestFit(50), []
    for i, s in enumerate(sizes):
        fit.add(s, i)
        room = [f for f in fills if f + s <= 50]
        if room:
            fills[fills.index(max(room))] += s
        else:
            fills.append(s)
    assert sorted(fit.fill) == sorted(fills)


def test_packing_by_tokens(docs):
    bins = packing.pack(docs.limit(20), capacity=500, tokenizer="/opt/tokenizers/byte_bpe_50k.json").collect()
    assert bins and all(b.fill <= 500 for b in bins)


# ---- sharding ----


def brute_shards(rows, target):
    """rows: (key, bytes, point); node number of each key."""
    dims = range(4)
    spread = [max(p[d] for *_, p in rows) - min(p[d] for *_, p in rows) or 1.0 for d in dims]
    out = {}

    def split(node, own):
        weight = sum(b for _, b, _ in own)
        width = [(max(p[d] for *_, p in own) - min(p[d] for *_, p in own)) / spread[d] for d in dims]
        if weight <= target or max(width) == 0:
            out.update({k: node for k, *_ in own})
            return
        d = width.index(max(width))
        run = 0
        for v, b in sorted((p[d], b) for _, b, p in own):
            run += b
            if run >= weight / 2:
                cut = v
                break
        top = cut == max(p[d] for *_, p in own)
        right = lambda p: p[d] >= cut if top else p[d] > cut
        split(node * 2, [x for x in own if not right(x[2])])
        split(node * 2 + 1, [x for x in own if right(x[2])])

    split(1, rows)
    return out


def test_shards_match_brute_force(spark, docs):
    own = docs.collect()
    rank = lambda values: {v: i for i, v in enumerate(sorted(set(values) - {None}), 1)} | {None: 0}
    ranks = [rank(getattr(r, c) for r in own) for c in ("source", "lang", "doc_id")]
    rows = [(r.doc_id, len((r.text or "").encode()), (ranks[0][r.source], ranks[1][r.lang], math.log2(1 + len(r.text or "")), ranks[2][r.doc_id])) for r in own]
    want = brute_shards(rows, 20_000)
    got = sharding.shard(docs, 20_000, bins=16).collect()
    assert {r.doc_id: r.shard for r in got} == want
    for most in (60, 1):  # some levels distributed, all of them
        assert {r.doc_id: r.shard for r in sharding.shard(docs, 20_000, bins=16, task_rows=most).collect()} == want
    sizes = Counter()
    for r in docs.collect():
        sizes[want[r.doc_id]] += len(r.text.encode())
    assert all(sizes[r.shard] == r.shard_bytes and r.oversize == (r.shard_bytes > 20_000) for r in got)
    assert len(sizes) > 15 and {r.doc_id: r.shard for r in sharding.shard(docs.repartition(7), 20_000).collect()} == want


def test_ids_of_shards(spark):
    """String ids; numbers beyond the precision of a double; a null id beside them."""
    text = "x" * 100
    rows = [(2**53, text), (2**53 + 1, text), (None, text), (0, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"source": F.lit("s"), "lang": F.lit("l")})
    assert len({r.shard for r in sharding.shard(df, 100).collect()}) == 4
    named = df.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert len({(r.doc_id, r.shard) for r in sharding.shard(named.withColumnRenamed("doc_id", "a.b"), 100, doc_id="a.b").collect()}) == 4


def test_shards_of_odd_rows(spark, odd, tmp_path):
    got = sharding.shard(odd, 100).collect()
    assert len(got) == 8
    by = {r.doc_id: r for r in got}
    assert by[5].oversize and not by[1].oversize
    assert len({r.shard for r in got if r.doc_id == 4}) == 1
    same = spark.createDataFrame([(1, "abc" * 50, "en", "a", 1)] * 5, SCHEMA)
    assert {(r.shard, r.oversize) for r in sharding.shard(same, 100).collect()} == {(1, True)}
    assert sharding.shard(empty(spark)).count() == 0
    blank = spark.createDataFrame([(i, None, "en", "a", 1) for i in range(3)], SCHEMA)
    assert {r.shard for r in sharding.shard(blank, 1).collect()} == {1}
    sharding.write_shards(odd.filter("doc_id <> 4").select(SCHEMA.replace(" long", "").replace(" string", "").split(", ")), str(tmp_path / "s"), target_bytes=100)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 5


# ---- embeddings ----


def planted(seed=0, n=600, d=48, groups=((40, 0.05), (3, 0.1), (2, 0.3))):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    out = [v / np.linalg.norm(v) for v in x]
    for size, noise in groups:
        for _ in range(6):
            c = rng.standard_normal(d)
            c /= np.linalg.norm(c)
            for _ in range(size):
                g = rng.standard_normal(d)
                out.append(c + noise * g / np.linalg.norm(g))
    return np.array(out)


def cosines(spark, x, **params):
    """Groups found, and those of all pairs by a matrix product."""
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    root = list(range(len(u)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(0, len(u), 1000):
        for a, b in zip(*np.nonzero(u[i : i + 1000] @ u.T >= 0.9)):
            if i + a < b:
                root[max(find(i + a), find(b))] = min(find(i + a), find(b))
    near = embeddings.NearEmbeddings(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), **params)
    got = {r.vec_id: r.group_id for r in near.groups.collect()}
    return near, [got[i] for i in range(len(u))], [find(i) for i in range(len(u))]


def test_groups_at_three_hashes(spark):
    """20,000 vectors, three hashes a table: few vectors a bucket, and large groups of copies whose buckets are hot."""
    x = planted(7, 18_000, 48, ((300, 0.1), (3, 0.1), (2, 0.3)))
    near, got, want = cosines(spark, x, per_bucket=0.1)
    assert near.k == 3
    assert np.mean([g == w for g, w in zip(got, want)]) >= 0.99 and len(set(got)) <= 1.002 * len(set(want))
    near, got, want = cosines(spark, x)
    assert near.k == 2 and np.mean([g == w for g, w in zip(got, want)]) >= 0.99


def test_vectors_with_string_ids(spark):
    df = spark.createDataFrame([("b", [1.0, 2.0]), ("a", [2.0, 4.0]), (None, [1.0, 2.0]), ("c", [-1.0, 2.0])], "`v.id` string, `e.e` array<float>").withColumn("m.m", F.create_map(F.lit(1), F.lit(2)))
    got = {r.vec_id: (r.group_id, r.group_size, r.keep) for r in embeddings.near_embeddings(df, vec_id="v.id", embedding="e.e").collect()}
    assert got == {"a": ("a", 3, True), "b": ("a", 3, False), None: ("a", 3, False), "c": ("c", 1, True)}


@pytest.mark.parametrize("most", [32, 2])
def test_recall_against_brute_force(spark, most):
    x = planted()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    want = {(i, j) for i in range(len(u)) for j in range(i + 1, len(u)) if s[i, j] >= 0.9}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    near = embeddings.NearEmbeddings(df, most=most)
    ids = {r.vh: r.vec_id for r in near.groups.collect()}
    found = {tuple(sorted((ids[r.a], ids[r.z]))) for r in near.all_pairs().collect()}
    assert found <= {tuple(p) for p in want} | {p for p in found if abs(s[p] - 0.9) < 1e-6}
    assert len(found & want) >= 0.9 * len(want)
    root = list(range(len(u)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in want:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.vec_id: r for r in near.groups.collect()}
    assert np.mean([got[i].group_id == find(i) for i in range(len(u))]) >= 0.98
    assert sum(r.keep for r in got.values()) == len({r.group_id for r in got.values()})


def test_recall_of_wide_vectors(spark):
    """1024 dimensions and three hashes: eight tables would find about 0.6 of the pairs at a cosine of 0.9."""
    r = np.random.default_rng(3)
    x, z = r.standard_normal((2, 200, 1024))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (x * z).sum(axis=1, keepdims=True) * x
    y = 0.9001 * x + np.sqrt(1 - 0.9001**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))], "vec_id long, embedding array<double>")
    near = embeddings.NearEmbeddings(df, per_bucket=1e-5)
    assert near.k == 3 and near.tables > 8
    got = {r.vec_id: r.group_id for r in near.groups.collect()}
    assert sum(got[200 + i] == i for i in range(200)) >= 0.93 * 200


def test_hadamard_of_many_coordinates():
    y = np.eye(1024, dtype=np.float32)[[0, 5, 900]]
    h = np.array([[1.0]])
    while len(h) < 1024:
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(embeddings.hadamard(y), y @ h / 32, atol=1e-6)


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).standard_normal((5, 16))
    y = embeddings.hadamard(x)
    h = np.array([[1.0]])
    while len(h) < 16:
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(y, x @ h / 4) and np.allclose(np.linalg.norm(y, axis=1), np.linalg.norm(x, axis=1))


def test_embeddings_of_odd_rows(spark):
    e = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]), (None, e), (6, e), (6, e), (7, [2.0, 4.0, 6.0]), (8, [3.0, -1.0, 0.5, 9.0]), (9, [float("inf"), 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit("x")).withColumn("e", F.lit(1))
    got = {r.vec_id: r for r in embeddings.near_embeddings(df).collect()}
    assert len(got) == 10
    assert got[6].keep and got[6].group_size == 4 and not got[7].keep and got[7].group_id == 6 and not got[None].keep
    assert all(got[i].keep and got[i].group_id == i for i in (1, 2, 3, 4, 5, 8, 9))
    assert embeddings.near_embeddings(df.limit(0)).count() == 0


# ---- WARC ----


def test_round_trip_of_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = warc.pages_of(warc.archived(pages).repartition(5)).collect()
    want = {r.page_id: r for r in pages.collect()}
    assert len(got) == len(want) and max(r.segments for r in got) > 1
    assert all(r.status == "ok" and r.html == want[r.page_id].html and r.url == want[r.page_id].url for r in got)


@pytest.mark.parametrize("compress", [False, True])
def test_files_are_read(spark, sf, tmp_path, compress):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [tuple(r) for r in warc.archived(pages).collect()]
    random.Random(1).shuffle(rows)
    for i in range(3):
        info = ("urn:info", "warcinfo", None, None, None, None, b"software: test")
        (tmp_path / f"{i}.warc").write_bytes(warc.serialised([info, *rows[i::3]], compress))
    got = warc.pages_of(warc.read_warc(spark, str(tmp_path))).collect()
    want = {r.page_id: r.html for r in pages.collect()}
    assert {r.page_id: r.html for r in got} == want


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=600), st.integers(1, 50), st.integers(1, 80))
def test_chunks_and_segments_round_trip(body, chunk, size):
    assert warc.dechunked(warc.chunked(body, chunk)) == body
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    rows = warc.segments("r", "u", head + warc.chunked(body, chunk), size)
    random.Random(len(body)).shuffle(rows)
    status, block = warc.joined([(r[3], r[5], r[6]) for r in rows])
    assert status == "ok" and warc.decoded(block) == ("ok", 200, None, body)


def test_statuses(spark):
    ok = b"HTTP/1.1 200 OK\r\nContent-Type: a/b\r\n\r\nbody"
    gz = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(gzip.compress(b"zip"), 7)
    rows = [
        ("whole", "response", "u", None, None, None, ok), ("gz", "response", "u", None, None, None, gz), ("info", "warcinfo", None, None, None, None, b"x"),
        ("a", "response", "u", 1, None, None, ok[:20]), ("a2", "continuation", "u", 2, "a", len(ok), ok[20:]), ("a2", "continuation", "u", 2, "a", len(ok), ok[20:]),
        ("b", "response", "u", 1, None, None, ok[:20]), ("b3", "continuation", "u", 3, "b", len(ok), ok[20:]),
        ("c", "response", "u", 1, None, None, ok[:20]), ("c2", "continuation", "u", 2, "c", 30, ok[20:]),
        ("d", "response", "u", 1, None, None, ok[:20]), ("d2", "continuation", "u", 2, "d", len(ok), b"x"), ("d2", "continuation", "u", 2, "d", len(ok), b"y"),
        ("e2", "continuation", "u", 2, "e", len(ok), ok[20:]), ("f", "response", "u", 1, None, None, ok[:20]), ("f2", "continuation", "u", 2, "f", None, ok[20:]),
        ("g", "response", "u", None, None, None, b"nonsense"), ("h", "response", "u", None, None, None, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nab"),
        ("i", "response", "u", None, None, None, b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\nno"), ("j", "response", None, None, None, None, None), (None, "response", None, 1, None, 3, b"abc"), (None, "response", None, 1, None, None, b"abc"),
        ("k", "response", "u", 1, None, len(ok) + 5, ok),
    ]
    df = spark.createDataFrame(rows, warc.RECORD).withColumn("parts", F.lit("x")).withColumn("status", F.lit(1))
    got = warc.reassembled(df).collect()
    by = {r.record_id: r.status for r in got if r.record_id}
    assert by == {"whole": "ok", "gz": "ok", "a": "ok", "b": "incomplete", "c": "length_mismatch", "d": "conflict", "e": "incomplete", "f": "incomplete", "g": "bad_http", "h": "bad_chunk", "i": "bad_coding", "j": "incomplete", "k": "incomplete"}
    assert sum(r.record_id is None for r in got) == 2
    assert {bytes(r.body) for r in got if r.status == "ok"} == {b"body", b"zip"} and all(r.body is None for r in got if r.status != "ok")
    assert warc.reassembled(df.limit(0)).count() == 0


def test_pages_of_odd_rows(spark):
    rows = [(1, None, None), (2, None, ""), (None, "u", "<p>x</p>"), (3, "v", "é" * 300_000), (3, "v", "é" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("block", F.lit("x"))
    got = warc.pages_of(warc.archived(df)).collect()
    assert {(r.page_id, r.html) for r in got} == {(2, ""), (None, "<p>x</p>"), (3, "é" * 300_000)}
    assert all(r.status == "ok" for r in got)


def test_every_way_to_spoil_a_record(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").withColumn("page_id", F.col("page_id") * 10)
    got = warc.pages_of(warc.archived(pages, damaged=True).repartition(5)).collect()
    html = {r.page_id: r.html for r in pages.collect()}
    assert len(got) == 2 * len(html)
    for r in got:
        how = warc.SPOILT[r.page_id // 10 % len(warc.SPOILT)]
        assert (r.status == "ok" and r.html == html[r.page_id]) or (r.status == how[1] and r.html is None)
    assert {r.status for r in got} == {"ok", *(s for _, s in warc.SPOILT)}


def test_pages_with_string_ids(spark):
    df = spark.createDataFrame([("a:b\n.c", "u", "<p>x</p>"), ("", None, "y"), (None, "v", "z")], "`p.id` string, url string, html string")
    got = warc.pages_of(warc.archived(df, page_id="p.id"), "string").collect()
    assert {(r.page_id, r.html) for r in got} == {("a:b\n.c", "<p>x</p>"), (None, "y"), (None, "z")}


@pytest.mark.parametrize("compress", [False, True])
def test_reading_holds_no_file(compress):
    """Of a file of 30 MB the parser holds a few."""
    import io
    import tracemalloc

    rows = [(f"r{i}", "response", "u", None, None, None, random.Random(i).randbytes(30_000)) for i in range(1000)]
    source = io.BytesIO(warc.serialised(rows, compress))
    tracemalloc.start()
    assert sum(len(r[-1]) for r in warc.parsed(source)) == 30_000_000
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 << 20


def test_parser_of_broken_files():
    good = warc.serialised([("r", "response", "u", None, None, None, b"abc")])
    assert list(warc.parsed(good)) == [("r", "response", "u", None, None, None, b"abc")]
    assert list(warc.parsed(good[:-6]))[0][-1] is None
    assert list(warc.parsed(b"")) == [] and list(warc.parsed(b"junk")) == []


# ---- queries and pipeline ----


def test_queries_match_sql(spark, sf):
    from loomwork.llm import queries

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, sql in queries.SQL.items():
        got, want = queries.QUERIES[name](spark, sf).toPandas(), con.execute(sql).df()
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols
        a, b = (sorted(map(repr, x[cols].astype(object).itertuples(index=False, name=None))) for x in (got, want))
        assert a == b, name


def test_pipeline_stages(spark, sf):
    import corpus_pipeline
    from loomwork.llm import pii
    from tests.llm.test_text_operators import brute_groups

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "MinHash near-dedup", "PII", "mixing", "best-fit packing"]
    known = stages["language ID"](spark, docs, sf).cache()
    assert known.columns == docs.columns and known.count() >= 0.98 * docs.count()
    one = stages["MinHash near-dedup"](spark, known, sf).cache()
    rows = known.orderBy("doc_id").collect()
    groups = brute_groups([r.text for r in rows], 3, 0.6)
    assert {r.doc_id for r in one.collect()} == {rows[g].doc_id for g in groups}
    clean = stages["PII"](spark, one, sf).cache()
    assert clean.columns == docs.columns
    before = {r.doc_id: r.text for r in one.collect()}
    for r in clean.collect():
        assert r.n_chars == len(r.text) and all(before[r.doc_id][a:b] not in r.text for a, b, *_ in pii.find(before[r.doc_id]))
    mixed = stages["mixing"](spark, clean, sf).cache()
    assert mixed.columns == docs.columns
    bins = stages["best-fit packing"](spark, mixed, sf).collect()
    check_bins(bins, pieces(mixed.collect(), 2048), 2048)
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sum(b.fill for b in whole) == sum(b.fill for b in bins)


def test_pipeline_of_nothing_and_of_odd_rows(spark, sf, odd, docs):
    import corpus_pipeline

    nothing = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, sf)
    assert nothing.collect() == []
    left = {}
    df = docs.unionByName(odd.select(docs.columns).withColumn("doc_id", F.col("doc_id") + 10**6))
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, sf).cache()
        left[name] = df.collect()
    ids = {n: Counter(r.doc_id for r in rows) for n, rows in left.items() if n != "best-fit packing"}
    texts = lambda name: {r.text for r in left[name]}
    assert not {None, "", " \n\t "} & texts("language ID")  # nothing to tell the language by
    assert set(ids["MinHash near-dedup"].values()) == {1} and set(ids["MinHash near-dedup"]) <= set(ids["language ID"])
    assert ids["PII"] == ids["MinHash near-dedup"] and all(r.n_chars == len(r.text) for r in left["PII"])
    assert set(ids["mixing"]) <= set(ids["PII"]) and max(ids["mixing"].values()) <= 2
    check_bins(left["best-fit packing"], pieces(left["mixing"], 2048), 2048)


def test_pipeline_stages_pass_other_columns(spark, sf, docs):
    """Names with dots, and types that can't be compared."""
    import corpus_pipeline

    df = docs.withColumn("a.b", F.lit(1)).withColumn("m", F.create_map(F.lit("k"), F.lit("v"))).unionByName(docs.limit(20).withColumn("a.b", F.lit(2)).withColumn("m", F.create_map(F.lit("k"), F.lit("w"))))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, sf)
        assert out.columns == df.columns, name
        df = out
    assert df.count() > 100


def test_minhash_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a b c d", "en", s, None) for s in ("x", None, "x")] + [(2, "a b c d", "en", "x", 1), (3, None, None, None, None)]
    got = minhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.doc_id for r in got) == [1, 3]
