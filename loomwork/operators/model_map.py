"""Row-wise calls of a model behind an injected client: rate limits, retries, resumption.

Each task runs one event loop. The limits of the whole job are divided by the number of concurrent tasks. A row that
fails for good is returned with its status, not left out. Spark may run a task twice, so a client should be idempotent by key; turn
speculation off.
"""

from __future__ import annotations

import asyncio
import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.workspace import Workspace

#: Records that the two classification passes return.
ASSESSMENT = "is_about boolean, target_code string, subsidiary_code string, is_relevant boolean, stage string, reasoning string"
REGION = "code string, relevant boolean"
EXTRACTION = "target string, disposal string, disposal_company string, relevant boolean, interest_score int, rationale string"
ENRICHMENT = "group_name string, disposal_company string, group_hq string, group_industry string, group_vertical string, disposal_country string, disposal_industry string, disposal_vertical string"

#: Neutral prompt texts; a deployment passes its own.
PROMPTS = {
    "assess": "Given the request: {business_request}\nToday is {current_date}. Decide whether the article announces a future sale of a business unit, and name the parties by code.\nTitle: {article_title}\nBody: {article_body}\nCodes: {company_codes}",
    "extract": "Given the request: {business_request}\nToday is {current_date}. Extract the owner, the unit for sale and a score from 1 to 5.\nBody: {article_body}",
    "enrich": "Find the parent group, head office and industry of {target}. Search results: {search_results}",
    "region": "Does the code {code} ({description}) denote a place in the region {region}?",
}


@dataclass(frozen=True)
class Limits:
    requests_per_minute: int = 1000
    tokens_per_minute: int = 1_000_000
    concurrency: int = 20
    retries: int = 5
    first_delay: float = 3.0
    jitter: float = 0.2
    timeout: float | None = 120.0  # seconds of one call; a call beyond it counts as failed and is tried again

    def tasks(self, wanted: int) -> int:
        """How many of ``wanted`` tasks can run at once if each is to have a request a minute, a token and one call at a time."""
        return max(1, min(wanted, self.requests_per_minute, self.tokens_per_minute, self.concurrency))

    def share(self, tasks: int) -> Limits:
        """The part of one of ``tasks`` concurrent tasks, rounded down: together they stay within the limits, if they are no more than
        ``self.tasks`` allows."""
        n = max(1, tasks)
        return replace(self, requests_per_minute=max(1, self.requests_per_minute // n), tokens_per_minute=max(1, self.tokens_per_minute // n), concurrency=max(1, self.concurrency // n))


class Bucket:
    """A token bucket of ``per_minute`` units."""

    def __init__(self, per_minute: int, clock: Callable[[], float] = time.monotonic):
        self.rate, self.most, self.level, self.clock = per_minute / 60, float(per_minute), float(per_minute), clock
        self.at = clock()

    async def take(self, n: float) -> None:
        n = min(n, self.most)
        while True:
            now = self.clock()
            self.level, self.at = min(self.most, self.level + (now - self.at) * self.rate), now
            if self.level >= n:
                self.level -= n
                return
            await asyncio.sleep(min(1.0, (n - self.level) / self.rate))


def delays(limits: Limits, seed: int = 0) -> Iterator[float]:
    """Waits before each retry: doubling, with jitter."""
    r = random.Random(seed)
    for i in range(limits.retries - 1):
        yield limits.first_delay * 2**i * (1 + limits.jitter * (2 * r.random() - 1))


def retry(f: Callable, attempts: int = 4, first_delay: float = 1.0, jitter: float = 0.2, sleep: Callable[[float], None] = time.sleep):
    """``f`` called again after an error, up to ``attempts`` times in all."""

    def run(*args, **kw):
        waits = delays(Limits(retries=attempts, first_delay=first_delay, jitter=jitter))
        while True:
            try:
                return f(*args, **kw)
            except Exception:
                wait = next(waits, None)
                if wait is None:
                    raise
                sleep(wait)

    return run


async def call_all(rows: list[dict], client, limits: Limits, estimate: Callable[[dict], int], buckets: tuple[Bucket, Bucket] | None = None) -> list[tuple[dict | None, str, int, str | None]]:
    """(record, status, attempts, error) of each row in order. ``client`` is an async function of a row that returns a
    record, or a record and the number of requests the provider still allows, which widens or narrows the concurrency. ``buckets`` of requests
    and tokens outlive the call, so that a task that calls for one batch after another keeps to its limits over all of them."""
    requests, tokens_ = buckets or (Bucket(limits.requests_per_minute), Bucket(limits.tokens_per_minute))
    gate, out, width = asyncio.Condition(), [None] * len(rows), [limits.concurrency]
    running = [0]

    async def one(i: int) -> None:
        async with gate:
            await gate.wait_for(lambda: running[0] < width[0])
            running[0] += 1
        try:
            waits, attempts = delays(limits, i), 0
            while True:
                attempts += 1
                try:
                    await requests.take(1)
                    await tokens_.take(estimate(rows[i]))
                    got = await asyncio.wait_for(client(rows[i]), limits.timeout)
                    if isinstance(got, tuple):
                        got, remaining = got
                        width[0] = max(1, min(limits.concurrency, remaining))
                    out[i] = (got, "ok", attempts, None)
                    return
                except Exception as e:
                    wait = next(waits, None)
                    if wait is None:
                        out[i] = (None, "failed", attempts, f"{type(e).__name__}: {e}")
                        return
                    await asyncio.sleep(wait)
        finally:
            async with gate:
                running[0] -= 1
                gate.notify_all()

    await asyncio.gather(*(one(i) for i in range(len(rows))))
    return out


def map_rows(df: DataFrame, make_client: Callable[[], Callable], schema: str, key: str, columns: dict[str, str] | None = None, constants: dict[str, str] | None = None, keep: dict[str, str] | None = None, limits: Limits = Limits(), tasks: int | None = None, estimate: Callable[[dict], int] | None = None) -> DataFrame:
    """key, kept columns, the fields of ``schema``, status, attempts, error: one row for each row of ``df``.

    ``columns`` renames columns to the input names of the client; ``constants`` are added, and current_date. The
    job runs in ``tasks`` partitions (default: as many as the cluster runs at once), but no more than the limits can be shared among, each
    with its share of them."""
    spark = df.sparkSession
    tasks = limits.tasks(tasks or spark.sparkContext.defaultParallelism)
    own = limits.share(tasks)
    estimate = estimate or (lambda row: sum(len(str(v)) for v in row.values()) // 4 + 1)
    names = columns or {c: c for c in df.columns if c != key}
    constants, keep = dict(constants or {}), keep or {}
    record = T._parse_datatype_string(schema)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    fields = [T.StructField(key, kinds[key])] + [T.StructField(b, kinds[a]) for a, b in keep.items()] + record.fields + [T.StructField("status", T.StringType()), T.StructField("attempts", T.IntegerType()), T.StructField("error", T.StringType())]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, buckets = make_client(), (Bucket(own.requests_per_minute), Bucket(own.tokens_per_minute))
        for pdf in batches:
            raw = pdf.astype(object).where(pdf.notna(), None).to_dict("records")
            today = time.strftime("%Y-%m-%d")
            rows = [{b: r[a] for a, b in names.items()} | {"current_date": today, key: r[key]} | constants for r in raw]
            got = asyncio.run(call_all(rows, client, own, estimate, buckets))
            out = []
            for r, (rec, status, attempts, error) in zip(raw, got):
                rec = rec.model_dump() if hasattr(rec, "model_dump") else (rec or {})
                out.append({key: r[key]} | {b: r[a] for a, b in keep.items()} | {f.name: rec.get(f.name) for f in record.fields} | {"status": status, "attempts": attempts, "error": error})
            frame = pd.DataFrame(out, columns=[f.name for f in fields]).astype(object)
            yield frame.where(frame.notna(), None)

    return df.repartition(tasks).mapInPandas(run, T.StructType(fields))


def map_resumable(df: DataFrame, path: str, make_client, schema: str, key: str, chunk: int = 5000, **params) -> DataFrame:
    """``map_rows`` with results appended to Parquet under ``path``, chunk by chunk; rows already there with status ok are
    not called again. Returns the results of the rows of ``df``. The rows to call are written once, a folder a chunk, so a chunk reads itself alone."""
    spark, ws = df.sparkSession, Workspace(df.sparkSession, "calls")
    done = _done(spark, path, key)
    left = df if done is None else df.join(done, key, "left_anti")
    n = left.count()
    parts = max(1, -(-n // chunk))
    if n:
        left.withColumn("__chunk", F.pmod(F.xxhash64(key), F.lit(parts))).repartition("__chunk").write.partitionBy("__chunk").parquet(f"{ws.path}/rows")
        waiting = spark.read.schema(T.StructType([*left.schema.fields, T.StructField("__chunk", T.LongType())])).parquet(f"{ws.path}/rows")
        for i in range(parts):
            map_rows(waiting.filter(F.col("__chunk") == i).drop("__chunk"), make_client, schema, key, **params).write.mode("append").parquet(path)
    ws.close()
    found = spark.read.parquet(path).join(df.select(key), key, "left_semi") if n or done is not None else map_rows(df.limit(0), make_client, schema, key, **params)
    best = found.groupBy(key).agg(F.max_by(F.struct(*[c for c in found.columns if c != key]), F.struct(F.col("status") == "ok", F.col("attempts"))).alias("r"))
    return best.select(key, "r.*")


def searching(make_search: Callable[[], Callable], make_client: Callable[[], Callable], query: str = "query", into: str = "search_results") -> Callable[[], Callable]:
    """A client that searches the web first: the ``query`` field of a row goes to an injected search, whose answer joins the row as
    ``into`` before the model is called. An error of either is an error of the call."""

    def make() -> Callable:
        search, client = make_search(), make_client()

        async def call(row: dict):
            return await client(row | {into: await search(row.get(query))})

        return call

    return make


def _done(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.parquet(path).filter("status = 'ok'").select(key).distinct()


def validate(df: DataFrame, stage: str | None = None, score: str | None = None) -> DataFrame:
    """Enumerated fields checked: stage is Early or Late, score 1 to 5; anything else becomes null."""
    if stage:
        df = df.withColumn(stage, F.when(F.col(stage).isin("Early", "Late"), F.col(stage)))
    return df.withColumn(score, F.when(F.col(score).between(1, 5), F.col(score))) if score else df


def postprocess(results: DataFrame, names: DataFrame, code: str, name: str) -> DataFrame:
    """Codes of the results decoded to names, missing codes as ''."""
    from loomwork.functions.codes import decode_scalar

    return decode_scalar(results.withColumn(code, F.coalesce(code, F.lit(""))), code, names, name)


def parse_json(text: str) -> dict:
    """The first JSON object in a model's answer, fences and talk around it ignored."""
    start = text.find("{")
    while start >= 0:
        try:
            return json.JSONDecoder().raw_decode(text[start:])[0]
        except ValueError:
            start = text.find("{", start + 1)
    raise ValueError("no JSON object")
