"""A remote article service as a Spark data source, with jobs, code lists and a taxonomy.

The transport is injected: a function of (method, path, payload) that returns (status, body). None is shipped, and nothing here opens a connection by
itself.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loomwork.functions.codes import first_listed

Transport = Callable[[str, str, dict | None], tuple[int, str]]


def checked(answer: tuple[int, str]) -> dict:
    """The JSON of an answer of status 200 or 201; any other is an error."""
    status, body = answer
    if status not in (200, 201):
        raise RuntimeError(f"status {status}: {body[:500]}")
    return json.loads(body)


def wait_for(state: Callable[[], dict], done: str = "DONE", failed: str = "FAILED", first: float = 5.0, factor: float = 1.5, most: float = 300.0, timeout: float = 86400.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Poll until a job is done, waiting 1.5 times longer each time up to five minutes; failure and timeout are errors."""
    waited, delay = 0.0, first
    while True:
        now = state()
        if now["state"] == done:
            return now
        if now["state"] == failed:
            raise RuntimeError(f"job failed: {now}")
        if waited >= timeout:
            raise TimeoutError(f"job not done after {waited:.0f} s")
        sleep(delay)
        waited, delay = waited + delay, min(most, delay * factor)


class Service:
    """Explain, extract, code lists and taxonomy over a transport."""

    def __init__(self, transport: Transport, sleep: Callable[[float], None] = time.sleep):
        self.call = lambda *a: checked(transport(*a))
        self.sleep = sleep

    def explain(self, query: dict, samples: int = 10) -> tuple[int, list[dict]]:
        """How many articles match, and some of them, before paying for an extraction."""
        job = self.call("POST", "/explain", query)
        wait_for(lambda: self.call("GET", f"/explain/{job['id']}", None), sleep=self.sleep)
        got = self.call("GET", f"/explain/{job['id']}/result", {"samples": samples})
        return int(got["count"]), got.get("samples", [])[:samples]

    def extract(self, query: dict) -> list[str]:
        """Submit an extraction and return its files."""
        job = self.call("POST", "/extractions", query)
        return wait_for(lambda: self.call("GET", f"/extractions/{job['id']}", None), sleep=self.sleep).get("files", [])

    def try_extract(self, query: dict) -> list[str] | None:
        try:
            return self.extract(query)
        except (RuntimeError, TimeoutError):
            return None

    def create_list(self, name: str, codes: list[str]) -> dict:
        return self.call("POST", "/lists", {"name": name, "codes": sorted(set(codes))})

    def get_list(self, name: str) -> list[str]:
        return self.call("GET", f"/lists/{name}", None)["codes"]

    def update_list(self, name: str, codes: list[str]) -> dict:
        return self.call("PUT", f"/lists/{name}", {"codes": sorted(set(codes))})

    def delete_list(self, name: str) -> dict:
        return self.call("DELETE", f"/lists/{name}", None)

    def list_contains(self, name: str, code: str) -> bool:
        return code in self.get_list(name)

    def taxonomy(self, category: str) -> dict[str, str]:
        """Descriptions by lower-case code; of a code listed twice the first."""
        out: dict[str, str] = {}
        for row in self.call("GET", f"/taxonomies/{category}", None)["codes"]:
            out.setdefault(row["code"].lower(), row["description"])
        return out

    def find_codes(self, keyword: str) -> list[dict]:
        return self.call("GET", "/taxonomies/search", {"keyword": keyword})["codes"]

    def account(self) -> dict:
        return self.call("GET", "/account", None)


def code_list(spark: SparkSession, codes: list[str]) -> DataFrame:
    """A named set as a dimension table, for ``on_list``."""
    return spark.createDataFrame([(c,) for c in sorted(set(codes))], "code string")


def taxonomy_table(rows: DataFrame, code: str, description: str, order: str) -> DataFrame:
    """code (lower case), name: of a code listed twice the first by ``order``."""
    one = first_listed(rows.withColumn(code, F.lower(code)), code, order)
    return one.select(F.col(code).alias("code"), F.col(description).alias("name"))


def download(fetch: Callable[[], Iterator[bytes]], path: str, tries: int = 3, sleep: Callable[[float], None] = time.sleep) -> Path:
    """Stream to a temporary name, then rename: a file that is there is whole."""
    out = Path(path)
    part = out.with_name(out.name + ".tmp")
    for attempt in range(1, tries + 1):
        try:
            with part.open("wb") as f:
                for piece in fetch():
                    f.write(piece)
            part.replace(out)
            return out
        except OSError:
            part.unlink(missing_ok=True)
            if attempt == tries:
                raise
            sleep(5 * attempt)
    raise AssertionError


class _File(InputPartition):
    def __init__(self, name: str):
        self.name = name


class ExtractReader(DataSourceReader):
    """One partition a file of the job; ``open`` (by the option ``opener``, module:function) yields its rows."""

    def __init__(self, schema, options: dict):
        self.schema, self.options = schema, options

    def partitions(self):
        return [_File(x) for x in json.loads(self.options["files"])]

    def read(self, partition):
        import importlib

        module, _, name = self.options["opener"].partition(":")
        names = self.schema.fieldNames()
        for row in getattr(importlib.import_module(module), name)(partition.name):
            yield tuple(row.get(c) for c in names)


class ExtractSource(DataSource):
    """``spark.read.format("article_extract")`` with the options files (JSON list) and opener."""

    @classmethod
    def name(cls) -> str:
        return "article_extract"

    def schema(self):
        from loomwork.sources.files import ARTICLES

        return ARTICLES

    def reader(self, schema):
        return ExtractReader(schema, self.options)


def json_lines(path: str) -> Iterator[dict]:
    """Rows of a file of JSON lines: an opener for local files."""
    with open(path, encoding="utf-8") as f:
        for line in f:
            if line.strip():
                yield json.loads(line)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ExtractSource)
