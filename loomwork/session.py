"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: Arrow batches end at this many bytes, whatever the length of a text (a batch has one row at least).
_BATCH, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Make a session ready for this package.

    Python workers get the package, once per application, unless they find it by PYTHONPATH. Arrow batches are bound by bytes, so that
    a worker's memory follows neither the number nor the length of texts; a cluster that sets a bound of its own keeps it."""
    if not spark.sparkContext.getConf().contains(_BATCH):
        spark.conf.set(_BATCH, str(_BATCH_BYTES))
    root = Path(__file__).resolve().parent
    app = spark.sparkContext.applicationId
    on_path = any(p and Path(p).resolve() == root.parent for p in os.environ.get("PYTHONPATH", "").split(os.pathsep))
    if app in _shipped or on_path:
        return spark
    archive = Path(tempfile.mkdtemp()) / f"{root.name}-{app}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)
