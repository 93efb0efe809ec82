"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import SparkSession

# Adaptive execution does the run-time work the operators rely on: coalescing small shuffle
# partitions, splitting skewed join partitions and skewed REBALANCE partitions.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Tables bucketed by customer also serve joins on the customer and more columns.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot does not compile methods over 8,000 bytes; a projection of dozens of validated columns
    # exceeds that as one generated method and runs faster as separate ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


HUGE_METHODS = ("spark.sql.codegen.hugeMethodLimit", "65535", RUNTIME_CONF["spark.sql.codegen.hugeMethodLimit"])


def compiled_projections(spark: SparkSession) -> None:
    """Let projections of dozens of columns run as compiled methods; sessions of `build_session` do.

    Spark's own default lets them run as one method that HotSpot only interprets. A limit that the
    session was given stays.
    """
    name, default, limit = HUGE_METHODS
    if spark.conf.get(name, default) == default:
        spark.conf.set(name, limit)


def build_session(app: str = "snapcredit", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword names use ``__`` for the dots of a setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = RUNTIME_CONF | {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, below the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that folder would exist on
    one machine alone.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="snapcredit-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/snapcredit/{name}-{uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library along, so executors need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    # Spark copies the archive from the driver to the executors.
    archive = Path(tempfile.mkdtemp(prefix="snapcredit-")) / "snapcredit.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
