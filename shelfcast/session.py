"""Session set-up and durable intermediate tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows of a narrow dimension (about a hundred bytes each) that every executor can hold.
BROADCAST_ROWS = 1_000_000

_local_scratch: dict[str, tempfile.TemporaryDirectory] = {}
_scopes: list[list[str]] = []


def get_spark(app: str = "shelfcast", master: str | None = None, cpus: int | None = None) -> SparkSession:
    """A session as submitted; ``master`` or ``cpus`` ask for a local one with settings of its own.

    Settings in code beat submitted ones, so without either only the time zone
    is set, which the results depend on.
    """
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    if cpus:
        builder = builder.config("spark.sql.shuffle.partitions", str(cpus)).config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        builder = builder if master else builder.master(f"local[{cpus}]")
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local folder would be invisible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc.applicationId not in _local_scratch:
        _local_scratch[sc.applicationId] = tempfile.TemporaryDirectory(prefix="shelfcast-", ignore_cleanup_errors=True)
    return _local_scratch[sc.applicationId].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, never used before."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside, once the results that need them are written."""
    from shelfcast.functions import files

    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            files.delete(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    For sub-plans that several branches consume. The written table cuts the
    lineage and survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, counted: DataFrame | None = None, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a join side for broadcast when a count shows it is small; else Spark shuffles it as usual.

    ``counted`` is a frame that has at least as many rows and is cheaper to
    count. The estimates Spark makes before running grow with every join, so
    without the hint a small joined dimension makes the large side shuffle.
    """
    seen = (df if counted is None else counted).limit(rows + 1).count()
    return F.broadcast(df) if seen <= rows else df
