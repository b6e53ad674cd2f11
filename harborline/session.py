"""Session settings and the durable lineage cut the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or protect against skew.  Sizing (shuffle
# partitions, split bytes, memory) belongs to the cluster, not to the library.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TIGHT = "zstd"   # compression of tables that are large next to the work on them

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "harborline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for data that must outlive an executor.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master, as
    in tests, may fall back to a temporary folder on this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app_id = context.applicationId
    if app_id not in _local_scratch:
        _local_scratch[app_id] = tempfile.mkdtemp(prefix="harborline-")
    return _local_scratch[app_id]


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each write ends.

    Spark keeps them until the driver happens to collect its garbage, so a job of
    many writes would hold all its shuffles at once.  A write has a plan of its
    own that nothing runs again, so none of them is missed.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def materialize(df: DataFrame, label: str = "cut", compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    The columnar copy cuts the lineage, survives lost executors, and gives the
    next stages real sizes, column pruning and pushed-down filters.
    """
    spark = df.sparkSession
    app_id = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/harborline/{app_id}/{label}-{uuid.uuid4().hex}"
    with released_shuffles(spark):
        df.write.options(**({"compression": compression} if compression else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
