"""Session settings the package relies on, scratch space, and input spreading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that keep results and plans as documented. Only settings an operator's
# meaning or plan depends on are listed; sizing belongs to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a method above 8000 bytes; a stage whose fused method would be
    # larger (many patterns in one projection) then runs as split functions, which it does
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a repeated key in a model response keeps its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that can only be given when a session is made. Plans here hold hundreds of
# expressions; noting the call site of each takes most of the time to build them.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for a job's own tables, below the shared folder the cluster names.

    Falls back to a local temporary folder only for a local master, where driver and
    executors share one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="notewright-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


PARTS_PER_CORE = 4  # of an input that fills all cores


def spread(df: DataFrame) -> DataFrame:
    """Spread an input evenly, ahead of costly work on each of its rows.

    Work per row (regular expressions over text) is what costs. A small single-file input would run on
    one core; a large Parquet file is split by bytes, but a row group goes whole to one split, so some
    splits hold millions of rows and others none. Rows are dealt out by a hash of all their columns,
    which keeps a retried task's rows the same, and keeps apart rows that share a key. Give it narrow
    rows. A large input is dealt into several parts for each core, so that no task is long.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    large = df.rdd.getNumPartitions() >= cores
    return df.repartition(cores * PARTS_PER_CORE if large else cores, *df.columns)
