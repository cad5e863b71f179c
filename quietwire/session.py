"""Session settings the jobs rely on, and staged tables that cut lineage between them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A little text becomes many word pairs: keep all cores busy on small shuffles too.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    # Estimated sizes are far off after an explode. Joins are planned as shuffles, and turned
    # into broadcast or hash joins only on the sizes measured at the shuffle.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Rows of an Arrow batch: arrays of some kB each make some MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# Shuffled bytes that a task should get at most; AQE merges what is smaller.
TASK_BYTES = 256 << 20


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Sets what the jobs need. With ``input_bytes`` exchanges start with enough partitions for that
    much data, so that 100 TB are not dealt into the few hundred of a default session."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    if input_bytes:
        least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, -(-input_bytes // TASK_BYTES))))
    return spark


def size_of(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, as Catalyst knows them without a job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session (tests, single runs) may name none and gets a temporary folder, once. On a
    cluster the driver's own disk is no substitute, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quietwire-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/quietwire/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The copy has no lineage, survives lost executors, and carries a known size, which is
    what Catalyst needs to choose between a broadcast and a shuffled join.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Removes everything this application has staged. For when its results are written; after a
    failure the tables stay, as they tell what happened."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
