"""Session helpers: a local session for tests and bench, and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import is_remote


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cardflow") -> SparkSession:
    """A local session with AQE on (tests and bench; a cluster brings its own)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.  Where it is unset a
    local session gets a fresh folder (all its tasks run on this machine); any
    other session is refused, since its executors cannot see a local folder."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if is_remote():
        if not conf:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return conf.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not conf and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(conf or tempfile.mkdtemp(prefix="cardflow-ckpt-"))
    return (conf or sc.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/cardflow/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back: the
    step boundary of the reference (tables between steps).  It cuts the
    lineage, and keeps the next step's filters out of this step's plan."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings that size tasks for a cluster run over `input_bytes` of raw
    input: scan splits and shuffle partitions of about `target_partition_bytes`
    (enough tasks for every core, never fewer than 2 waves), AQE re-plans from
    there (coalesces small partitions, splits skewed joins and writes)."""
    cores = max(1, executor_cores * executors)
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
