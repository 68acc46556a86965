"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the library relies on.  The time zone is pinned
# because zone-less order dates are read as UTC; ANSI stays on and the code
# uses try_* functions where bad input is expected.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Landed pages are gzip text, so a task takes a few small files instead of one large split.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "1m",
    # The JVM never compiles a method of more than 8,000 bytes: the flatteners' field rules, fused
    # into one, would be interpreted.  Beyond this size Spark takes one operator at a time.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Input bytes per shuffle partition before Spark joins small ones.
BYTES_PER_PARTITION = 4_000_000
MIN_PARTITIONS, MAX_PARTITIONS = 200, 20_000


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "shopfold") -> SparkSession:
    """Local/test session.  On a cluster the launcher supplies master and sizing."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library needs to an existing session."""
    for k, v in REQUIRED_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf already fixed by the launcher
            pass
    checkpoint_dir(spark)
    return spark


def size_shuffles(spark: SparkSession, sf_dir: str) -> None:
    """Let the number of shuffle partitions grow with the order tables under ``sf_dir``.

    With a fixed number, partitions grow with the input until every sort spills; here each shuffle
    starts with many and AQE joins those that turn out small.  A higher number set before stays.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    size = sum(path_bytes(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ("orders", "lineitem"))
    wanted = min(max(size // BYTES_PER_PARTITION, MIN_PARTITIONS), MAX_PARTITIONS)
    if wanted > int(spark.conf.get(key, None) or 0):
        spark.conf.set(key, str(wanted))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage and we only read it.
    Only where it is unset (local runs, tests) do we pick a local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="shopfold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


# Bumped whenever the landing recipe changes, so stale materialized inputs are
# never reused by a newer version of the code.
LANDING_VERSION = "v2"


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp)."""
    base = checkpoint_dir(spark)
    if parts and parts[0] == "landing":
        parts = ("landing", LANDING_VERSION, *parts[1:])
    p = "/".join([base, *[s.strip("/") for s in parts]])
    if unique:
        p = f"{p}/{uuid.uuid4().hex}"
    return p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem so it works for any scheme."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(conf).exists(hp)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files under a folder (0 if there is none)."""
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(hp).getLength() if fs.exists(hp) else 0


def local_or_uri(path: str) -> str:
    return path if "://" in path or path.startswith("/") else os.path.abspath(path)
