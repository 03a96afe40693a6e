"""Session settings the library relies on.

On a cluster the session already exists and is used as it is; ``local_session``
is for tests, the bench and notebooks.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

HOT_ROWS_CONF = "stepwise.skew.hotRows"
HOT_ROWS_DEFAULT = 4_000_000

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even when a later step must then shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "12g",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "stepwise", conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def hot_rows(spark: SparkSession) -> int:
    """Row count above which one group is split over several tasks."""
    return int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, the storage all executors share.

    A local session without any checkpoint folder (tests, a laptop) gets a temporary one, which
    later calls and ``checkpoint()`` then use as well. On a cluster that is an error: executors
    would each write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = getattr(spark.sparkContext, "master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="stepwise-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/stepwise/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Used where several jobs need the same reduced table; it outlives lost executors.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
