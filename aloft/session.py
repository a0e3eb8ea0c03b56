"""Session construction and the shared checkpoint folder.

Library code never invents a storage location: iterative operators read
``spark.checkpoint.dir`` (or the SparkContext checkpoint dir) from the running
session.  :func:`ensure_checkpoint_dir` sets a scratch folder when none is configured,
but only for a local master (tests, bench, tools, the smoke entry).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; every one is a public Spark SQL option.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # remove checkpoint files once the checkpointed DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "aloft", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The reliable checkpoint folder configured for this session, if any."""
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return spark.sparkContext.getCheckpointDir()
    return None


def require_checkpoint_dir(spark: SparkSession) -> str:
    d = checkpoint_dir(spark)
    if not d:
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder shared by all executors "
            "(e.g. an object-store or HDFS path) before running iterative operators")
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The configured folder; with a local master and none configured, a scratch folder.

    On a cluster executors and driver share no local folder, so there this raises."""
    d = checkpoint_dir(spark)
    if d:
        return d
    if not spark.sparkContext.master.startswith("local") or \
            spark.sparkContext.master.startswith("local-cluster"):
        return require_checkpoint_dir(spark)
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aloft-ckpt-",
                                                         dir=os.environ.get("TMPDIR", "/tmp")))
    return spark.sparkContext.getCheckpointDir()


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage at a place that outlives executors, in one pass over the plan
    (``checkpoint()`` runs the last stage twice), and leaves Spark exact sizes to plan with."""
    spark = df.sparkSession
    path = f"{require_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, keys: list[str], buckets: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder as a catalog table bucketed and sorted by ``keys``, and
    read it back: joins and groupings on these keys need no shuffle of it."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    unique = f"{name}_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", f"{require_checkpoint_dir(spark)}/{unique}").saveAsTable(unique))
    return spark.table(unique)
