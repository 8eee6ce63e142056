"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every vigil job relies on: UTC so `hour()` and `dt` agree with the
# rules, AQE for runtime re-planning (coalescing, skew splits, broadcast
# conversion of joins whose measured side is small).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # PySpark otherwise records the Python call site of every Column function
    # (four extra JVM round trips each), which dominated plan construction:
    # ~1 s of driver time per query before any task ran.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "vigil",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with vigil's base settings.

    `master` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    On a cluster this is set by the platform and points at shared storage; a
    folder given through `setCheckpointDir` counts too.  Only a local master
    may do without (tests): then a scratch folder is made and registered.
    Elsewhere an unset folder is an error, for executors cannot read the
    driver's or each other's local files.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="vigil-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark)
    suffix = uuid.uuid4().hex[:12]
    return f"{root}/{name}-{suffix}" if "://" in root else os.path.join(root, f"{name}-{suffix}")


def materialize(spark: SparkSession, df, name: str):
    """Write `df` once under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the files instead of
    recomputing the plan) and lets many consumers share one computation,
    while keeping Parquet statistics, pruning and pushdown for readers.
    """
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
