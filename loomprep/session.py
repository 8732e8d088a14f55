"""Session helpers.

The library never creates a session on its own inside operators; these helpers
exist for tests, the bench and command-line use.  On a cluster the caller's
session is used as is: its ``spark.checkpoint.dir`` (a shared folder) is read,
and a local one is only set where none is configured.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "loomprep") -> SparkSession:
    """A local session for tests, the bench and scripts (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LOOMPREP_DRIVER_MEM", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a scratch one only if unset
    (tests and local runs).  On a cluster this is the shared folder the
    cluster configuration names in ``spark.checkpoint.dir``."""
    try:
        sc = spark.sparkContext
    except Exception:          # sessions without a JVM context (e.g. Connect)
        sc = None
    current = (sc.getCheckpointDir() if sc is not None else None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="loomprep-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(path)
    else:
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_dir(spark: SparkSession) -> str:
    """Folder of this application's written intermediates:
    ``<checkpoint dir>/loomprep/<application id>`` (remove it after the job)."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:
        app = spark.conf.get("spark.app.id", "app")
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/loomprep/{app}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's written intermediates (call it after the job;
    frames that still read them can no longer be computed)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, label: str = "stage"):
    """Compute ``df`` once, write it as parquet under the session's shared
    checkpoint folder and read it back: the lineage is cut, later actions
    reuse the files, and a lost executor does not force recomputation of the
    upstream plan.  Used for bounded intermediates (sample quotas) and for
    narrow key tables that several later steps scan."""
    import uuid
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
