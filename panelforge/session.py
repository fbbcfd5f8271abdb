"""SparkSession construction and shared-folder helpers.

On a cluster the session is created by the platform; ``tune`` only fills in
settings that are unset, and ``checkpoint_dir`` reads the shared folder the
cluster names in ``spark.checkpoint.dir``. A local folder is created only when
that setting is absent (tests and the local bench).
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the engine relies on. Applied only where the session leaves them unset.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "panelforge",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests, the bench and the examples (UI off)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS to an existing session without overriding the cluster's choices."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package (Python functions are pickled by module name): one
    small zip per Spark application, spread by Spark like any added file."""
    sc = spark.sparkContext
    if getattr(sc, "_panelforge_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="panelforge-zip-"), "panelforge.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    sc.addPyFile(path)
    sc._panelforge_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir`` if set. Only a local-mode
    session (tests, the local bench) may fall back to a new local folder; on a cluster a
    machine-local folder would not survive a lost executor, so the setting is required."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        d = tempfile.mkdtemp(prefix="panelforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    ship_package(spark)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
