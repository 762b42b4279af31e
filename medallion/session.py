"""Session construction and the shared working folder.

The working folder is where fixtures, silver/gold tables written by tests and
streaming checkpoints go.  On a cluster it must be shared storage, so it is
taken from ``spark.checkpoint.dir``; a private temporary folder is created only
when that setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Starting points for a large cluster (hundreds of executors, 100 TB inputs):
# start with many shuffle partitions and let AQE coalesce them to the advisory
# size, so no reducer holds more than a few hundred MB; read splits of 256 MB;
# broadcast only below 64 MB (AQE re-checks the real size before converting).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "medallion",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, profile: str = "local") -> SparkSession:
    """Session with the scale settings; ``profile="cluster"`` adds :data:`CLUSTER_CONF`,
    each value only where neither the cluster nor the session sets it."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if profile == "cluster":
        given = spark._jsparkSession.sessionState().conf().getAllConfs()
        for k, v in CLUSTER_CONF.items():
            if not given.contains(k):
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workspace(spark: SparkSession) -> str:
    """Shared folder for derived tables: ``spark.checkpoint.dir`` of the session.

    When unset in local mode (tests), a private temporary folder is created and
    registered as the checkpoint directory; on a cluster an unset value is an
    error, since executors cannot share a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach; "
                               "a machine-local temporary folder does not work on a cluster")
        base = tempfile.mkdtemp(prefix="medallion-ws-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the workspace (never reused)."""
    return f"{workspace(spark)}/medallion/scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme for Python-side checks in tests."""
    return p[5:] if p.startswith("file:") else p


def ship_package(spark: SparkSession) -> None:
    """Make ``medallion`` importable in executor Python workers (once per context).

    Only the Arrow-batched Python steps need it (e.g. ``mapInPandas`` with a
    caller's provider). The package is zipped, written to the shared
    workspace through the Hadoop file system and added with ``addPyFile``,
    which is what ``--py-files`` does at submit time.
    """
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_medallion_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in sorted(os.walk(pkg_dir)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.join("medallion", os.path.relpath(full, pkg_dir)))
    data = buf.getvalue()
    digest = hashlib.sha1(data).hexdigest()[:12]
    target = f"{workspace(spark)}/medallion/pyfiles/{digest}/medallion.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fsys = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fsys.exists(path):
        out = fsys.create(path, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    sc.addPyFile(target)
    sc._medallion_shipped = True
