"""SparkSession settings shared by the library, the tests and the bench.

On a cluster the session is created by the platform; ``configure`` only
sets SQL options that the operators rely on and never overrides
``spark.checkpoint.dir`` when the cluster already names one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# SQL options the operators assume (see README "Session").
SQL_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Later map entries win when metadata overrides are merged.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A batch for Python is bounded by its bytes, too: rows may hold whole texts or index blocks.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SQL_OPTIONS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers (pandas functions run
    there): zip it once per application and add it with ``addPyFile``."""
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = Path(__file__).resolve().parent
    zpath = Path(tempfile.mkdtemp(prefix="rollplane-py-")) / "rollplane.zip"
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for f in pkg.rglob("*.py"):
            z.write(f, f.relative_to(pkg.parent))
    sc.addPyFile(str(zpath))
    _SHIPPED.add(sc.applicationId)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rollplane", driver_memory: str = "8g") -> SparkSession:
    """Session for tests and the local bench (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in SQL_OPTIONS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, choosing a scratch one only when the
    session has none (local tests); on a cluster the shared folder named in
    ``spark.checkpoint.dir`` is used as is."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="rollplane-ckpt-", dir=os.environ.get("ROLLPLANE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
