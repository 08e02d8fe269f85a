"""Session settings and the shared scratch folder.

Every job reads its working folder from ``spark.checkpoint.dir`` (the shared
folder a cluster names); only when that is unset (tests, a laptop) is a local
folder chosen and registered, so checkpoints and written stand-ins land in the
same place executors can all reach.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings the operators rely on; safe to set on any session.
RUNTIME_CONF = {
    # JSON objects with repeated keys keep the last value (as Python's json does)
    # instead of failing the whole parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "intakeyard",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("INTAKEYARD_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_root(spark: SparkSession) -> str:
    """Shared working folder: ``spark.checkpoint.dir`` if the cluster names one.

    Only when it is unset (local runs and tests) a fresh local folder is made and
    registered as the checkpoint dir, so later calls agree on it.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        return conf_dir.rstrip("/")
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return str(jdir.get()).rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="intakeyard-ckpt-", dir=os.environ.get("INTAKEYARD_TMP", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return str(spark.sparkContext._jsc.sc().getCheckpointDir().get()).rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers that can already import it (same path, same machine) lose nothing; others would fail.
    Arrow batches of whole texts are kept small as well, unless the session names a size of its own.
    """
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    if getattr(sc, "_intakeyard_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="intakeyard-py-")
    with zipfile.ZipFile(f"{folder}/intakeyard.zip", "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(f"{folder}/intakeyard.zip")
    sc._intakeyard_shipped = True
