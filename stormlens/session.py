"""Spark session helpers.

The engine never hard-codes cluster paths: the checkpoint folder is whatever the
cluster names in ``spark.checkpoint.dir``; only when that setting is absent (tests,
local runs) do we fall back to a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Broadcast only what is provably small; larger sides take the sort-merge path.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "stormlens", extra: dict | None = None) -> SparkSession:
    """Local/test session builder. On a cluster use the session you were given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("STORMLENS_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Only a local master (tests) may leave it unset
    and gets a scratch folder; on a cluster executors could not share one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="stormlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss).

    Used after expensive, re-used stages (imputed panel, feature panel) so a lost
    executor recomputes from the checkpoint rather than from the raw scan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``stormlens`` importable in the Python workers (``addPyFile``).

    The pandas-UDF operators (KNN tiles, SMOTE neighbours, tree attribution,
    seasonal ARMA) run functions of this package inside executor Python workers;
    the package is zipped once per application into the shared checkpoint folder
    and registered with the SparkContext, as ``--py-files`` would on submit."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    target_dir = ensure_checkpoint_dir(spark)
    if target_dir.startswith("file:"):
        target_dir = target_dir[len("file:"):]
    if "://" in target_dir:  # a remote shared folder: build locally, the driver serves it
        target_dir = tempfile.mkdtemp(prefix="stormlens-pkg-")
    os.makedirs(target_dir, exist_ok=True)
    path = os.path.join(target_dir, f"stormlens-{app}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _dirs, files in os.walk(pkg):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)
