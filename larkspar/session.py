"""Session factory and the shared working folder every job writes to."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions run by workers are found by module name there, so the package must be
    importable on every executor, wherever the driver was started from.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='larkspar-')}/{package.name}", "zip", root_dir=package.parent, base_dir=package.name
    )
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def build_session(app: str = "larkspar", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a fresh local one only in local mode.

    Executors on other machines must see what is written here, so a cluster
    session without the setting is refused instead of given a machine-local path.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="larkspar-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call has used."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives lost executors and is never recomputed."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
