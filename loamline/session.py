"""Sessions, and the package's own code on the executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def session(name: str = "loamline", **conf: str) -> SparkSession:
    """A session with adaptive execution; conf overrides (dots as double underscores)."""
    builder = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once an application; the zip is served by the driver."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="loamline-")) / "loamline.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a folder of the warehouse
    on a cluster, and a temporary one in local mode, where driver and executors are one process."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if not told:
        local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
        told = "file://" + tempfile.mkdtemp(prefix="loamline-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", told)
    return told.rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back."""
    path = f"{shared_dir(df.sparkSession)}/loamline/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
