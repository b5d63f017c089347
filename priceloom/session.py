"""Session factory with the settings that results depend on (UTC) and those that plans profit from (adaptive execution)."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(app: str = "priceloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps.  Memory, cores and shuffle partitions stay with the cluster's settings unless given in ``conf``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    } | conf
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship_code(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for a context, so that they find it wherever the driver was started.

    Also bounds the Arrow batches that pass between them and the JVM by bytes, as rows may be long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    sc = spark.sparkContext
    if getattr(sc, "_priceloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="priceloom-code-")) / "priceloom.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(to))
    sc._priceloom_shipped = True
