"""Sessions, and the package's code for executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: What the plans count on; a cluster's own settings go first.
CONF = {
    "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
#: Rows that Python gets at once: the setting, Spark's default, and this library's.
BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000")
_shipped: set[str] = set()


def build(name: str = "verdance", **conf: str) -> SparkSession:
    """A session with this library's settings; those given, with dots as double underscores, override."""
    b = SparkSession.builder.appName(name)
    for k, v in (CONF | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code, once for each application, as spark-submit --py-files would; and keep what goes to Python at once small, unless the session says otherwise."""
    if spark.conf.get(BATCH[0], BATCH[1]) == BATCH[1]:
        spark.conf.set(BATCH[0], BATCH[2])
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    held = tempfile.mkdtemp(prefix="verdance-code-")
    atexit.register(shutil.rmtree, held, ignore_errors=True)
    with zipfile.ZipFile(f"{held}/{root.name}.zip", "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(f"{held}/{root.name}.zip")
    _shipped.add(app)
