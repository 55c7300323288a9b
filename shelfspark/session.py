"""Session construction and shared-folder helpers.

On a cluster the session is created by the platform; library code only
*reads* its settings. ``scratch_path`` resolves working folders under the
shared ``spark.checkpoint.dir`` (never a machine-local folder); only when
that setting is unset (local tests) does it create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter for every job in this package.
#  - AQE re-plans joins from runtime sizes (broadcast only below the
#    threshold, sort-merge otherwise), coalesces small shuffle partitions
#    and splits skewed partitions of sort-merge joins.
#  - UTC session time zone keeps date arithmetic reproducible.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "shelfspark", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.showConsoleProgress"] = "false"
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``.

    A cluster must set it (every executor writes and reads there), so an unset
    folder is an error; only a one-machine ``local[...]`` session, as in tests
    and the benchmark, gets a folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="shelfspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def ship_package(spark: SparkSession) -> None:
    """Hands this package to the executors' Python workers, once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_shelfspark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="shelfspark-"), "shelfspark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.join("shelfspark", os.path.relpath(full, root)))
    sc.addPyFile(path)  # Spark serves it to the executors
    sc._shelfspark_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (its URI scheme is kept)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/shelfspark/{name}-{uuid.uuid4().hex[:12]}"


SHUFFLES_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Jobs planned within remove their shuffle files when they end, not when the
    driver's memory is next collected: for frames that are run once, as writes are."""
    before = spark.conf.get(SHUFFLES_DROPPED, "false")
    spark.conf.set(SHUFFLES_DROPPED, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_DROPPED, before)


def written(df, name: str, path: str | None = None, compression: str | None = None):
    """Write ``df`` once as Parquet (default: a fresh folder under the shared
    checkpoint folder) and return a reader of it. A written table cuts the
    lineage: later branches scan it instead of recomputing it, and a lost
    executor never recomputes what was written."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
