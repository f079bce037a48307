"""Session helpers.

On a cluster the session comes from the platform; these helpers only fill in settings that are
unset (tests, bench, local runs). The checkpoint folder is read from ``spark.checkpoint.dir`` and
only set here when the session has none.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces shuffle partitions at runtime;
# skew-join splitting handles a hot cost centre or employee.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "staffmart") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STAFFMART_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # one machine: no data locality to wait for
        .config("spark.locality.wait", "0s")
    )
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def session(app: str = "staffmart") -> SparkSession:
    """The platform's session (its master and resources), with the job settings it has left unset."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    given = spark.conf.getAll
    for key, value in JOB_CONF.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. Only a local session (tests) may go without a configured
    one: on a cluster, executors would not share a folder of the driver's."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="staffmart-ckpt-")   # tests / local runs only
        spark.conf.set("spark.checkpoint.dir", current)
    try:  # classic sessions: make DataFrame.checkpoint() use the same folder
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
    except Exception:  # noqa: BLE001 - no SparkContext on a remote (Connect) session
        pass
    return current


def warehouse_path(spark: SparkSession, name: str) -> str:
    """Folder for a written table next to the checkpoint folder (shared storage on a cluster)."""
    base = spark.conf.get("staffmart.warehouse.dir", None) or os.path.join(ensure_checkpoint_dir(spark), "warehouse")
    return os.path.join(base, name)

