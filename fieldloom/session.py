"""Session helpers.

On a cluster the session is created by the platform; ``get_session`` only fills
in settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the engine relies on.  Each is applied only if the session does not
# already carry a value.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Constraint inference explodes on the wide CASE projections of the
    # normalisers (planning time grows without bound); the plans here do not
    # need inferred filters.
    "spark.sql.constraintPropagation.enabled": "false",
    # The JVM never compiles larger methods (see plans.tables).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fieldloom") -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", os.environ.get("FIELDLOOM_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is read, never replaced.  Only in
    local mode, where driver and executor share a disk, is a fresh scratch
    folder set when the setting is absent; elsewhere that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the setting
        return current
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="fieldloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df):
    """Materialise ``df`` reliably (survives executor loss) and cut its lineage.

    Uses ``checkpoint()`` into the shared checkpoint folder (never a local
    checkpoint).  If the session offers no checkpoint folder at all, the plan
    is returned unchanged: results are the same, only recomputation is not
    saved."""
    if not ensure_checkpoint_dir(df.sparkSession):
        return df
    return df.checkpoint(eager=True)
