"""Session construction and lineage cutting.

On a cluster the session comes from the launcher; ``get_session`` only fills
in settings that are still unset, so cluster-level choices win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splitting guards against a hot customer key.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "responsekit", conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor (the 1g default is too small
        # for model fits); on a cluster executor memory comes from the launcher.
        builder = builder.config("spark.driver.memory", os.environ.get("RESPONSEKIT_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder; only a local session (tests, bench)
    may fall back to a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="responsekit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by writing a Parquet table into the shared checkpoint folder.

    Used before iterative fits (stacking folds, search trials, elimination
    rounds) so a lost executor recomputes from the written table, not from the
    raw tables. Unlike ``Dataset.checkpoint`` (which runs the plan once to count
    and again to write) the plan runs once, and later reads get column pruning
    and filter pushdown from the Parquet scan.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "tables", uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._materialized_path = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it any more; other frames are left alone."""
    if not hasattr(table, "_materialized_path"):
        return
    spark = table.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table._materialized_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
