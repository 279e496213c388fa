"""Session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the pipeline is designed for. Nothing in the library hints a
# broadcast: Spark compares the size of a side, its files' times the compression
# factor, with the threshold below, and falls back to a sort-merge join whose hot
# partitions AQE splits.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.fileCompressionFactor": "8",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot does not compile longer methods; past it Spark splits the stage instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # One run of the pipeline generates more classes than the default of 100 keeps.
    "spark.sql.codegen.cache.maxEntries": "2000",
}

# Scratch folder by application.
_roots: dict[str, str] = {}


def recommended_builder(app_name: str = "benthoframe"):
    """A session builder with `RECOMMENDED_CONF` applied."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder


def scratch_root(spark: SparkSession) -> str:
    """This session's own folder for intermediate tables, under ``spark.checkpoint.dir``.

    Only a session whose master is ``local`` or ``local[...]``, as in tests, may run
    without the setting; it gets a temporary folder, removed when the process ends.
    `clear_scratch` removes the folder of a session on a cluster.
    """
    application = spark.sparkContext.applicationId
    if application not in _roots:
        configured = spark.conf.get("spark.checkpoint.dir", "")
        if not configured:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise RuntimeError(
                    "Set spark.checkpoint.dir to a folder that all executors share."
                )
            configured = tempfile.mkdtemp(prefix="benthoframe-")
            atexit.register(shutil.rmtree, configured, ignore_errors=True)
        _roots[application] = f"{configured.rstrip('/')}/benthoframe-{uuid.uuid4().hex}"
    return _roots[application]


def clear_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table of this session; its lazy results end with them."""
    root = _roots.pop(spark.sparkContext.applicationId, None)
    if root:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a Parquet table under the scratch root and read it back.

    Used for lookups derived from a large table (resolved names, conversion
    tables, conflicting taxa). The result is computed once, survives the loss of
    executors, and has a file size the optimizer can read, so that joins against
    it are broadcast only when it is really small.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
