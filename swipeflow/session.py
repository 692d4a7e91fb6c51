"""Session defaults and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "swipeflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the package relies on; a cluster's own settings stay."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir, also set as the checkpoint folder.

    Only a local-mode session without that setting falls back to a folder of this machine.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="swipeflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return (base or context.getCheckpointDir()).rstrip("/")


def _own_scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/swipeflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{_own_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Deletes this application's scratch tables; results that still read them must have been written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def config_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of configuration values, as a local relation.

    Its exact size is part of the plan, so Spark broadcasts it on that ground
    (a table built from plain rows has no known size and would be shuffled).
    """
    names = [field.split()[0] for field in schema.split(", ")]
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(names, row)) for row in rows]), schema)
