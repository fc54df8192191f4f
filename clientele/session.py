"""Session settings and lineage truncation shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: list[str] = []

def build_session(app_name: str = "clientele", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect (UTC, adaptive plans)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the folder in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own;
    elsewhere such a folder would not be seen by the other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="clientele-"))
            atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
        folder = _own_folder[0]
    return f"{folder}/clientele-{spark.sparkContext.applicationId}"


def truncate(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df``: write it as a table and read that.

    A table, unlike a checkpoint, starts a plan without inherited constraints,
    which iterative jobs would otherwise collect round by round, and lets
    Catalyst see the real size. The tables of an application lie in one folder
    that can be deleted when it has ended.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)  # a quarter smaller than the default
    return spark.read.schema(df.schema).parquet(path)
