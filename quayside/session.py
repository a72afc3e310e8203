"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Session settings the engine relies on.

    Event times are zone-less text read as UTC; keys and windows follow. Wide
    rows make generated methods longer than the 8000 bytes the JVM compiles;
    beyond that Spark is told to generate smaller ones, which run twice as fast.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Functions that run in Python workers are found there by name, so the workers must
    be able to import the package wherever the driver was started.
    """
    context = spark.sparkContext
    if not getattr(context, "quayside_shipped", False):
        package = os.path.dirname(os.path.abspath(__file__))
        folder = os.path.realpath(tempfile.mkdtemp(prefix="quayside-"))
        root, name = os.path.split(package)
        context.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", root, name))
        context.quayside_shipped = True


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names.

    Only a local session without ``spark.checkpoint.dir`` gets a folder of its
    own: on a cluster, a machine-local folder would be lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="quayside-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/quayside/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the work folder and read it back.

    Cuts the lineage durably: what reads the result prunes columns from Parquet
    instead of parsing and shuffling again, and a lost executor costs nothing.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
