"""Session factory and lineage cuts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "docweave", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs expect; sizes come from the cluster's own defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Rounds of iterative operators leave checkpoints behind that nobody reads again.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, wherever the driver was started; once per context."""
    context = spark.sparkContext
    if not getattr(context, "_docweave_shipped", False):
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="docweave-package-"), "docweave"), "zip", package.parent, package.name
        )
        context.addPyFile(archive)
        context._docweave_shipped = True
    return spark


def local_session(cpus: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    return build_session(
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("DOCWEAVE_DRIVER_MEMORY", "12g"),
        },
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the driver and all executors share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="docweave-checkpoint-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there.

    Iterative operators call this once per round, so a lost executor re-reads the
    last round instead of replaying all of them.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame) -> DataFrame:
    """As :func:`cut_lineage`, but as a Parquet table: compressed, and later steps read only the columns they use."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
