"""Session, table and materialisation helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("presswork")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One parquet table of a data directory, pruned to ``columns``.

    Timestamps are read as TIMESTAMP (session zone), never TIMESTAMP_NTZ, so
    that epoch arithmetic works on them.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    for field in df.schema.fields:
        if field.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(field.name, df[field.name].cast("timestamp"))
    return df


def dimension(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """A dictionary table from Parquet or, by its ending, from CSV with a header; an absent file raises ``FileNotFoundError``."""
    try:
        df = spark.read.csv(path, header=True, inferSchema=True, escape='"') if path.endswith(".csv") else spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise
    return df.select(*columns) if columns else df


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder in which lineage is cut.

    A cluster names it in ``spark.checkpoint.dir``. Only where nothing is set
    (tests on one machine) is a temporary folder used.
    """
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), "presswork-checkpoints")
    context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(*frames: DataFrame) -> None:
    """Remove the files of frames made by ``cut``, once nothing that is still to be computed reads them."""
    for df in frames:
        spark = df.sparkSession
        kept = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if kept.isDefined():
            path = spark._jvm.org.apache.hadoop.fs.Path(kept.get())
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="presswork-"), "presswork.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
