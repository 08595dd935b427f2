"""Where intermediate files go."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_SETTING = "spark.checkpoint.dir"
_LOCAL_ROOT: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Where the setting is absent a temporary folder serves, but only where the
    executors are threads of the driver: other machines could not read it.
    """
    named = spark.conf.get(SHARED_DIR_SETTING, None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "local")):
        raise RuntimeError(f"set {SHARED_DIR_SETTING} to a folder shared by all executors")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="tierstone-"))
        atexit.register(shutil.rmtree, _LOCAL_ROOT[0], ignore_errors=True)
    return _LOCAL_ROOT[0]


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder nobody else uses, below one folder per application.

    Spark creates it with the first write. The temporary folder of local mode goes
    with the process; on a cluster the application's folder is left to whatever
    clears the shared folder, as checkpoint files are.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/tierstone-{application}/{label}-{uuid.uuid4().hex[:12]}"


def listing_of(spark: SparkSession, folder: str) -> tuple[tuple[str, int, str], ...]:
    """Path, length and time of change of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    found = files.selectExpr("path", "length", "string(modificationTime)").collect()
    return tuple(sorted(map(tuple, found)))


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read from there, so that a plan which
    uses them several times computes them once."""
    path = f"{new_folder(df.sparkSession, label)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
