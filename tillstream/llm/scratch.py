"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession) -> str:
    """The shared folder the session names. Where it names none, a temporary one if driver and executors are one process."""
    named = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{KEY} must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tillstream-")
        spark.conf.set(KEY, named)
    return f"{named.rstrip('/')}/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared folder: what follows does not recompute it, and a lost
    executor loses nothing of it."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN)
    spark.conf.set(CLEAN, "true")  # the shuffles of this write are of no use once it is done
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``written``. Nothing that still has to be computed may read them; a frame that is no such
    table is left alone."""
    for table in tables:
        if path := table.__dict__.pop("scratch_path", None):
            spark = table.sparkSession
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application, so that their Python workers can import it."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = pathlib.Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="tillstream-"), "tillstream_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(application)
