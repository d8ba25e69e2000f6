"""Session construction and the shared scratch folder."""

from __future__ import annotations

import math
import shutil
import tempfile
import uuid
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "emberline", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only a local session may go without: a machine-local folder would lose its
    contents with an executor, so on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="emberline-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path inside the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch data, wherever Spark can write."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the files in one folder, hidden ones left out; none if there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    found = [entry.getPath() for entry in system.listStatus(where) if entry.isFile()]
    return sorted(path.toString() for path in found if path.getName()[0] not in "._")


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file unless there is one of that name; whether it was made."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = system.create(where, False)
    except Py4JJavaError as error:
        if system.exists(where):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="emberline-package-")
    archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


#: Least number of partitions, and rows in one, for a fit; neither depends on the machine.
FIT_PARTITIONS = 16
FIT_ROWS = 50_000


def spread(rows: DataFrame, least: int = FIT_PARTITIONS, most_rows: int = FIT_ROWS) -> DataFrame:
    """Rows dealt and ordered by their own values, in a number of partitions that follows from theirs.

    A fit that goes through partitions in order thus gives the same model on any number of
    cores. Counts the rows: use it on stored tables.
    """
    partitions = max(least, math.ceil(rows.count() / most_rows))
    values = F.xxhash64(*[F.to_json(F.struct(c)) if "vector" in kind else F.col(c) for c, kind in rows.dtypes])
    dealt = rows.withColumn("_deal", values).repartition(partitions, "_deal")
    return dealt.sortWithinPartitions("_deal").drop("_deal")


def widen(rows: DataFrame) -> DataFrame:
    """Enough partitions for all cores, for row-local work that is heavy per row rather than per byte.

    Asking for the partition count runs the shuffles below: use it on stored tables.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def gathered(rows: DataFrame, each: int = 4) -> DataFrame:
    """As ``widen``, and no more than one partition per core where there are just a few: for work that pays per task too."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    rows = widen(rows)
    return rows.coalesce(cores) if cores < rows.rdd.getNumPartitions() <= each * cores else rows
