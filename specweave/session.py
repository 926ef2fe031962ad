"""Session helpers shared by every operator: table reading and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "specweave", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the session is given by the caller."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPECWEAVE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application (a plain ``import`` there needn't find it)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="specweave-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the engine's Parquet tables."""
    ship(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the one named by ``spark.checkpoint.dir``.  Only where that is unset (tests, benches on one machine) a temporary
    folder is chosen; a session of a real cluster must name a shared one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="specweave-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


class Shelf:
    """Intermediate tables of one computation, written to the shared folder so that a lost executor costs nothing.

    ``keep`` writes a table and reads it again; ``drop`` deletes one that nothing reads any more.  What is left goes when
    the session ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[int, str] = {}
        self.home = f"{_shared_folder(spark)}/kept-{uuid.uuid4().hex}"
        files, place = _file_system(spark, self.home)
        files.mkdirs(place)
        files.deleteOnExit(place)

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.home}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.paths.pop(id(df), None)
        if path is not None:
            files, place = _file_system(self.spark, path)
            files.delete(place, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df``: written to the shared folder and read again."""
    return Shelf(df.sparkSession).keep(df)
