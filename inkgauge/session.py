"""Session set-up, input parallelism and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "inkgauge", **conf: str) -> SparkSession:
    """Build a session with the settings every job here relies on.

    Cluster-specific settings (master, memory, shuffle partitions) are left to
    ``spark-submit`` unless they are passed in.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # rows are wide here (word lists, vectors): keep a batch within some 30 MB
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()
_COPIES: dict[str, list[str]] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Not needed where it is installed on every machine, but harmless there.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="inkgauge-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without: there the driver and the executors are
    one process, so a temporary folder is shared by definition.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="inkgauge-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call is handed."""
    return f"{shared_dir(spark).rstrip('/')}/inkgauge/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder and read it back.

    The copy outlives lost executors, and later passes read columns from Parquet
    instead of computing them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _COPIES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = 1 << 22
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def arrow_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Let queries planned meanwhile send Python batches of ``size`` bytes, a speed and memory matter only.

    Batches of wide vectors are some 30 to 60 MB else, and each is copied several times on its way.
    """
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_BYTES)
        else:
            spark.conf.set(ARROW_BYTES, before)


def remove_copies(spark: SparkSession) -> int:
    """Delete what ``written`` has left in the shared folder; returns the number of copies.

    Results that read a copy must have been stored before: call it at the end of a
    job or of the session.
    """
    paths = _COPIES.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_path(spark, path)
    return len(paths)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it exists."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def spread(df: DataFrame) -> DataFrame:
    """Use every core on an input of few files.

    A Parquet file with a single row group is read by one task. When the input has
    fewer splits than the session has cores, moving it is cheap and its rows are
    redistributed. Larger inputs already fill the cluster and are returned
    untouched, so no corpus-sized shuffle is added. Rows only move: no result
    depends on where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if 1 < cores and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
