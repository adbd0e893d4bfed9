"""Session defaults and the shared folder in which intermediate results are cut off from their lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and local benchmarks; on a cluster the session comes from the submitter."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session, a temporary one only where that is unset."""
    sc = spark.sparkContext
    now = sc._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lumbrera-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, kept when executors are lost, lineage cut.

    The tables of an application are deleted when it ends, or by discard_written() once no result that reads them is needed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    if len(_WRITTEN) == 1:
        atexit.register(_at_exit)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def discard_written(spark: SparkSession, since: int = 0) -> int:
    """Deletes the tables of written(), from the since-th on; results already collected or stored elsewhere stay. Gives how many are left."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _WRITTEN[since:]:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    del _WRITTEN[since:]
    return len(_WRITTEN)


def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _WRITTEN:
        try:
            discard_written(spark)
        except Exception:  # noqa: BLE001 - the session may be gone already
            pass


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint; unlike written() it keeps the partitioning."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once an application, so that they need not have it on their path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # The file stays on the driver, whose file server hands it to the executors.
    archive = os.path.join(tempfile.mkdtemp(prefix="lumbrera-"), "lumbrera.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    at = os.path.join(folder, n)
                    z.write(at, os.path.join("lumbrera", os.path.relpath(at, root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
